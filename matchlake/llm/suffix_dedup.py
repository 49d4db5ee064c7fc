"""Repeated passages: exact substring removal by external induced suffix sorting.

A byte goes if a LENGTH-byte string that covers it also starts earlier: in a smaller document, or in the same
document at an earlier place. All strings are judged on the input.

1. Fragments. Each LENGTH-byte string has one anchor: its GRAM-byte window with the smallest hash. Strings with
   the same bytes have the same anchor bytes, and those of one anchor occurrence start side by side, so a text
   falls into fragments, one per anchor. Fragments go to tasks by their anchor's hash; copies of a fragment in one
   batch are told apart before that, so a passage in a third of all texts sends one row per batch.
2. Of equal fragments all but the first repeat. Only anchors with different fragments need sorting. Of a string's
   LENGTH - GRAM bytes beside its anchor SIDE lie before or behind it. So the first fragments fall in two, starts with
   SIDE bytes before the anchor and other starts, and a part needs sorting only with parts that have the same SIDE
   bytes there. Parts that are alone with theirs hold no repeating string; the others are cut from the texts and dealt
   by anchor and side into shards. Chance agreement of GRAM bytes alone, which grows with the corpus, sends nothing.
   A side at the edge of a passage in very many texts has as many kinds of fragments as texts. Beyond HOT_KINDS
   its strings are dealt one by one, by their own hash; those that a batch holds twice are settled there, and one
   that is alone under its hash does not repeat.
3. Each shard is suffix-sorted (`InducedSorter`). Suffixes with a common prefix of LENGTH bytes lie side by side;
   in each such run all but the earliest repeat.
4. The repeating starts of a document are merged into spans and removed in one join.

Matches never cross documents because fragments do not.

Cases: null and empty texts have no bytes; texts shorter than LENGTH keep all. Documents are ordered by id, nulls
last; rows that share an id, or have none, are ordered by text, repeated rows by place, and each is a document of
its own. Other columns are ignored.
"""

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import numbered, staged

LENGTH, GRAM = 100, 20
SIDE = (LENGTH - GRAM) // 2
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
# Bytes of a text whose anchors are found at a time; places take 24 bits of an anchor's key.
PIECE = 1 << 23
SHARD_BYTES = 4 << 20
# Kinds of fragments of an anchor's side beyond which its strings are dealt one by one.
HOT_KINDS = 2500
REPEAT, OPEN, HOT = 0, 1, 2
# Bytes of waiting suffix tuples that a queue keeps in memory.
QUEUE_BYTES = 64 << 20
FAR = np.int32(1 << 20)


# --- fragments ---


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers in place."""
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, anchor place, anchor hash, sides) of the fragments of one piece. sides: the
    bytes that the first start has before the anchor, a hash of the SIDE bytes before it, and one of those behind it,
    in 8, 28 and 28 bits."""
    n = len(data)
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    power, four = BASE, None
    for width in (1, 2, 4, 8):
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power & MASK
        four = h if width == 2 else four
    fourth = np.uint64(pow(BASE, 4, 1 << 64))
    h = mixed(h[:-4] * fourth + four[16:])
    key = (h & np.uint64(MASK << 24 & MASK)) | np.arange(len(h), dtype=np.uint64)
    # Smallest key of each run of LENGTH - GRAM + 1 = 81 windows, from runs of 64; the leftmost of equals.
    low = key
    for width in (1, 2, 4, 8, 16, 32):
        low = np.minimum(low[:-width], low[width:])
    low = np.minimum(low[: n - LENGTH + 1], low[17 : 17 + n - LENGTH + 1])
    at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(first, len(at)))
    place = at[first]
    sides = (place - first).astype(np.uint64)
    for begin in (place - SIDE, place + GRAM):
        # Where a side leaves the piece no start uses it.
        begin = np.clip(begin, 0, n - SIDE)
        side = four[begin]
        for k in range(4, SIDE, 4):
            side *= fourth
            side += four[begin + k]
        sides = sides << np.uint64(28) | mixed(side) >> np.uint64(36)
    return first, count, place, h[place], sides


def fragments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of starts, anchor hash, fragment hash, sides). Pieces of a long text share no start."""
    parts = []
    for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        piece = data[at : at + PIECE + LENGTH - 1]
        first, count, place, anchor, sides = anchors(piece)
        digest = xxhash.xxh3_64_intdigest
        ends, offsets = (first + count + LENGTH - 1).tolist(), (place - first).tolist()
        marks = [digest(piece[s:e], seed=o) for s, e, o in zip(first.tolist(), ends, offsets, strict=True)]
        parts.append((first + at, count, anchor, np.array(marks, np.uint64), sides))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, *[none.astype(np.uint64)] * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


FRAGMENT = pa.schema([(c, pa.int64()) for c in ("anchor", "mark", "doc", "start", "count", "sides")])


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of each batch of (doc, text). Copies of a fragment inside a batch repeat for certain; they are
    marked by a negative count and travel under any key."""
    for batch in batches:
        parts, size, docs = [], 0, batch.column("doc").to_numpy()
        for k in range(batch.num_rows + 1):
            if k < batch.num_rows:
                text = batch.column("text")[k].as_py()
                data = (text or "").encode()
                start, count, *hashes = fragments(data)
                anchor, mark, sides = (x.view(np.int64) for x in hashes)
                parts.append((anchor, mark, np.full(len(start), docs[k]), start, count, sides))
                size += len(data)
            if parts and (size > (32 << 20) or k == batch.num_rows):
                anchor, mark, doc, start, count, sides = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.lexsort((start, doc, mark, anchor))
                a, m = anchor[order], mark[order]
                same = np.concatenate([[False], (a[1:] == a[:-1]) & (m[1:] == m[:-1])]) if len(order) else []
                copies = order[same] if len(order) else order
                count = count.copy()
                count[copies] *= -1
                anchor = anchor.copy()
                anchor[copies] = (doc[copies] * 0x9E3779B1 + start[copies]) * 0x85EBCA77
                if len(anchor):
                    yield _batch(FRAGMENT, anchor, mark, doc, start, count, sides)
                parts, size = [], 0


JUDGED = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("count", pa.int64()), ("state", pa.int32())])


def _parts(anchor: np.ndarray, start: np.ndarray, count: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, ...]:
    """(fragment, key, start, count) of the parts of fragments; strings of different fragments are equal only under
    the same key."""
    left = np.clip((sides >> np.uint64(56)).astype(np.int64) - SIDE + 1, 0, count)
    low = np.uint64((1 << 28) - 1)
    # A side's hash stands in the upper bits, which of the two it is in the lowest.
    keys = [(sides >> np.uint64(28) & low) << np.uint64(36), (sides & low) << np.uint64(36) | np.uint64(1)]
    of = np.tile(np.arange(len(anchor)), 2)
    key = mixed(np.concatenate(keys) + anchor.view(np.uint64)[of]).view(np.int64)
    begin, size = np.concatenate([start, start + left]), np.concatenate([left, count - left])
    there = np.flatnonzero(size)
    return of[there], key[there], begin[there], size[there]


def _judge(batches: Iterator[pa.RecordBatch], hot_kinds: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, mark, doc, start). Gives repeating fragments, and as OPEN or HOT, under a key of their
    own, the parts of the first of each kind that agree with another kind of the anchor in a side."""

    def judged(rows):
        a, m, doc, start, count, sides = rows
        copy = count < 0
        if copy.any():
            yield _batch(JUDGED, a[copy], doc[copy], start[copy], -count[copy], np.full(copy.sum(), REPEAT))
            a, m, doc, start, count, sides = (x[~copy] for x in rows)
        if not len(a):
            return
        new_a = np.concatenate([[True], a[1:] != a[:-1]])
        new_kind = new_a | np.concatenate([[True], m[1:] != m[:-1]])
        again = ~new_kind
        yield _batch(JUDGED, a[again], doc[again], start[again], count[again], np.full(again.sum(), REPEAT))
        group = np.cumsum(new_a) - 1
        several = np.flatnonzero(new_kind & (np.bincount(group, new_kind)[group] > 1))
        of, key, start, count = _parts(a[several], start[several], count[several], sides[several].view(np.uint64))
        _, place, kinds = np.unique(key, return_inverse=True, return_counts=True)
        kinds = kinds[place]
        kept = np.flatnonzero(kinds > 1)
        state = np.where(kinds[kept] > hot_kinds, HOT, OPEN)
        yield _batch(JUDGED, key[kept], doc[several[of[kept]]], start[kept], count[kept], state)

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in FRAGMENT.names]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        # Rows of one anchor are joined once, when the next anchor comes.
        if held and rows[0][-1] != last:
            yield from judged([np.concatenate(x) for x in zip(*held, [x[:cut] for x in rows], strict=True)])
            held = []
        elif not held and cut:
            yield from judged([x[:cut] for x in rows])
        held.append(rows if held else [x[cut:] for x in rows])
        last = rows[0][-1]
    if held:
        yield from judged([np.concatenate(x) for x in zip(*held, strict=True)])


# --- induced sorting ---


class TupleQueue:
    """Disk-backed priority queue of suffix tuples (place, common prefix, run), by first character.

    Tuples of one character leave in the order in which they came. When more than `budget` bytes wait, the fullest
    character's tuples go to a file of the task's own, which has no name and ends with it.
    """

    def __init__(self, budget: int):
        self.budget, self.held = budget, 0
        self.waiting: dict[int, list] = {}
        self.sizes: dict[int, int] = {}
        self.files: dict[int, object] = {}

    def push(self, char: int, place: np.ndarray, common: np.ndarray, run: np.ndarray) -> None:
        self.waiting.setdefault(char, []).append((place, common, run))
        size = place.nbytes + common.nbytes + run.nbytes
        self.sizes[char] = self.sizes.get(char, 0) + size
        self.held += size
        while self.held > self.budget and (full := max(self.sizes, key=self.sizes.get, default=None)) is not None:
            self._spill(full)

    def _spill(self, char: int) -> None:
        file = self.files.setdefault(char, tempfile.TemporaryFile())
        for part in self.waiting.pop(char):
            np.save(file, np.stack([x.astype(np.int64) for x in part]))
        self.held -= self.sizes.pop(char)

    def pop(self, char: int):
        """All tuples of a character so far, or None."""
        parts = []
        if (file := self.files.pop(char, None)) is not None:
            end = file.tell()
            file.seek(0)
            while file.tell() < end:
                place, common, run = np.load(file)
                parts.append((place.astype(np.int64), common.astype(np.int32), run.astype(np.int32)))
            file.close()
        parts += self.waiting.pop(char, [])
        self.held -= self.sizes.pop(char, 0)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else None


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high] for each pair, from minima of runs of 1, 2, 4, ..."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp((high - low + 1).astype(float))[1] - 1
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        mine = level == k
        if mine.any():
            out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


class InducedSorter:
    """Suffix order of a text with common prefixes, by induced sorting.

    text: characters above 1, with 1 between parts and a single 0 at its end. Suffixes smaller than their left
    neighbour's (S* suffixes) are sorted by recursion on the names of the substrings between them; the order of
    all others is induced, first of those larger than their successor (L), ascending, then of the smaller (S),
    descending. All tuples of a character that wait in the queue are taken as one block, and the minima of common
    prefixes between tuples that lead to the same character become the common prefixes there.

    Prefixes are compared over `depth` characters at least; suffixes that agree so far may come in any order.
    """

    def __init__(self, text: np.ndarray, depth: int, budget: int = QUEUE_BYTES):
        self.text, self.depth, self.budget = text, depth, budget
        n = len(text)
        step = np.sign(np.diff(text.astype(np.int32)))
        # Type of a place: that of the next change of character.
        change = np.where(step != 0, np.arange(n - 1), n)
        change = np.minimum.accumulate(change[::-1])[::-1]
        self.is_s = np.ones(n, bool)
        self.is_s[:-1] = step[np.minimum(change, n - 2)] > 0
        self.run_end = np.append(np.minimum(change, n - 2), n - 1)
        self.stars = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1

    def _named(self, ends: np.ndarray) -> tuple[int, np.ndarray]:
        """How many different substrings there are from S* places to these ends, and the place of each among them in
        order. Characters and their types go six to a number; none begins another, so those alike so far are all
        longer."""
        keys = 2 * self.text.astype(np.int64) + self.is_s
        at, left = self.stars, ends - self.stars + 1
        live, rank, names = np.arange(len(at)), np.zeros(len(at), np.int64), 1
        while len(live):
            word = np.zeros(len(live), np.int64)
            for k in range(6):
                word <<= 10
                word += np.where(k < left, keys.take(at + k, mode="clip"), 0)
            of = rank[live]
            order = np.argsort(word)
            if names > 1:
                order = order[np.argsort(of[order], kind="stable")]
            of, word = of[order], word[order]
            head = np.append(True, of[1:] != of[:-1])
            new = head | np.append(True, word[1:] != word[:-1])
            # Each name makes way for the further ones of the names before it.
            further = np.bincount(of, new & ~head, names).astype(np.int64)
            rank += (np.cumsum(further) - further)[rank]
            within = np.cumsum(new)
            rank[live[order]] += within - np.maximum.accumulate(np.where(head, within, 0))
            names += int(further.sum())
            more = left > 6
            live, at, left = live[more], at[more] + 6, left[more] - 6
        return names, rank

    def _sorted_stars(self) -> tuple[np.ndarray, np.ndarray]:
        """S* suffixes in order, and the common prefix of each with the one before.

        Substrings from one S* place to the next are named in order; then names of 2, 4, 8, ... substrings are
        named in turn until they reach over `depth` characters or all differ.
        """
        stars, text = self.stars, self.text
        if not len(stars):
            return stars, np.empty(0, np.int32)
        names, rank = self._named(np.append(stars[1:], len(text) - 1))
        levels, reach = [rank.astype(np.int32)], 1
        # A substring is two characters long at least.
        while 2 * reach < self.depth and names < len(stars):
            after = np.full(len(rank), -1)
            after[:-reach] = rank[reach:]
            pair = rank * (len(stars) + 1) + after + 1
            found, rank = np.unique(pair, return_inverse=True)
            names = len(found)
            levels.append(rank.astype(np.int32))
            reach *= 2
        order = np.argsort(rank)
        common = np.zeros(len(order), np.int32)
        # The last substring is like no other, so neighbours differ before the end of the text.
        a, b = order[:-1].copy(), order[1:].copy()
        begin, live = stars[a], np.arange(len(a))
        for k in range(len(levels) - 1, -1, -1):
            same = live[levels[k][a[live]] == levels[k][b[live]]]
            a[same] += 1 << k
            b[same] += 1 << k
            # Those that agree over the depth need no closer look.
            live = live[stars[a[live]] - begin[live] < self.depth]
        # The first substrings that differ still share some characters.
        total = stars[a] - begin
        at, bt = stars[a[live]], stars[b[live]]
        while len(live):
            on = np.flatnonzero(text[at] == text[bt])
            live, at, bt = live[on], at[on] + 1, bt[on] + 1
            total[live] += 1
            on = total[live] < self.depth
            live, at, bt = live[on], at[on], bt[on]
        common[1:] = np.minimum(total, FAR)
        return stars[order], common

    def _induce(self, queue, pending, seen, place, common, run, char: int, to_s: bool) -> None:
        """Queues the left neighbours, of one type, of a block of suffixes of a character."""
        before = place - 1
        fits = (place > 0) & (self.is_s[before] == to_s)
        least = int(common.min())
        if not fits.any():
            np.minimum(pending, least, out=pending)
            return
        at = np.flatnonzero(fits)
        # Small whole numbers are brought into order quickly.
        to = self.text[before[at]].astype(np.uint16)
        order = np.argsort(to, kind="stable")
        at, to = at[order], to[order].astype(np.int64)
        first = np.concatenate([[True], to[1:] != to[:-1]])
        low = np.concatenate([[0], at[:-1] + 1])
        low[first] = 0
        shared = _least(common, low, at).astype(np.int64)
        shared[first] = np.minimum(shared[first], pending[to[first]])
        shared = np.minimum(shared + 1, FAR).astype(np.int32)
        heads = np.flatnonzero(first)
        shared[heads[~seen[to[heads]]]] = 0
        runs = np.where(to == char, run[at] + 1, 1).astype(np.int32)
        places = before[at]
        ends = np.append(heads[1:], len(at))
        rest = np.append(np.minimum.accumulate(common[::-1])[::-1], FAR)
        np.minimum(pending, least, out=pending)
        for lo, hi in zip(heads.tolist(), ends.tolist(), strict=True):
            c = int(to[lo])
            queue.push(c, places[lo:hi], shared[lo:hi], runs[lo:hi])
            pending[c] = rest[at[hi - 1] + 1]
            seen[c] = True

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (place, common prefix with the suffix before in this order), from the largest suffix down."""
        stars, star_common = self._sorted_stars()
        first = self.text[stars]
        chars = int(self.text.max()) + 1
        bounds = np.searchsorted(first, np.arange(chars + 1))
        larger: dict[int, list] = {}
        queue, pending, seen = TupleQueue(self.budget), np.full(chars, FAR, np.int64), np.zeros(chars, bool)
        # The last place is an S* place by definition; its left neighbour is of type L.
        for c in range(chars):
            blocks = []
            while (block := queue.pop(c)) is not None:
                blocks.append(block)
                self._induce(queue, pending, seen, *block, c, to_s=False)
            lo, hi = bounds[c], bounds[c + 1]
            if hi > lo:
                place, common = stars[lo:hi], star_common[lo:hi].copy()
                run = (self.run_end[place] - place + 1).astype(np.int32)
                common[0] = min(blocks[-1][2][-1], run[0]) if blocks else 0
                self._induce(queue, pending, seen, place, common, run, c, to_s=False)
            if blocks:
                larger[c] = [np.concatenate(x) for x in zip(*blocks, strict=True)]
        queue, pending, seen = TupleQueue(self.budget), np.full(chars, FAR, np.int64), np.zeros(chars, bool)
        for c in range(chars - 1, -1, -1):
            last_run = 0
            while (block := queue.pop(c)) is not None:
                self._induce(queue, pending, seen, *block, c, to_s=True)
                last_run = int(block[2][-1])
                yield block[0], block[1]
            if c in larger:
                place, common, run = (x[::-1] for x in larger.pop(c))
                # Common prefixes were with the smaller neighbour; now they are with the larger one.
                common = np.concatenate([[min(last_run, int(run[0]))], common[:-1]]).astype(np.int32)
                self._induce(queue, pending, seen, place, common, run, c, to_s=True)
                yield place, common


def repeats(parts: list[bytes], counts: list[int], budget: int = QUEUE_BYTES) -> list[tuple[int, int, int]]:
    """(part, first start, number) of runs of starts whose LENGTH-byte string starts earlier: in an earlier part or
    at an earlier of the first counts[k] places of part k."""
    sizes = np.array([len(p) + 1 for p in parts])
    begin = np.cumsum(sizes) - sizes
    # Bytes become 2 to 257, parts are parted by 1.
    text = np.frombuffer(b"\0".join(parts) + b"\0\0", np.uint8).astype(np.uint16) + np.uint16(2)
    text[begin[1:] - 1] = 1
    text[-2:] = (1, 0)
    part = np.repeat(np.arange(len(parts)), sizes)
    offset = np.arange(len(part)) - begin[part]
    counted = offset < np.array(counts)[part]
    repeated = np.zeros(len(part) + 1, bool)
    run_low = None
    waiting: list = []

    def close():
        # Of the places of a run all but the smallest repeat.
        places = np.concatenate(waiting)
        repeated[places] = True
        repeated[places.min()] = False
        waiting.clear()

    for place, common in InducedSorter(text, LENGTH, budget).descending():
        ok = place < len(part)
        far = common >= LENGTH
        starts = np.flatnonzero(~far)
        # Places before the first new run belong to the run of the last block.
        head = place[: starts[0]] if len(starts) else place
        if len(head):
            waiting.append(head)
        if not len(starts):
            continue
        if waiting:
            close()
        groups = np.cumsum(~far)[starts[0] :] - 1
        rest = place[starts[0] :]
        last = groups == groups[-1]
        waiting.append(rest[last])
        rest, groups = rest[~last], groups[~last]
        if len(rest):
            lowest = np.full(groups[-1] + 1, len(part) + 1)
            np.minimum.at(lowest, groups, rest)
            repeated[rest[rest != lowest[groups]]] = True
    if waiting:
        close()
    repeated = repeated[: len(part)] & counted
    edge = np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(part[a]), int(offset[a]), int(b - a)) for a, b in zip(lo, hi, strict=True)]


SPAN = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("count", pa.int64())])


def _sorter(shard_bytes: int, budget: int):
    """Rows (anchor, doc, start, count, data) sorted by anchor; a shard takes whole anchors."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1], r[2]))
        found = repeats([r[4] for r in rows], [r[3] for r in rows], budget)
        return _batch(SPAN, [rows[k][1] for k, _, _ in found], [rows[k][2] + s for k, s, _ in found], [n for *_, n in found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, same = [], 0, []
        for batch in batches:
            known = [k for k, data in enumerate(batch.column("data").is_null().to_pylist()) if data]
            if known:
                settled = batch.take(pa.array(known))
                yield _batch(SPAN, *(settled.column(c) for c in SPAN.names))
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "start", "count", "data")), strict=True):
                if row[4] is None:
                    continue
                if same and row[0] != same[0][0]:
                    # The strings of one fragment differ, so a row alone under its key repeats nothing.
                    if len(same) > 1:
                        shard += same
                        size += sum(len(r[4]) for r in same)
                    same = []
                    if size > shard_bytes:
                        yield spans(shard)
                        shard, size = [], 0
                same.append(row)
        shard += same if len(same) > 1 else []
        if shard:
            yield spans(shard)

    return run


# --- Spark ---

PIECE_SCHEMA = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("count", pa.int64()), ("data", pa.binary())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted fragments of each text, of hot anchors string by string. A string that repeats inside the
    batch comes without bytes, under any key."""
    for batch in batches:
        out, single = [], {}
        wanted = batch.column("wanted").to_pylist()
        for doc, text, places in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), wanted, strict=True):
            data = text.encode()
            for w in places:
                end = w["start"] + w["count"] + LENGTH - 1
                if w["state"] == OPEN:
                    out.append((w["anchor"], doc, w["start"], w["count"], data[w["start"] : end]))
                    continue
                for at in range(w["start"], w["start"] + w["count"]):
                    here, string = (doc, at), data[at : at + LENGTH]
                    first = single.get(string)
                    if first is None:
                        single[string] = here
                        continue
                    single[string], here = min(first, here), max(first, here)
                    key = (here[0] * 0x9E3779B1 + here[1] * 0x85EBCA77) & (MASK >> 1)
                    out.append((key, *here, 1, None))
        for string, here in single.items():
            out.append((xxhash.xxh3_64_intdigest(string) >> 1, *here, 1, string))
        if out:
            yield _batch(PIECE_SCHEMA, *zip(*out, strict=True))


def merged(starts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of starts (first, number) to spans of bytes (begin, end)."""
    out: list[list[int]] = []
    for start, count in sorted(starts):
        end = start + count + LENGTH - 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, doc_id, text) with doc the place of the document in the order. A unique id is the order itself; other
    tables are numbered, which writes them once."""
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, distinct = ids.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if rows == distinct and dict(ids.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint"):
        return ids.withColumn("doc", F.col("doc_id").cast("bigint"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("m"))
    return staged(numbered(ids.withColumn("_key", key), "_key", "doc").drop("_key"), "ordered")


def repeating_starts(
    texts: DataFrame, shard_bytes: int = SHARD_BYTES, budget: int = QUEUE_BYTES, hot_kinds: int = HOT_KINDS
) -> DataFrame:
    """(doc, start, count): runs of starts whose string starts earlier. texts: (doc, text)."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = texts.select("doc", "text").mapInArrow(_cut, "anchor bigint, mark bigint, doc bigint, start bigint, count bigint, sides bigint")
    sorted_rows = cut.repartition(parts, "anchor").sortWithinPartitions("anchor", "mark", "doc", "start")
    judged = staged(
        sorted_rows.mapInArrow(
            lambda batches: _judge(batches, hot_kinds), "anchor bigint, doc bigint, start bigint, count bigint, state int"
        ),
        "judged",
    )
    wanted = judged.where(F.col("state") != REPEAT).groupBy("doc")
    wanted = wanted.agg(F.collect_list(F.struct("anchor", "start", "count", "state")).alias("wanted"))
    pieces = texts.select("doc", "text").join(wanted, "doc").mapInArrow(
        _extract, "anchor bigint, doc bigint, start bigint, count bigint, data binary"
    )
    shards = pieces.repartition(parts, "anchor").sortWithinPartitions("anchor")
    found = shards.mapInArrow(_sorter(shard_bytes, budget), "doc bigint, start bigint, count bigint")
    return judged.where(F.col("state") == REPEAT).select("doc", "start", "count").union(found)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, text, and its removed spans of bytes."""
    texts = in_order(docs, id_col, text_col)
    starts = staged(repeating_starts(texts, **options), "repeating")
    starts = starts.groupBy("doc").agg(F.collect_list(F.struct("start", "count")).alias("starts"))
    return texts.join(starts, "doc", "left").select("doc_id", "text", "starts")


def query(spark, sf_dir):
    found = removals(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    @F.pandas_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def digest(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for text, runs in zip(texts, starts, strict=True):
            data = (text or "").encode()
            spans = merged([(r["start"], r["count"]) for r in runs]) if runs is not None else []
            kept, at = hashlib.sha256(), 0
            for lo, hi in spans:
                kept.update(data[at:lo])
                at = hi
            kept.update(data[at:])
            out.append((len(data), sum(hi - lo for lo, hi in spans), len(spans), kept.hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.select("doc_id", digest("text", "starts").alias("x")).select("doc_id", "x.*")
