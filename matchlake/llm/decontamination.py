"""Benchmark decontamination by the q-gram lemma.

An item of m characters that occurs in a text with at most k edits shares at least
m - q + 1 - k * q character q-grams with it, on at most k + 1 neighbouring diagonals (text place minus
item place). Each text is hashed into q-grams by vector operations; those the benchmark has are counted
in diagonal bands that overlap by half, so every such occurrence lies whole in one band. Bands that reach
the bound are verified by a banded alignment of the whole item, which gives place and edits. The filter
loses nothing; the alignment removes what it lets through.

Characters are lower-cased and white space is made a space one by one, so places are those of the text.

The benchmark is the stated query set: it is hashed into blocks of about BLOCK_CHARS characters, one
block is broadcast at a time, and each meets all documents. A long text is read in overlapping pieces. Short
texts are searched side by side, but an alignment never leaves its text.

Items under MIN_CHARS characters would match ordinary text with edits, so they must occur exactly, between
characters that are not letters or digits; those under Q characters must be the whole text but for white
space at its ends.

Cases: null and empty texts match nothing. Null and blank items are ignored; without any item nothing
matches. Equal items each match.
Repeated rows are judged alike; other columns are ignored, and kept by `decontaminate`.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import BLANKS, staged

Q, EDIT_RATE, MIN_CHARS = 10, 0.06, 30
BLOCK_CHARS = 4_000_000
# Characters handled at a time.
PIECE = 1 << 17
BASE = 0x9E3779B1
TABLE_BITS = 22
MATCH = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"
BREAK = "\uffff"


def _folding() -> np.ndarray:
    """Lower case, where it is one character, and white space to a space, for the first 65,536 characters."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        low = chr(c).lower()
        table[c] = 32 if chr(c).isspace() else ord(low) if len(low) == 1 else c
    return table


FOLD = _folding()


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) and points.max() < len(FOLD):
        return FOLD[points]
    return np.where(points < len(FOLD), FOLD[np.minimum(points, len(FOLD) - 1)], points)


def folded(text: str) -> str:
    return "".join(map(chr, codes(text).tolist())).strip()


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """32-bit polynomial hash of each window of Q = 10 characters, from windows of 2, 4 and 8.

    Hashes that collide only let more through the filter.
    """
    if len(points) < Q:
        return np.empty(0, np.uint32)
    power = [np.uint32(pow(BASE, n, 1 << 32)) for n in (1, 2, 4)]
    two = points[:-1] * power[0] + points[1:]
    four = two[:-2] * power[1] + two[2:]
    eight = four[:-4] * power[2] + four[4:]
    h = eight[:-2] * power[1] + two[8:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return h


class Index:
    """Hashes of the benchmark's q-grams with item and place of each."""

    def __init__(self, items: list[tuple[int, str]], edit_rate: float = EDIT_RATE):
        self.whole: dict[str, list[int]] = {}
        for i, text in items:
            if len(text) < Q:
                self.whole.setdefault(folded(text), []).append(i)
        items = [(i, text) for i, text in items if len(text) >= Q]
        self.ids = [i for i, _ in items]
        self.items = [codes(text) for _, text in items]
        self.edits = [int(edit_rate * len(x)) if len(x) >= MIN_CHARS else 0 for x in self.items]
        self.bounds = np.array([max(1, len(x) - Q + 1 - k * Q) for x, k in zip(self.items, self.edits, strict=True)])
        grams = [gram_hashes(x) for x in self.items]
        hashes = np.concatenate([np.empty(0, np.uint32), *grams])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.empty(0, np.int64), *[np.arange(len(g)) for g in grams]]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, self.first = np.unique(hashes[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.keys >> np.uint32(32 - TABLE_BITS)] = True
        self.longest = max((len(x) for x in self.items), default=0)
        # Bands are twice as wide as the diagonals of the most edits.
        self.step = max(self.edits, default=0) + 1

    def candidates(self, points: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, first diagonal) of the bands that reach the item's bound."""
        hashes = gram_hashes(points)
        at = np.flatnonzero(self.table[hashes >> np.uint32(32 - TABLE_BITS)])
        slot = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        known = self.keys[slot] == hashes[at]
        at, slot = at[known], slot[known]
        if not len(at):
            return
        times = self.count[slot]
        starts = np.cumsum(times) - times
        entry = np.repeat(self.first[slot] - starts, times) + np.arange(times.sum())
        item = self.owner[entry]
        band = (np.repeat(at, times) - self.place[entry] + self.longest) // self.step
        bands = len(points) // self.step + 2 * self.longest + 4
        keys = item * bands + band
        keys, counts = np.unique(np.concatenate([keys, keys - 1]), return_counts=True)
        full = counts >= self.bounds[keys // bands]
        for key in keys[full].tolist():
            yield key // bands, key % bands * self.step - self.longest

    def align(self, item: int, points: np.ndarray, diagonal: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best alignment of the item inside the band, within its edits.

        Characters outside places low to high equal none, so they are no better than leaving out the item's.
        A cell holds edits and start as one number, so one minimum decides both.
        """
        pattern, width = self.items[item], 2 * self.step
        lo = max(low, diagonal)
        hi = max(lo, min(high, diagonal + width + len(pattern)))
        text = np.full(width + len(pattern), 0xFFFFFFFF, np.uint32)
        text[lo - diagonal : hi - diagonal] = points[lo:hi]
        one = 1 << 32
        ramp = np.arange(width, dtype=np.int64) << 32
        limit = (self.edits[item] + 1) << 32
        # One more column stands for what lies outside the band.
        row = np.append(np.arange(width, dtype=np.int64), limit << 1)
        cells, skip = row[:width], np.empty(width, np.int64)
        differs = (text[np.arange(len(pattern))[:, None] + np.arange(width)] != pattern[:, None]) * np.int64(one)
        for j in range(len(pattern)):
            # Leaving out the item's character comes from the next diagonal, one of the text's from the last.
            np.add(row[1:], one, out=skip)
            np.add(cells, differs[j], out=cells)
            np.minimum(cells, skip, out=cells)
            np.subtract(cells, ramp, out=cells)
            np.minimum.accumulate(cells, out=cells)
            np.add(cells, ramp, out=cells)
            if not j % 32 and cells.min() >= limit:
                return None
        row = cells
        if row.min() >= limit:
            return None
        best = int(np.argmin(row))
        start = diagonal + int(row[best] & (one - 1))
        return start, diagonal + best + len(pattern), int(row[best] >> 32)

    def matches(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(part, item, start, end, edits), the best of those that overlap. Parts are places starts to ends."""
        found = set()
        seen = {}
        for item, diagonal in self.candidates(points):
            size, edits = len(self.items[item]), self.edits[item]
            first = max(0, int(np.searchsorted(starts, diagonal, "right")) - 1)
            last = int(np.searchsorted(starts, diagonal + 2 * self.step + size))
            for part in range(first, last):
                low, high = int(starts[part]), int(ends[part])
                if high - low < size - edits:
                    continue
                # A band that holds the diagonals of the last band's alignment would find it again.
                before = seen.get((part, item))
                if before is not None and diagonal + edits <= before < diagonal + self.step:
                    continue
                if hit := self.align(item, points, diagonal, low, high):
                    seen[part, item] = hit[0]
                    found.add((part, item, hit[2], max(low, hit[0]), min(hit[1], high)))
        kept: dict[tuple[int, int], list] = {}
        for part, item, edits, start, end in sorted(found):
            spans = kept.setdefault((part, item), [])
            if all(end <= s or start >= e for s, e, _ in spans):
                spans.append((start, end, edits))
        return [(part, item, s, e, n) for (part, item), spans in kept.items() for s, e, n in spans]

    def stands_alone(self, item: int, text: str, start: int, end: int) -> bool:
        """Whether a short item is not part of longer words; longer items need not be."""
        if len(self.items[item]) >= MIN_CHARS:
            return True
        before, after = text[max(0, start - 1) : start + 1], text[end - 1 : end + 1]
        return not (len(before) > 1 and before.isalnum()) and not (len(after) > 1 and after.isalnum())

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text (item_id, start, end, edits) rows by place."""
        out: list[set] = [set() for _ in texts]
        overlap = 2 * (self.longest + 2 * self.step)
        group, size = [], 0

        def flush():
            nonlocal group, size
            if not group:
                return
            joined = codes(BREAK.join(part for _, _, part in group))
            starts = np.cumsum([0, *[len(part) + 1 for _, _, part in group]])[:-1]
            ends = starts + [len(part) for _, _, part in group]
            for k, item, start, end, edits in self.matches(joined, starts, ends):
                row, offset, _ = group[k]
                start, end = offset + start - int(starts[k]), offset + end - int(starts[k])
                if self.stands_alone(item, texts[row], start, end):
                    out[row].add((self.ids[item], start, end, edits))
            group, size = [], 0

        if self.items:
            for row, text in enumerate(texts):
                for at in range(0, len(text or ""), PIECE):
                    part = text[max(0, at - overlap) : at + PIECE]
                    group.append((row, max(0, at - overlap), part))
                    size += len(part)
                    if size >= PIECE:
                        flush()
            flush()
        if self.whole:
            for row, text in enumerate(texts):
                inner = (text or "").strip()
                if 0 < len(inner) < Q:
                    start = text.index(inner)
                    out[row].update((i, start, start + len(inner), 0) for i in self.whole.get(folded(inner), ()))
        return [sorted(rows, key=lambda r: (r[1], r[2], r[3], str(r[0]))) for rows in out]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about block_chars characters, by hash."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"))
    items = items.where(F.length(F.btrim("text", F.lit(BLANKS))) > 0)
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for n in range(count):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == n)
        yield sorted(((r[0], r[1]) for r in mine.collect()), key=lambda r: (str(r[0]), r[1]))


def _searcher(parts):
    """Search as a column function over an index that is broadcast as plain arrays."""

    @F.pandas_udf(MATCH)
    def search(texts: pd.Series) -> pd.Series:
        here = Index.__new__(Index)
        vars(here).update(parts.value)
        names = ("item_id", "start", "end", "edits")
        return pd.Series([[dict(zip(names, r, strict=True)) for r in rows] for rows in here.search(list(texts))])

    return search


def with_matches(
    docs: DataFrame, benchmark: DataFrame, name: str, text_col="text", item_col="item_id", item_text_col="text",
    edit_rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Adds the matches of each document as an array.

    Of several blocks, each but the last is done before the next is read: the matches of its texts that
    have any are written, and its broadcast is dropped. They are joined to the documents by text at the end.
    """
    spark = docs.sparkSession
    none, before, index = F.array().cast(MATCH), None, None
    for items in blocks(benchmark, item_col, item_text_col, block_chars):
        if index is not None:
            texts = docs.select(F.md5(F.col(text_col).cast("binary")).alias("_text"), F.col(text_col).alias("_whole"))
            # Else the filter would search the texts once more.
            search = _searcher(index).asNondeterministic()
            found = texts.select("_text", search("_whole").alias("_found")).where(F.size("_found") > 0)
            found = staged(found, "benchmark-matches")
            before = found if before is None else before.union(found)
            index.destroy()
        index = spark.sparkContext.broadcast(vars(Index(items, edit_rate)))
    if index is None:
        return docs.withColumn(name, none)
    search = _searcher(index)
    if before is None:
        return docs.withColumn(name, search(F.col(text_col)))
    # Equal texts have equal matches in a block; the set has them once.
    before = before.groupBy("_text").agg(F.flatten(F.collect_set("_found")).alias("_before"))
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), F.md5(F.col(text_col).cast("binary")).alias("_key"))
    joined = packed.join(before, F.col("_key") == F.col("_text"), "left")
    found = F.concat(F.coalesce("_before", none), search(F.col("_doc")[text_col])).alias(name)
    return joined.select(*[F.col("_doc")[c].alias(c) for c in docs.columns], found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without a benchmark item, in their own columns."""
    packed = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).alias("text"))
    clean = with_matches(packed, benchmark, "matches", "text", **options).where(F.size("matches") == 0)
    return clean.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir):
    """One row per place where a document holds a benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "matches")
    return found.select("doc_id", F.inline("matches"))
