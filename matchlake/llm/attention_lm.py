"""Language-model scores: a small causal self-attention model over words, their spelling, and word counts.

Spelling. Words are lower-cased (A-Z) and cut by a public byte-pair vocabulary. The SPELLED ids are bytes and the most
frequent pieces of all training texts, each once for the inside and once for the end of a word, and one id for the
end of a text; rarer pieces are spelled in bytes. Every word has one spelling and no spelling begins another. Pieces are
counted over the corpus' distinct words, weighted by their counts, and so are the pairs of ids that follow each other in
a word; the driver gets one row per piece of the vocabulary and at most one per pair of ids.

Model. A word is its unit, the first id of its spelling (its byte, if the id is not among the IDS most frequent), and
then its ids. What stands at a place is the word before it: the vector of its unit and those of all its further ids.
Units come from the words before: one layer of causal attention over WINDOW words, a small network, and a softmax in two
steps (class, member). Every further id comes from the same state, the ids of the word so far, a second network and a
second softmax, so each id of each word is predicted from all before it in the window. All is trained in numpy on every
id of every word of every training text, in lessons of up to LESSON words; small corpora are passed several times.
A word's ids after the unit are also predicted by the counts of pairs of ids; both ways weigh TAILS and 1 - TAILS.
Training runs in ROUNDS rounds: each task makes steps of Adam on its lessons from the same weights, and their mean,
weighted by steps, starts the next round. At most WORKERS tasks send weights at a time. Windows overlap by half in
scoring: a window's second half is scored with at least WINDOW / 2 words before it, so each word is scored once, and a
window batch is one masked attention.

Counts. Words are counted over all training texts. Each task cuts its texts into blocks of about BLOCK_BYTES and numbers
a block's words, so texts are taken apart once and never shuffled; a block sends each of its distinct words once, with
its count, and gets back the corpus count and spelling under the word's number. A word in a third of all texts is one row
per block. Texts are stored by about STORED words, as numbers of the words that occur there, whose ids stand beside.
Nothing that grows with the vocabulary is broadcast or collected.

Score: the sum over words and end of log10(MIX * model + (1 - MIX) * count / N), a probability of the text: an
unseen word costs its spelling. base_score gives every unseen word half a count instead, as if it were the only one,
so on small corpora, where many words are unseen, it can lie above the score.

Cases: null and empty texts consist of the end. Rows with null ids belong to the training part (their id's text is
empty). Without training texts all counts are zero and the model keeps its first weights. Repeated rows count as often
as they occur; other columns are ignored.
"""

import base64
import ctypes
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial, wraps
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm import common
from matchlake.llm.common import scratch
from matchlake.llm.labels import remainder

PARTS, HELD_OUT = 5, 1
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
WINDOW, WIDTH, HIDDEN = 32, 16, 48
CLASSES, MEMBERS = 32, 32
IDS = CLASSES * MEMBERS
END, START = 512, IDS
SPELLED = 4096
# Classes and members of ids after a unit; what stands for a unit that several first ids share, and for a text's start.
TAIL_CLASSES = TAIL_MEMBERS = 64
SHARED, LEAD = SPELLED, SPELLED + 256
# Steps made at least (several passes over a small corpus), windows per step, rounds, words of a task in a round at
# least, tasks per round.
STEPS, BATCH, ROUNDS, TURN, WORKERS = 1500, 96, 16, 250_000, 64
# Words of a lesson, words that a task takes together, words of a stored row, pairs that a task holds, and words of blocks
# that it holds.
LESSON, TOGETHER, STORED, PAIRS, HELD = 512, 1 << 18, 1 << 20, 1 << 20, 1 << 18
MIX, TAILS = 0.5, 0.5
BLOCK_BYTES = 16 << 20
# Characters of texts that are cut into words together.
SLICE = 1 << 22
# A longer word is cut into runs of so many bytes before its pieces are sought.
LONG_WORD = 200
# Windows scored at a time.
WINDOWS = 192
TEXT_END = ""
# Bytes of a row group of what is stored: a task holds one in memory while it writes.
ROW_GROUP = 16 << 20

staged = partial(common.staged, row_group=ROW_GROUP)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def listed(words: pa.Array) -> list[bytes]:
    """As a list of bytes; to_pylist takes several times as long."""
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def parted(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The same for many texts: their words one after another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    # A blank text is split into one empty word.
    there = pc.not_equal(words, "")
    blank = np.flatnonzero(~there.to_numpy(zero_copy_only=False))
    sizes[np.searchsorted(np.cumsum(sizes), blank, side="right")] = 0
    return words.filter(there), sizes


def one_blas_thread() -> None:
    """Spark runs one task per core, so numpy's products must not start threads of their own in it."""
    for path in (Path(np.__file__).parent.parent / "numpy.libs").glob("lib*openblas*"):
        limit = getattr(ctypes.CDLL(str(path)), "scipy_openblas_set_num_threads64_", None)
        if limit:
            limit(1)


def giving_back(run: Callable) -> Callable:
    """Spark keeps its Python workers, so what a task no longer uses goes back to the system at the task's end."""

    @wraps(run)
    def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return freeing


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Spelling:
    """Words to ids. pieces: bytes of a piece to its id inside a word and at its end, none for bytes only."""

    def __init__(self, ranks: dict[bytes, int], pieces: dict[tuple[bytes, bool], int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: piece for piece, rank in ranks.items()}
        # Ids of every piece of the vocabulary inside a word, then of every piece at a word's end.
        most = max(ranks.values()) + 1
        spelled = [self._ids(self.bytes_of.get(r, b""), final, pieces) for final in (False, True) for r in range(most)]
        self.most, self.size = most, np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.begin = np.cumsum(self.size) - self.size
        self.ids = np.fromiter(chain.from_iterable(spelled), np.int64, int(self.size.sum()))

    @staticmethod
    def _ids(part: bytes, final: bool, pieces: dict) -> tuple:
        known = pieces.get((part, final))
        if known is not None:
            return (known,)
        return (*part[:-1], part[-1] + 256 * final) if part else ()

    def cut(self, word: bytes) -> list[int]:
        """Ranks of the pieces of a word."""
        if len(word) <= LONG_WORD:
            return self.encoding._encode_single_piece(word) if word else []
        parts = [word[i : i + LONG_WORD] for i in range(0, len(word), LONG_WORD)]
        return [i for p in parts for i in self.encoding._encode_single_piece(p)]

    def cut_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all words one after another (plus `most` at a word's end), and how many each word has."""
        cuts = list(map(self.cut, words))
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        flat = np.fromiter(chain.from_iterable(cuts), np.int64, int(sizes.sum()))
        flat[(np.cumsum(sizes) - 1)[sizes > 0]] += self.most
        return flat, sizes

    def spell_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has; the empty word is the end of a text."""
        flat, sizes = self.cut_all(words)
        lengths = self.size[flat]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(sizes)
        per_word = ends[last] - ends[last - sizes]
        ids = self.ids[np.repeat(self.begin[flat] - ends[:-1], lengths) + np.arange(ends[-1])]
        empty = np.flatnonzero(sizes == 0)
        ids = np.insert(ids, ends[last[empty]], END)
        per_word[empty] = 1
        return ids, per_word


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def choose_pieces(seen: dict[tuple[bytes, bool], int], ids: int = IDS) -> dict[tuple[bytes, bool], int]:
    """The most frequent pieces of more than one byte, with their place in a word, of counts of pieces."""
    long = [p for p in seen if len(p[0]) > 1]
    top = sorted(long, key=lambda p: (-seen[p], p))[: ids - END - 1]
    return {piece: END + 1 + k for k, piece in enumerate(top)}


class Rest:
    """Log probabilities of the ids of a word, given its unit, by counts of pairs. keys, counts: id * SPELLED + the id
    after it, SPELLED * SPELLED + a word's first id, in ascending order."""

    def __init__(self, pieces: dict, keys: np.ndarray, counts: np.ndarray):
        inside = keys < SPELLED * SPELLED
        self.keys, self.counts = keys[inside], counts[inside].astype(np.float64)
        before, after = np.divmod(self.keys, SPELLED)
        # An id is followed by something new about as often as it has been by different ids.
        self.new = np.bincount(before, minlength=SPELLED) + 0.5
        self.total = np.bincount(before, self.counts, SPELLED) + self.new
        share = np.bincount(after, self.counts, SPELLED) + 0.1
        self.share = share / share.sum()
        # Ids without a piece never occur.
        self.unit = np.where(np.arange(SPELLED) < IDS, np.arange(SPELLED), 0)
        for (part, _), k in pieces.items():
            if k >= IDS:
                self.unit[k] = part[0]
        first = np.zeros(SPELLED)
        first[keys[~inside] - SPELLED * SPELLED] = counts[~inside]
        self.units = np.bincount(self.unit, first, SPELLED)[:IDS]
        first += 0.1
        self.first = np.log(first / np.bincount(self.unit, first, SPELLED)[self.unit])
        # How often each id comes after a unit: further ids, and first ids where several share the unit.
        self.told = np.bincount(after, self.counts, SPELLED) + np.where(self.unit < 256, first - 0.1, 0)

    def logs(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Natural logarithm for each word; their ids one after another, from these places."""
        before = np.append(END, ids[:-1])
        key = before * SPELLED + ids
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        n = np.where(self.keys[at] == key, self.counts[at], 0) if len(self.keys) else 0
        step = np.log((n + self.new[before] * self.share[ids]) / self.total[before])
        step[begin] = self.first[ids[begin]]
        return np.add.reduceat(step, begin)


def summed(ids: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each id."""
    order = np.argsort(ids.astype(np.int16), kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[ids[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def flat(a: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One product over all places instead of one per window."""
    return (a.reshape(-1, a.shape[-1]) @ weights).reshape(*a.shape[:-1], -1)


def softmax(x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """In place. A bound keeps exponentials finite, which takes fewer passes than the row's maximum."""
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    if mask is not None:
        x *= mask
    x /= (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(*x.shape[:-1], 1)
    return x


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of runs of these sizes that begin there, one run after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def run_totals(rows: np.ndarray, size: np.ndarray, back: bool = False) -> np.ndarray:
    """Running sums inside runs of rows of these sizes, in place; back: from each run's end."""
    ends = np.cumsum(size)
    at, one, left = (ends - 1, -1, size) if back else (ends - size, 1, size)
    while len(at):
        more = left > 1
        at, left = at[more] + one, left[more] - 1
        rows[at] += rows[at - one]
    return rows


def run_sums(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of runs of rows of these sizes, zero for empty ones; rows become running sums."""
    out = np.zeros((len(size), rows.shape[1]), rows.dtype)
    there = np.flatnonzero(size)
    out[there] = run_totals(rows, size[there])[np.cumsum(size[there]) - 1]
    return out


class Spelled:
    """Words by the ids the model predicts: the place of a word's unit, SHARED and the unit if several first ids have
    it, and the ids of its spelling.

    ids: spellings one after another; a run that stands for a text's start is LEAD alone."""

    def __init__(self, ids: np.ndarray, tables: dict[str, np.ndarray]):
        ids = ids.astype(np.int64)
        ends = np.flatnonzero(tables["final"][ids]) + 1
        self.spelt_size = np.diff(ends, prepend=0)
        self.spelt_begin = ends - self.spelt_size
        unit = tables["unit"][ids[self.spelt_begin]]
        self.units = tables["place"][unit]
        # Bytes are the units of rarer pieces too.
        shared = unit < 256
        self.ids = np.insert(ids, self.spelt_begin[shared], SHARED + unit[shared])
        # Each id but a word's first is predicted from those before it.
        self.steps = self.spelt_size + shared - 1
        self.steps_begin = np.cumsum(self.steps) - self.steps
        self.from_at = spread(self.steps_begin + np.arange(len(ends)), self.steps)


def causal(first: int, n: int) -> np.ndarray:
    """Which of n places each place from the first on may look at."""
    return (np.arange(first, n)[:, None] >= np.arange(n)).astype(np.float32)


class Attention:
    """Weights and passes. Ids are renumbered by frequency, so that a class holds ids of like frequency."""

    def __init__(self, counts: np.ndarray, tails: np.ndarray | None = None):
        rng = np.random.default_rng(7)
        order = np.argsort(-counts, kind="stable")
        self.place = np.empty(IDS, np.int64)
        self.place[order] = np.arange(IDS)
        tails = np.zeros(SPELLED) if tails is None else tails
        tail_order = np.argsort(-tails, kind="stable")
        self.tail_place = np.empty(SPELLED, np.int64)
        self.tail_place[tail_order] = np.arange(SPELLED)

        def draw(*shape, scale=None):
            return (rng.standard_normal(shape) * (scale or 1 / math.sqrt(shape[0]))).astype(np.float32)

        share = np.log((counts[order] + 0.1) / (counts.sum() + 0.1 * IDS)).reshape(CLASSES, MEMBERS)
        total = np.log(np.exp(share).sum(1))
        self.w = {
            "embed": draw(IDS + 1, WIDTH, scale=0.3), "prior": draw(IDS + 1, WIDTH, scale=0.1), "position": draw(WINDOW, WIDTH, scale=0.1),
            "query": draw(WIDTH, WIDTH), "key": draw(WIDTH, WIDTH), "value": draw(WIDTH, WIDTH),
            "out": draw(WIDTH, WIDTH), "up": draw(WIDTH, HIDDEN), "up_bias": np.zeros(HIDDEN, np.float32),
            "down": draw(HIDDEN, WIDTH), "classes": draw(WIDTH, CLASSES, scale=0.05),
            "class_bias": total.astype(np.float32), "members": draw(CLASSES, WIDTH, MEMBERS, scale=0.05),
            "member_bias": (share - total[:, None]).astype(np.float32),
        }
        share = np.log((tails[tail_order] + 0.1) / (tails.sum() + 0.1 * SPELLED)).reshape(TAIL_CLASSES, TAIL_MEMBERS)
        total = np.log(np.exp(share).sum(1))
        self.w |= {
            "piece": draw(LEAD, WIDTH, scale=0.1), "last": draw(LEAD, WIDTH, scale=0.3),
            "tail_up": draw(WIDTH, HIDDEN), "tail_up_bias": np.zeros(HIDDEN, np.float32), "tail_down": draw(HIDDEN, WIDTH),
            "tail_classes": draw(WIDTH, TAIL_CLASSES, scale=0.05), "tail_class_bias": total.astype(np.float32),
            "tail_members": draw(TAIL_CLASSES, WIDTH, TAIL_MEMBERS, scale=0.05),
            "tail_member_bias": (share - total[:, None]).astype(np.float32),
        }

    def attend(self, ids: np.ndarray, first: int, more: np.ndarray | None = None) -> dict:
        """State of places first.. of each window. ids: (windows, WINDOW), what stands before each place; more: what its
        further ids add."""
        w, n = self.w, ids.shape[1]
        x = w["embed"][ids]
        x += w["position"][:n]
        if more is not None:
            x += more
        # The id before the last one, inside the window.
        x[:, 1:] += w["prior"][ids[:, :-1]]
        late = x[:, first:]
        q, k, v = flat(late, w["query"]), flat(x, w["key"]), flat(x, w["value"])
        scores = q @ k.transpose(0, 2, 1)
        scores *= np.float32(1 / math.sqrt(WIDTH))
        a = softmax(scores, causal(first, n))
        mixed = a @ v
        h = late + flat(mixed, w["out"])
        up = flat(h, w["up"])
        up += w["up_bias"]
        np.maximum(up, 0, out=up)
        return {"x": x, "q": q, "k": k, "v": v, "a": a, "mixed": mixed, "h": h, "up": up, "z": h + flat(up, w["down"])}

    def states(self, ids: np.ndarray, first: int, more: np.ndarray | None = None) -> np.ndarray:
        """What attend gives as z, without the parts that only slopes need."""
        w, rows, n = self.w, len(ids), ids.shape[1]
        m = n - first

        x = w["embed"].take(ids, axis=0)
        x += w["position"][:n]
        x[:, 1:] += w["prior"].take(ids[:, :-1], axis=0)
        if more is not None:
            x += more
        h = np.ascontiguousarray(x[:, first:])
        kv = flat(x, np.concatenate([w["key"], w["value"]], axis=1))
        e = flat(h, w["query"] * np.float32(1 / math.sqrt(WIDTH))) @ kv[..., :WIDTH].transpose(0, 2, 1)
        h += flat(softmax(e, causal(first, n)) @ kv[..., WIDTH:], w["out"])
        up = flat(h, w["up"])
        up += w["up_bias"]
        np.maximum(up, 0, out=up)
        h += flat(up, w["down"])
        return h.reshape(rows, m, WIDTH)

    def log_probabilities(self, z: np.ndarray, target: np.ndarray, of: str = "") -> np.ndarray:
        """Natural logarithms for states z: (n, WIDTH) and targets by place. of: "tail_" for ids after a unit."""
        w = [self.w[of + k] for k in ("classes", "class_bias", "members", "member_bias")]
        groups, many = w[3].shape
        group = (target // many).astype(np.uint8)
        # In order of class, which small whole numbers are brought into quickly.
        order = np.argsort(group, kind="stable")
        target, group = target.take(order), group.take(order)
        # A last column of ones takes the biases along in the products.
        one = np.ones((len(z), WIDTH + 1), z.dtype)
        one[:, :WIDTH] = z.take(order, axis=0)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=groups))])
        members = np.empty((len(z), many), z.dtype)
        weights = np.concatenate([w[2], w[3][:, None]], axis=1)
        for c in range(groups):
            if cuts[c] < cuts[c + 1]:
                np.matmul(one[cuts[c] : cuts[c + 1]], weights[c], out=members[cuts[c] : cuts[c + 1]])
        classes = one @ np.concatenate([w[0], w[1][None]])
        at = np.arange(len(z))
        got = classes.ravel().take(at * groups + group) + members.ravel().take(at * many + target % many)
        np.exp(classes, out=classes)
        np.exp(members, out=members)
        got -= np.log((classes @ np.ones(groups, z.dtype)) * (members @ np.ones(many, z.dtype)))
        out = np.empty_like(got)
        out[order] = got
        return out

    def tail_states(self, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the second network makes of what an id comes from, and its hidden layer."""
        up = r @ self.w["tail_up"]
        up += self.w["tail_up_bias"]
        np.maximum(up, 0, out=up)
        return r + up @ self.w["tail_down"], up

    def softmax_slopes(self, z: np.ndarray, target: np.ndarray, of: str, g: dict) -> tuple[float, np.ndarray]:
        """Loss of the targets and its slopes at z; those of the weights go into g."""
        w = [self.w[of + k] for k in ("classes", "class_bias", "members", "member_bias")]
        (groups, many), n, at = w[3].shape, len(target), np.arange(len(target))
        # In order of class, so that a class is one slice.
        order = np.argsort(target.astype(np.int16), kind="stable")
        z, group, member = z[order], *np.divmod(target[order], many)
        cuts = np.searchsorted(group, np.arange(groups + 1))
        there = [(c, slice(cuts[c], cuts[c + 1])) for c in np.flatnonzero(np.diff(cuts)).tolist()]
        pc = softmax(z @ w[0] + w[1])
        pm = np.empty((n, many), z.dtype)
        for c, mine in there:
            np.matmul(z[mine], w[2][c], out=pm[mine])
            pm[mine] += w[3][c]
        pm = softmax(pm)
        chosen = pc.reshape(-1), at * groups + group, pm.reshape(-1), at * many + member
        loss = -np.log(chosen[0][chosen[1]] + 1e-30).sum() - np.log(chosen[2][chosen[3]] + 1e-30).sum()
        chosen[0][chosen[1]] -= 1
        chosen[2][chosen[3]] -= 1
        g |= {of + "classes": z.T @ pc, of + "class_bias": pc.sum(0)}
        g[of + "members"], g[of + "member_bias"] = np.zeros_like(w[2]), np.zeros_like(w[3])
        dz = pc @ w[0].T
        for c, mine in there:
            g[of + "members"][c], g[of + "member_bias"][c] = z[mine].T @ pm[mine], pm[mine].sum(0)
            dz[mine] += pm[mine] @ w[2][c].T
        back = np.empty_like(dz)
        back[order] = dz
        return loss, back

    def tail_slopes(self, z: np.ndarray, words: Spelled, told: np.ndarray, g: dict) -> tuple[float, np.ndarray, list]:
        """Loss of the ids after the units of the words told at states z: (n, WIDTH), and its slopes at z; those of the
        weights go into g, but for those of pieces, (ids, rows), which are returned."""
        w, size = self.w, words.steps[told]
        at = words.from_at[spread(words.steps_begin[told], size)]
        if not len(at):
            return 0.0, np.zeros_like(z), []
        owner, ids, some = np.repeat(np.arange(len(told)), size), words.ids[at], size[size > 0]
        r = z[owner] + w["last"][ids] + run_totals(w["piece"][ids], some)
        y, up = self.tail_states(r)
        loss, dy = self.softmax_slopes(y, self.tail_place[words.ids[at + 1]], "tail_", g)
        g["tail_down"] = up.T @ dy
        dup = dy @ w["tail_down"].T
        dup *= up > 0
        g["tail_up"], g["tail_up_bias"] = r.T @ dup, dup.sum(0)
        dr = dy + dup @ w["tail_up"].T
        g["last"] = summed(ids, dr, LEAD)
        # An id stands before all that follow it in the word, and the state before all of them.
        dr, dz = run_totals(dr, some, back=True), np.zeros_like(z)
        dz[size > 0] = dr[np.cumsum(some) - some]
        return loss, dz, [(ids, dr)]

    def further(self, words: Spelled, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sums of the vectors of the ids after the unit of the words before, these ids, how many each word has)."""
        flat = before.reshape(-1)
        size = words.steps[flat]
        ids = words.ids[words.from_at[spread(words.steps_begin[flat], size)] + 1]
        return run_sums(self.w["piece"][ids], size).reshape(*before.shape, WIDTH), ids, size

    def gradients(self, ids: np.ndarray, target: np.ndarray, words: Spelled | None = None, at: tuple | None = None) -> tuple[float, dict]:
        """Loss per place and its slopes. at: the words before the places and those at them; without words units only."""
        w, n = self.w, target.size
        more = None
        if words is not None:
            more, more_ids, more_size = self.further(words, at[0])
        s, g, pieces = self.attend(ids, 0, more), {}, []
        z = s["z"].reshape(n, WIDTH)
        loss, dz = self.softmax_slopes(z, target.reshape(n), "", g)
        if words is not None:
            tail_loss, tail_dz, pieces = self.tail_slopes(z, words, at[1].reshape(n), g)
            loss, dz = loss + tail_loss, dz + tail_dz
        dz = dz.reshape(s["z"].shape)

        def flat_product(a, b):
            return a.reshape(-1, a.shape[-1]).T @ b.reshape(-1, b.shape[-1])

        g["down"] = flat_product(s["up"], dz)
        dup = flat(dz, w["down"].T)
        dup *= s["up"] > 0
        g["up"], g["up_bias"] = flat_product(s["h"], dup), dup.reshape(-1, HIDDEN).sum(0)
        dh = dz + flat(dup, w["up"].T)
        g["out"] = flat_product(s["mixed"], dh)
        dmixed = flat(dh, w["out"].T)
        ds = dmixed @ s["v"].transpose(0, 2, 1)
        dv = s["a"].transpose(0, 2, 1) @ dmixed
        # The sum over a place's weights times their slopes is that of its mixture.
        ds -= np.einsum("bij,bij->bi", dmixed, s["mixed"])[..., None]
        ds *= s["a"]
        ds *= np.float32(1 / math.sqrt(WIDTH))
        dq, dk = ds @ s["k"], ds.transpose(0, 2, 1) @ s["q"]
        g["query"], g["key"], g["value"] = (flat_product(s["x"], d) for d in (dq, dk, dv))
        dx = dh + flat(dq, w["query"].T) + flat(dk, w["key"].T) + flat(dv, w["value"].T)
        g["position"] = np.zeros_like(w["position"])
        g["position"][: ids.shape[1]] = dx.sum(0)
        g["embed"] = summed(ids.reshape(-1), dx.reshape(-1, WIDTH), IDS + 1)
        g["prior"] = summed(ids[:, :-1].reshape(-1), dx[:, 1:].reshape(-1, WIDTH), IDS + 1)
        if words is not None:
            pieces.append((more_ids, np.repeat(dx.reshape(-1, WIDTH), more_size, axis=0)))
            piece_ids, rows = (np.concatenate(x) for x in zip(*pieces, strict=True))
            if len(piece_ids):
                g["piece"] = summed(piece_ids, rows, LEAD)
        for grad in g.values():
            grad /= n
        return loss / n, g

    def step(self, words: Spelled, at: tuple[np.ndarray, np.ndarray], m: dict, s: dict, rate: float) -> None:
        """One step of Adam on the words at these places, each after the one before; m and s hold the running moments."""
        _, g = self.gradients(words.units[at[0]], words.units[at[1]], words, at)
        for k, grad in g.items():
            m[k] += np.float32(0.1) * (grad - m[k])
            grad *= grad
            grad -= s[k]
            s[k] += np.float32(0.01) * grad
            # Rounding must not leave a square below zero.
            np.maximum(s[k], 0, out=s[k])
            by = np.sqrt(s[k])
            by += np.float32(1e-8)
            self.w[k] -= np.float32(rate) * m[k] / by

    def score(self, stream: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Natural log probability of each id. stream: the ids of texts of these sizes, one after another."""
        return self.score_places(self.place[stream], sizes)

    def score_places(self, target: np.ndarray, sizes: np.ndarray, words: Spelled | None = None, told: np.ndarray | None = None):
        """The same for places of ids. With words, the log probabilities of units and of the ids after them: told is
        which word stands at each place."""
        starts = np.cumsum(sizes) - sizes
        before = np.concatenate([[START], target[:-1]])
        before[starts] = START
        out = np.empty(len(target), np.float32)
        if words is not None:
            # What depends on the word alone is worked out once; nothing is added before a text.
            tails, last = np.zeros(len(target), np.float32), len(words.units)
            added = np.append(self.further(words, np.arange(last))[0], np.zeros((1, WIDTH), np.float32), axis=0)
            ids = words.ids[words.from_at]
            static = self.w["last"][ids] + run_totals(self.w["piece"][ids], words.steps[words.steps > 0])
            aim = self.tail_place[words.ids[words.from_at + 1]]
            word_before = np.concatenate([[last], told[:-1]])
            word_before[starts] = last
        half = WINDOW // 2
        # A text's first window is scored whole, each later one in its second half.
        later = np.maximum(0, -(-(sizes - WINDOW) // half))
        text = np.repeat(np.arange(len(sizes)), later)
        turn = np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later)
        for begin, first in ((starts, 0), (starts[text] + (turn + 1) * half, half)):
            owner = np.arange(len(sizes)) if first == 0 else text
            end = (starts + sizes)[owner]
            for lo in range(0, len(begin), WINDOWS):
                at = begin[lo : lo + WINDOWS, None] + np.arange(WINDOW)
                inside = at < end[lo : lo + WINDOWS, None]
                known = np.minimum(at, len(target) - 1)
                more = None if words is None else added.take(word_before[known], axis=0)
                state = self.states(before[known], first, more)
                inside, places = inside[:, first:], at[:, first:]
                places, state = places[inside], state[inside]
                out[places] = self.log_probabilities(state, target[places])
                if words is not None:
                    mine = told[places]
                    size = words.steps[mine]
                    at = spread(words.steps_begin[mine], size)
                    y, _ = self.tail_states(np.repeat(state, size, axis=0) + static.take(at, axis=0))
                    logs = self.log_probabilities(y, aim.take(at), "tail_")
                    tails[places] = run_sums(logs[:, None], size)[:, 0]
        return out if words is None else (out, tails)


def _pieces(vocabulary: dict[bytes, int]):
    """(piece, count) of the training words of a task; pieces at a word's end have the vocabulary's size added, and the
    end of a text is -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = Spelling(vocabulary, {})
        seen, ends = np.zeros(2 * spell.most), 0
        for batch in batches:
            counts = batch.column("count").to_numpy()
            flat, sizes = spell.cut_all(listed(batch.column("word")))
            seen += np.bincount(flat, np.repeat(counts, sizes), len(seen))
            ends += int(counts[sizes == 0].sum())
        there = np.flatnonzero(seen)
        numbers = [pa.array([*there.tolist(), -1], pa.int64()), pa.array([*seen[there].astype(np.int64).tolist(), ends], pa.int64())]
        yield pa.RecordBatch.from_arrays(numbers, names=["piece", "count"])

    return giving_back(run)


def _pairs(shared):
    """(pair, count) of the training words of a task, as Rest takes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, held = Spelling(*shared.value), []

        def together():
            pair, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pair, np.bincount(place, np.concatenate([n for _, n in held]), len(pair)).astype(np.int64)

        for batch in batches:
            counts = batch.column("count").to_numpy()
            ids, sizes = spell.spell_all(listed(batch.column("word")))
            pair = np.append(SPELLED, ids[:-1]) * SPELLED + ids
            first = np.cumsum(sizes) - sizes
            pair[first] = SPELLED * SPELLED + ids[first]
            held.append((pair, np.repeat(counts, sizes)))
            if sum(len(p) for p, _ in held) > PAIRS:
                held = [together()]
                if len(held[0][0]) > PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held.pop()], names=["pair", "count"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in together()], names=["pair", "count"])

    return giving_back(run)


def first_model(words: DataFrame, ranks: dict[bytes, int]) -> tuple[Attention, dict[tuple[bytes, bool], int], Rest]:
    """Untrained model, its pieces, and what follows a unit, by the corpus' counts. words: (word, count)."""
    counted = words.mapInArrow(_pieces(ranks), "piece bigint, count bigint").groupBy("piece").agg(F.sum("count"))
    rows = dict(counted.collect())
    rows.pop(-1, 0)
    most = max(ranks.values()) + 1
    bytes_of = {rank: piece for piece, rank in ranks.items()}
    seen = {(bytes_of[k % most], k >= most): n for k, n in rows.items()}
    pieces = choose_pieces(seen, SPELLED)
    shared = words.sparkSession.sparkContext.broadcast((ranks, pieces))
    pairs = words.mapInArrow(_pairs(shared), "pair bigint, count bigint").groupBy("pair").agg(F.sum("count").alias("count"))
    pairs = pairs.toArrow()
    keys, counts = pairs["pair"].to_numpy(), pairs["count"].to_numpy()
    order = np.argsort(keys)
    rest = Rest(pieces, keys[order], counts[order])
    return Attention(rest.units, rest.told), pieces, rest


def tables_of(model: Attention, pieces: dict[tuple[bytes, bool], int], rest: Rest) -> dict[str, np.ndarray]:
    """What Spelled takes: the unit of each id, the place of each unit, and which ids end a word."""
    final = np.zeros(LEAD + 1, bool)
    final[256 : END + 1] = final[LEAD] = True
    final[[k for (_, ends), k in pieces.items() if ends]] = True
    unit = np.full(LEAD + 1, START)
    unit[:SPELLED] = rest.unit
    return {"unit": unit, "place": np.append(model.place, START), "final": final}


def _flat(*parts: dict) -> bytes:
    return np.concatenate([part[k].ravel() for part in parts for k in sorted(part)]).astype(np.float32).tobytes()


def _parted(flat: np.ndarray, like: dict) -> list[dict]:
    """Undoes _flat for parts with the shapes of `like`."""
    out, at = [], 0
    while at < len(flat):
        part = {}
        for k in sorted(like):
            part[k] = flat[at : at + like[k].size].reshape(like[k].shape)
            at += like[k].size
        out.append(part)
    return out


def grouped(sizes: list[int], most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Bounds of groups of items one after another, of about so many words each."""
    lo, size = 0, 0
    for hi, more in enumerate(sizes, 1):
        size += more
        if size >= most or hi == len(sizes):
            yield lo, hi
            lo, size = hi, 0


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row of a batch after the other, as these are large."""
    return (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows))


def _lessons(tables: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for chunk in rows_of(batch):
                # The last word stands for a text's start.
                spelt = np.append(np.frombuffer(chunk["ids"], np.int16), np.int16(LEAD))
                numbers, words = unpacked_small(chunk["numbers"]), Spelled(spelt, tables)
                units, lead, end = words.units.astype(np.int16), len(words.units) - 1, 0
                for doc, held, size in zip(chunk["doc_id"], chunk["held_out"], chunk["n_tokens"], strict=True):
                    end += size
                    if held:
                        continue
                    # Each lesson begins with the word before it.
                    mine = np.append(lead, numbers[end - size : end])
                    for n, at in enumerate(range(0, size, LESSON)):
                        part = mine[at : at + LESSON + 1]
                        ids = spelt[spread(words.spelt_begin[part], words.spelt_size[part])]
                        rows.append((doc, n, units[part].tobytes(), ids.tobytes()))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "spelt"])

    return run


def lessons(coded: DataFrame, tables: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, n, ids, spelt) of every word of every training text, the end included: the places of up to LESSON words'
    units, after that of the word before, and the ids of these words."""
    mine = coded.select("doc_id", "held_out", "n_tokens", "numbers", "ids")
    return mine.mapInArrow(_lessons(tables), "doc_id bigint, n int, ids binary, spelt binary")


def windows(runs: list[np.ndarray], rng) -> tuple[np.ndarray, np.ndarray]:
    """Windows of lessons in random order, from a random start: what stands before each place, and the targets. The
    last one goes on with the first words, so that each word is a target."""
    before = np.concatenate([r[:-1] for r in runs]).astype(np.int64)
    target = np.concatenate([r[1:] for r in runs]).astype(np.int64)
    first = np.arange(0, len(target), WINDOW) + int(rng.integers(0, WINDOW))
    at = (rng.permutation(first)[:, None] + np.arange(WINDOW)) % len(target)
    return before[at], target[at]


def words_and_runs(spelt: list[bytes], tables: dict[str, np.ndarray]) -> tuple[Spelled, list[np.ndarray]]:
    """The words of lessons, and which of them each lesson has."""
    lessons = [np.frombuffer(ids, np.int16) for ids in spelt]
    ends = np.cumsum([np.count_nonzero(tables["final"][ids]) for ids in lessons])
    return Spelled(np.concatenate(lessons), tables), np.split(np.arange(ends[-1]), ends[:-1])


def _turn(shared, tables: dict[str, np.ndarray], number: int, rounds: int, passes: int):
    """One task's steps in a round: (steps, weights and moments)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        model = Attention.__new__(Attention)
        model.tail_place, parts = shared.value
        model.w, m, s = ({k: v.copy() for k, v in part.items()} for part in parts)
        rng, steps = np.random.default_rng(11 + number), 0
        for batch in batches:
            spelt = batch.column("spelt").to_pylist()
            # An id takes two bytes, and a word takes two or three ids.
            for first, last in grouped([len(ids) // 5 for ids in spelt]):
                words, runs = words_and_runs(spelt[first:last], tables)
                for n in range(passes):
                    before, told = windows(runs, rng)
                    for lo in range(0, len(told), BATCH):
                        # Slow at the very start, and ever slower over the rounds.
                        done = (number + n / passes) / rounds
                        rate = 0.01 * min(1, (steps + 1) / 50 + number) * (0.1 + 0.9 * (1 - done))
                        model.step(words, (before[lo : lo + BATCH], told[lo : lo + BATCH]), m, s, rate)
                        steps += 1
        if steps:
            part = TaskContext.get().partitionId()
            row = [pa.array([part], pa.int32()), pa.array([steps], pa.int64()), pa.array([_flat(model.w, m, s)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, names=["part", "steps", "state"])

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of at most WORKERS states, weighted by steps."""
    sums, total = 0, 0
    for batch in batches:
        for n, state in zip(batch.column("steps").to_pylist(), batch.column("state"), strict=True):
            sums, total = sums + n * np.frombuffer(state.as_py(), np.float32).astype(np.float64), total + n
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([(sums / total).astype(np.float32).tobytes()], pa.binary())], names=["state"])


def train(model: Attention, found: DataFrame, total: int, steps: int) -> Attention:
    """Trains on all lessons in rounds; the tasks of a round start from the mean of those of the round before. total:
    words of the lessons. The model holds the tables of its words."""
    if not total:
        return model
    spark, rounds = found.sparkSession, max(1, min(ROUNDS, steps))
    workers = min(WORKERS, max(2, -(-total // (rounds * TURN))))
    mark = F.xxhash64("doc_id", "n", F.lit("turn"))
    dealt = found.select(
        mark.alias("mark"), "spelt", F.pmod(mark, F.lit(rounds)).cast("int").alias("round"),
        F.pmod(F.shiftright(mark, 8), F.lit(workers)).cast("int").alias("worker"),
    )
    path = scratch(spark, "turns")
    dealt = dealt.repartition(rounds * workers, "round", "worker").sortWithinPartitions("round", "worker", "mark", "spelt")
    dealt.write.partitionBy("round").option("compression", "zstd").parquet(path)
    passes = max(1, -(-steps * BATCH * WINDOW // total))
    zero = {k: np.zeros_like(v) for k, v in model.w.items()}
    state = [model.w, zero, zero]
    there = {r[0] for r in spark.read.schema("round int").parquet(path).distinct().collect()}
    # Several passes over a small corpus are taken by several rounds, so that a round does not learn a few texts by heart.
    span = min(passes, rounds)
    passes = -(-passes // span)
    for number in range(rounds):
        folders = [f"{path}/round={k}" for k in sorted({(number + n) % rounds for n in range(span)} & there)]
        if not folders:
            continue
        shared = spark.sparkContext.broadcast((model.tail_place, state))
        mine = spark.read.schema("spelt binary").parquet(*folders).coalesce(workers)
        turns = mine.mapInArrow(_turn(shared, model.tables, number, rounds, passes), "part int, steps bigint, state binary")
        means = turns.repartition(1).sortWithinPartitions("part").mapInArrow(_mean, "state binary").collect()
        if means:
            state = _parted(np.frombuffer(means[0].state, np.float32), model.w)
        shared.destroy()
    model.w = state[0]
    return model


CUT = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("numbers", pa.binary()), ("n", pa.int32()),
    ("word", pa.string()), ("count", pa.int64()),
])


def packed(numbers: np.ndarray) -> bytes:
    """The low halves of 32-bit numbers, then the high ones, which are mostly alike and so take little room."""
    return np.ascontiguousarray(numbers.astype("<i4").view("<u2").reshape(-1, 2).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(2, -1).T).view("<i4").ravel()


def packed_small(numbers: np.ndarray) -> bytes:
    """How many bytes a number takes, then the lowest bytes of all numbers, the next ones, ..."""
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([width]) + numbers.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def unpacked_small(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i4").ravel()


def _rows(size: int, **columns) -> pa.RecordBatch:
    """Rows of CUT; columns that are not given are null."""
    given = {name: c if isinstance(c, pa.Array) else pa.array(c, CUT.field(name).type) for name, c in columns.items()}
    arrays = [given[f.name] if f.name in given else pa.nulls(size, f.type) for f in CUT]
    return pa.RecordBatch.from_arrays(arrays, schema=CUT)


def _cut(block_bytes: int):
    """Cuts a task's texts into blocks: rows of texts, their words by number in the block, and then rows of the block's
    words (n, word, count in training texts). Words of held-out texts alone come with count 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, learned = TaskContext.get().partitionId() << 32, 0, []
        number = defaultdict(int)
        # A word that is not there yet gets the next number.
        number.default_factory = number.__len__

        def ended():
            words = pa.array(list(number), pa.binary()).cast(pa.string())
            counts = np.bincount(np.concatenate(learned), minlength=len(words))
            return _rows(len(words), block=np.full(len(words), block), n=np.arange(len(words)), word=words, count=counts)

        def cut(texts: pa.RecordBatch) -> pa.RecordBatch:
            words, sizes = parted(texts.column("text"))
            words = words.dictionary_encode()
            found = np.fromiter(map(number.__getitem__, listed(words.dictionary)), np.int32, len(words.dictionary))
            ends = np.cumsum(sizes + 1)
            numbers = np.insert(found[words.indices.to_numpy()], ends - np.arange(1, len(ends) + 1), number[TEXT_END.encode()])
            held = texts.column("held_out").to_numpy(zero_copy_only=False)
            learned.append(numbers[np.repeat(~held, sizes + 1)])
            columns = {c: texts.column(c) for c in ("doc_id", "held_out")}
            return _rows(len(ends), block=np.full(len(ends), block), numbers=[packed(part) for part in np.split(numbers, ends[:-1])], **columns)

        for batch in batches:
            first, taken, lengths = 0, 0, pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            for last, length in enumerate(lengths, 1):
                size, taken = size + length + 1, taken + length
                if size >= block_bytes or taken >= SLICE or last == len(lengths):
                    yield cut(batch.slice(first, last - first))
                    first, taken = last, 0
                if size >= block_bytes:
                    yield ended()
                    number.clear()
                    learned.clear()
                    block, size = block + 1, 0
        if number:
            yield ended()

    return giving_back(run)


# What a block gets back for its words, as arrays one after another.
FOUND = {"n": np.int32, "count": np.int64, "rest": np.float32, "ids": np.int16}


def _spelled(shared):
    """Per word of a block its corpus count, the natural logarithm of its ids given the unit by counts of pairs, and its
    ids, all of which the model predicts. Rows of a word lie together, so that most words are spelled once and not once
    per block. A block's words of up to HELD rows are one row of arrays."""

    def together(held: list[tuple]) -> pa.RecordBatch:
        block, *columns, ids, size = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(block, kind="stable")
        block = block[order]
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        ids, size = ids[spread((np.cumsum(size) - size)[order], size[order])], size[order]
        parts = [np.split(c[order], first[1:]) for c in columns] + [np.split(ids, np.cumsum(size)[first[1:] - 1])]
        arrays = [pa.array([x.astype(kind).tobytes() for x in part], pa.binary()) for part, kind in zip(parts, FOUND.values(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(block[first]), *arrays], names=["block", *FOUND])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = shared.value, []
        spell, rest = Spelling(parts["ranks"], parts["pieces"]), parts["rest"]
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").dictionary_encode()
            ids, sizes = spell.spell_all(listed(words.dictionary))
            begin, at = np.cumsum(sizes) - sizes, words.indices.to_numpy()
            more = rest.logs(ids, begin).astype(np.float32)[at], ids[spread(begin[at], sizes[at])].astype(np.int16), sizes[at]
            held.append((*(batch.column(c).to_numpy() for c in ("block", "n", "count")), *more))
            if sum(len(h[0]) for h in held) >= HELD:
                yield together(held)
                held = []
        if held:
            yield together(held)

    return giving_back(run)


# Texts of about STORED words in a row: lists with an item per text, their words by number, and the words' values.
CODED = pa.schema([
    *((c, pa.list_(t)) for c, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()))),
    ("base_score", pa.list_(pa.float64())), *((c, pa.binary()) for c in ("numbers", "share", "rest", "ids")),
])


def _coder(total: int, types: int, mix: float, tables: dict[str, np.ndarray]):
    """Base scores of the texts of one block, and what their scores take besides the model: per word that occurs there
    the natural logarithms of its weighted share of all words, minus infinity without one, and of its ids given the
    unit by counts, and its ids."""

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        # What the worker held for the block or task before.
        give_back()
        found = {c: np.frombuffer(b"".join(words[c].to_pylist()), kind) for c, kind in FOUND.items()}
        order = np.argsort(found.pop("n"))
        count_of, rest_of, ids = found["count"][order], found["rest"][order], found["ids"]
        ends = np.flatnonzero(tables["final"][ids]) + 1
        size = np.diff(ends, prepend=0)
        begin_of, size_of = (ends - size)[order], size[order]
        known_of, base_of = count_of > 0, np.log10(count_of + 0.5) - math.log10(total + 0.5 * (types + 1))
        shared = known_of & (mix < 1)
        share_of = np.where(shared, np.log(np.where(shared, (1 - mix) * count_of / max(total, 1), 1)), -np.inf).astype(np.float32)
        sizes = pc.binary_length(texts["numbers"]).to_numpy().astype(np.int64) // 4
        rows = []
        for lo, hi in grouped(sizes.tolist(), STORED):
            parts = [unpacked(numbers.as_py()) for numbers in texts["numbers"][lo:hi]]
            sums = [(int(known_of[at].sum()), float(base_of[at].sum())) for at in parts]
            mine, numbers = np.unique(np.concatenate(parts), return_inverse=True)
            spelt = ids[spread(begin_of[mine], size_of[mine])]
            rows.append((
                *(texts[c][lo:hi].to_pylist() for c in ("doc_id", "held_out")), sizes[lo:hi].tolist(), *map(list, zip(*sums, strict=True)),
                packed_small(numbers), share_of[mine].tobytes(), rest_of[mine].tobytes(), spelt.tobytes(),
            ))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CODED, strict=True)], schema=CODED)

    return run


def _scorer(shared, total: int, mix: float):
    """Scores coded texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        model = Attention.__new__(Attention)
        model.w, model.tail_place, tables = shared.value
        for batch in batches:
            for chunk in rows_of(batch):
                told, words = unpacked_small(chunk["numbers"]).astype(np.int64), Spelled(np.frombuffer(chunk["ids"], np.int16), tables)
                share, rest = (np.frombuffer(chunk[c], np.float32).astype(np.float64) for c in ("share", "rest"))
                sizes = np.array(chunk["n_tokens"])
                units, tails = (x.astype(np.float64) for x in model.score_places(words.units[told], sizes, words, told))
                # Both ways to the ids after the unit, and then the model and the word's share.
                tails = np.logaddexp(math.log(TAILS) + tails, math.log(1 - TAILS) + rest[told])
                logs = np.logaddexp(math.log(mix) + units + tails, share[told])
                score = np.add.reduceat(logs, np.cumsum(sizes) - sizes) / math.log(10)
                lists = {c: chunk[c] for c in SCORED if c in chunk} | {"train_tokens": [total] * len(sizes), "score": score}
                yield pa.RecordBatch.from_arrays([pa.array(lists[f.name], f.type) for f in SCORES], schema=SCORES)

    return run


SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
SCORES = pa.schema([*zip(SCORED, (pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2), strict=True)])


def score(
    docs: DataFrame, id_col="doc_id", text_col="text", vocabulary: str = VOCABULARY, mix: float = MIX, steps: int = STEPS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        (remainder(F.col(id_col), PARTS) == HELD_OUT).alias("held_out"),
    )
    ranks = read_ranks(vocabulary)

    # Written once, so that numbers of words mean the same in all that follows.
    cut = texts.mapInArrow(_cut(block_bytes), "block bigint, doc_id bigint, held_out boolean, numbers binary, n int, word string, count bigint")
    cut = staged(cut, "cut-texts")
    same = Window.partitionBy("word")
    corpus = cut.where(F.col("word").isNotNull()).select(
        "block", "n", "word", F.sum("count").over(same).alias("count"), (F.col("block") == F.min("block").over(same)).alias("once")
    )
    corpus = staged(corpus, "word-counts")
    once = F.col("once") & (F.col("count") > 0)
    total, types, blocks = corpus.agg(F.sum(F.when(once, F.col("count"))), F.count(F.when(once, 1)), F.count(F.when(F.col("n") == 0, 1))).first()
    total = int(total or 0)
    model, pieces, rest = first_model(corpus.where(once).select("word", "count"), ranks)
    model.tables = tables_of(model, pieces, rest)
    shared = spark.sparkContext.broadcast({"ranks": ranks, "pieces": pieces, "rest": rest})
    words = corpus.select("block", "n", "word", "count")
    words = words.mapInArrow(_spelled(shared), "block bigint, n binary, count binary, rest binary, ids binary")
    numbered = cut.where(F.col("numbers").isNotNull()).select("block", "doc_id", "held_out", "numbers")
    schema = "doc_id array<bigint>, held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base_score array<double>"
    # So many partitions that seldom more than two or three blocks meet in a task, which sorts and writes them in memory.
    parts = max(1, 2 * blocks)
    coded = numbered.repartition(parts, "block").groupBy("block").cogroup(words.repartition(parts, "block").groupBy("block"))
    coded = coded.applyInArrow(_coder(total, int(types), mix, model.tables), f"{schema}, numbers binary, share binary, rest binary, ids binary")
    coded = staged(coded, "coded-texts")
    model = train(model, lessons(coded, model.tables), total, steps)
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    trained = spark.sparkContext.broadcast((model.w, model.tail_place, model.tables))
    return coded.mapInArrow(_scorer(trained, total, mix), schema)


def query(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
