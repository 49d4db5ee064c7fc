"""Repeated passages: only parts of fragments that may hold a repeating string are sorted."""

import random

import numpy as np
import pyarrow as pa

from matchlake.llm import suffix_dedup
from tests.llm.test_duplicates import brute_removals


def judged(texts, hot_kinds=1000, rows=10_000):
    """What _judge makes of the texts, document by document, in batches of so many rows."""
    batches = [pa.record_batch({"doc": pa.array([k], pa.int64()), "text": [t]}) for k, t in enumerate(texts)]
    cut = pa.Table.from_batches(suffix_dedup._cut(iter(batches)), suffix_dedup.FRAGMENT)
    cut = cut.sort_by([(c, "ascending") for c in ("anchor", "mark", "doc", "start")])
    return pa.Table.from_batches(suffix_dedup._judge(iter(cut.to_batches(rows)), hot_kinds), suffix_dedup.JUDGED)


def removed(texts, hot_kinds=1000, rows=10_000):
    """Bytes removed and spans by document, by the operator's steps."""
    found = judged(texts, hot_kinds, rows).to_pylist()
    starts = {k: [(r["start"], r["count"]) for r in found if r["doc"] == k and r["state"] == suffix_dedup.REPEAT] for k in range(len(texts))}
    wanted = [[r for r in found if r["doc"] == k and r["state"] != suffix_dedup.REPEAT] for k in range(len(texts))]
    pieces = pa.record_batch({"doc": pa.array(range(len(texts)), pa.int64()), "text": texts, "wanted": wanted})
    pieces = pa.Table.from_batches(suffix_dedup._extract(iter([pieces])), suffix_dedup.PIECE_SCHEMA).sort_by("anchor")
    for batch in suffix_dedup._sorter(2000, 3000)(iter(pieces.to_batches(7))):
        for row in batch.to_pylist():
            starts[row["doc"]].append((row["start"], row["count"]))
    spans = [suffix_dedup.merged(starts[k]) for k in range(len(texts))]
    return [(sum(b - a for a, b in s), len(s)) for s in spans]


def noise(rng, size):
    return "".join(rng.choice("abcdefghijkl ") for _ in range(size))


def test_agreement_too_short_to_repeat_is_not_sorted():
    rng = random.Random(11)
    phrase = noise(rng, 59)
    texts = [noise(rng, 300) + phrase + noise(rng, 300) for _ in range(60)]
    assert judged(texts).num_rows == 0
    assert removed(texts) == [(0, 0)] * 60
    # One more byte than LENGTH in common, beside other bytes: something repeats and is sorted.
    passage = noise(rng, suffix_dedup.LENGTH + 1)
    texts = [noise(rng, 300) + passage + noise(rng, 300) for _ in range(60)]
    assert set(judged(texts)["state"].to_pylist()) - {suffix_dedup.REPEAT}
    want = [(n, spans) for _, _, n, spans, _ in brute_removals(list(enumerate(texts)))]
    assert removed(texts) == want and min(want[1:]) == (len(passage), 1)


def test_strings_alone_under_their_hash_are_not_sorted(monkeypatch):
    sorted_bytes, repeats = [], suffix_dedup.repeats

    def spy(parts, *rest):
        sorted_bytes.append(sum(map(len, parts)))
        return repeats(parts, *rest)

    monkeypatch.setattr(suffix_dedup, "repeats", spy)
    rng = random.Random(12)
    shared = noise(rng, 70)
    texts = [noise(rng, 200) + shared + noise(rng, 200) for _ in range(40)]
    assert set(judged(texts, hot_kinds=1)["state"].to_pylist()) == {suffix_dedup.HOT}
    assert removed(texts, hot_kinds=1) == [(0, 0)] * 40
    assert not sorted_bytes


def test_any_overlap_is_found():
    """Passages of every length around LENGTH, cut anywhere, in any split of an anchor's rows into batches."""
    rng = random.Random(13)
    passage = noise(rng, 400)
    texts = []
    for size in range(90, 130):
        at = rng.randrange(400 - size)
        texts.append(noise(rng, rng.randrange(120)) + passage[at : at + size] + noise(rng, rng.randrange(120)))
    texts += ["a" * 500, "ab" * 200, noise(rng, 50), "", None, passage, "é" * 150]
    want = [(n, spans) for _, _, n, spans, _ in brute_removals(list(enumerate(texts)))]
    given = [t or "" for t in texts]
    for rows in (1, 3, 10_000):
        for hot_kinds in (1, 1000):
            assert removed(given, hot_kinds, rows) == want


def test_substrings_are_named_in_order():
    rng = random.Random(14)
    for _ in range(40):
        text = [rng.randrange(2, 2 + rng.choice([1, 2, 5, 256])) for _ in range(rng.randint(2, 300))]
        text = np.array([*text, *[2 + rng.randrange(3)] * rng.randrange(30), 1, 0], np.uint16)
        sorter = suffix_dedup.InducedSorter(text, 100)
        ends = np.append(sorter.stars[1:], len(text) - 1)
        keys = (2 * text + sorter.is_s).tolist()
        parts = [tuple(keys[s : e + 1]) for s, e in zip(sorter.stars.tolist(), ends.tolist(), strict=True)]
        names, rank = sorter._named(ends)
        order = sorted(set(parts))
        assert names == len(order) and rank.tolist() == [order.index(p) for p in parts]
