"""SimHash, decontamination, suffix removal."""

import hashlib
import random
import re

import numpy as np
import xxhash

from matchlake.llm import decontamination, simhash, suffix_dedup
from matchlake.llm.components import components

TESTDATA = "/root/testdata/sf0.001"


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, near):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if near(prints[i], prints[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_against_brute_force(make_docs, hostile):
    docs = make_docs(hostile)
    got = simhash.near_duplicates(docs, max_tree=2).collect()
    prints = [brute_print(t) for _, t, _ in hostile]
    classes = brute_classes(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    smallest = {}
    for (i, _, _), c in zip(hostile, classes, strict=True):
        smallest[c] = min((x for x in (smallest.get(c), i) if x is not None), default=None)
    want = sorted(str((i, p, smallest[c])) for (i, _, _), p, c in zip(hostile, prints, classes, strict=True))
    assert sorted(str((r.doc_id, r.fp % 2**64, r.component_id)) for r in got) == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(classes))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_shards_lose_no_link(spark):
    """Random fingerprints and a dense cluster, at bounds that need every level."""
    rng = random.Random(4)
    base = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(50)}
    for _ in range(200):
        v = base
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    for bound in (1, 20, 5000):
        spread = simhash.shards(nodes, bound).repartition(4, "shard").sortWithinPartitions("shard")
        links = spread.mapInArrow(simhash._linker(3), "a bigint, b bigint")
        roots = {r.node: r.root for r in components(links).collect()}
        classes = brute_classes(values, lambda a, b: (a ^ b).bit_count() <= 3)
        want = {}
        for v, c in zip(signed, classes, strict=True):
            want.setdefault(c, []).append(v)
        assert all(roots.get(v, v) == min(group) for group in want.values() for v in group)


def test_chain_of_links(spark):
    n = 300
    edges = spark.createDataFrame([(k + 1, k) for k in range(n)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.limit(0)).count() == 0


def plant(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("qzxj")
        elif kind == 1:
            out.insert(at, rng.choice("qzxj"))
        else:
            out.pop(at)
    return "".join(out)


def distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_against_brute_force(spark, make_docs, hostile):
    rng = random.Random(9)
    items = [(k, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(40, 300)))) for k in range(12)]
    rows = list(hostile)
    for k, item in items:
        budget = int(decontamination.EDIT_RATE * len(item))
        rows.append((500 + k, "Some words " * 5 + plant(rng, item, budget).upper() + " tail " * 9, "s1"))
        rows.append((600 + k, "other " * 5 + plant(rng, item, 4 * budget + 8), "s1"))
    bench = spark.createDataFrame([*items, (98, None), (99, ""), (97, "short")], "item_id long, text string")
    docs = make_docs(rows)
    found = decontamination.with_matches(docs, bench, "found", block_chars=700).selectExpr("doc_id as d", "inline(found)").collect()
    got = {(r.d, r.item_id) for r in found}
    want = {(i, k) for i, t, _ in rows if i is not None and 500 <= i < 700 for k, item in items
            if distance_inside(decontamination.codes(item).tolist(), decontamination.codes(t).tolist())
            <= int(decontamination.EDIT_RATE * len(item))}
    assert got == want and {(500 + k, k) for k, _ in items} <= got
    text_of = {i: t for i, t, _ in rows}
    for r in found:
        span = decontamination.codes(text_of[r.d][r.start : r.end]).tolist()
        assert distance_inside(decontamination.codes(dict(items)[r.item_id]).tolist(), span) == r.edits
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(rows) - len({i for i, _ in got})
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0


def test_alignment_stays_in_its_text():
    """An item cut at its middle lies in no text, whatever stands beside it."""
    rng = random.Random(3)
    item = "".join(rng.choice("abcdefgh ") for _ in range(200))
    index = decontamination.Index([(1, item)])
    halves = ["start " * 20 + item[:100], item[100:] + " end" * 20]
    assert index.search(halves) == [[], []]
    assert index.search([halves[0], item, halves[1], None, "", item[:97] + item[100:]]) == [
        [], [(1, 0, 200, 0)], [], [], [], [(1, 0, 197, 3)],
    ]
    for k in range(2, 199, 7):
        cut = [item[:k], item[k:]]
        alone = [index.search([part])[0] for part in cut]
        assert index.search(cut) == alone and index.search(["x " * 9, *cut, "y"]) == [[], *alone, []]


def test_short_items_match_exactly(spark, make_docs, monkeypatch):
    items = [(1, "A short benchmark item"), (2, " Yes "), (3, "yes"), (4, None), (5, " \n"), (6, "0123456789")]
    texts = {
        10: "So: a SHORT benchmark\nitem, here.", 11: "a short benchmark items", 12: "a short benchmark itm",
        13: "yes", 14: "oh yes", 15: "\tYES\n", 16: "x0123456789", 17: "x 0123456789", 18: "", 19: None,
        20: "0123456789",
    }
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(i, t, "s") for i, t in texts.items()])
    want = {(10, 1, 4, 26), (13, 2, 0, 3), (13, 3, 0, 3), (15, 2, 1, 4), (15, 3, 1, 4), (17, 6, 2, 12), (20, 6, 0, 10)}
    for chars in (10_000, 8):
        found = decontamination.with_matches(docs, bench, "found", block_chars=chars)
        assert found.columns == [*docs.columns, "found"]
        found = found.selectExpr("doc_id as d", "inline(found)").collect()
        assert {(r.d, r.item_id, r.start, r.end) for r in found} == want and len(found) == len(want)
    index = decontamination.Index([(6, "0123456789")])
    monkeypatch.setattr(decontamination, "PIECE", 5)
    assert index.search(["x0123456789", "-0123456789-"]) == [[], [(6, 1, 11, 0)]]


def test_long_text_in_pieces(monkeypatch):
    item = "".join(random.Random(1).choice("abcdefgh") for _ in range(200))
    index = decontamination.Index([(1, item)])
    text = "zq " * 1000 + item + " zq" * 1000
    whole = index.search([text])
    monkeypatch.setattr(decontamination, "PIECE", 500)
    assert index.search([text]) == whole == [[(1, 3000, 3200, 0)]]


def brute_removals(rows):
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        cover = bytearray(len(data))
        for k in range(len(data) - 99):
            piece = data[k : k + 100]
            if piece in seen:
                cover[k : k + 100] = b"\1" * 100
            seen.add(piece)
        kept = bytes(c for c, gone in zip(data, cover, strict=True) if not gone)
        spans = sum(1 for k, x in enumerate(cover) if x and not (k and cover[k - 1]))
        out.append((i, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_query_against_brute_force(spark):
    got = suffix_dedup.query(spark, TESTDATA).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").orderBy("doc_id").collect()]
    assert sorted(map(tuple, got)) == brute_removals(rows)


def test_suffix_hostile(make_docs, hostile):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcd ") for _ in range(400))
    rows = [(i, t, s) for i, t, s in hostile if i is not None and i != 108]
    rows += [(2000 + k, "".join(rng.choice("abcd ") for _ in range(90)) + shared[k % 7 : 300 + k], "s") for k in range(60)]
    rows += [(3000, "ab" * 400, "s"), (3001, "a" * 1000, "s"), (3002, "ba" * 60, "s"), (3003, "é" * 120, "s")]
    want = {i: (n, spans) for i, _, n, spans, _ in brute_removals(sorted((i, t) for i, t, _ in rows))}
    for hot_kinds in (1, 4, 1000):
        found = suffix_dedup.removals(make_docs(rows), shard_bytes=2000, budget=3000, hot_kinds=hot_kinds).collect()
        got = {}
        for r in found:
            spans = suffix_dedup.merged([(s["start"], s["count"]) for s in r.starts or []])
            got[r.doc_id] = (sum(b - a for a, b in spans), len(spans))
        assert got == want


def test_suffix_ties_and_nulls(make_docs):
    docs = make_docs([(1, "x" * 150, "a"), (1, "x" * 150, "a"), (None, "x" * 150, "a"), (None, None, None), (2, "", "b")])
    gone = [sum(b - a for a, b in suffix_dedup.merged([(s["start"], s["count"]) for s in r.starts or []]))
            for r in suffix_dedup.removals(docs).orderBy("doc_id").collect()]
    assert sorted(gone) == [0, 0, 149, 150, 150]
    assert suffix_dedup.removals(docs.limit(0)).count() == 0


def test_sorter_orders_suffixes():
    rng = random.Random(6)
    for trial in range(60):
        letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
        parts = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))]
        parts += [rng.choice(parts) * rng.randint(1, 8)]
        text = []
        for p in parts:
            text += [b + 2 for b in p] + [1]
        text.append(0)
        sorter = suffix_dedup.InducedSorter(np.array(text, np.uint16), 100, budget=200 if trial % 2 else 1 << 20)
        blocks = list(sorter.descending())
        place = np.concatenate([b[0] for b in blocks]).tolist()
        common = np.concatenate([b[1] for b in blocks]).tolist()
        assert sorted(place) == list(range(len(text) - 1))
        for k in range(1, len(place)):
            a, b = text[place[k - 1] :], text[place[k] :]
            assert a[:100] >= b[:100]
            shared = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert min(common[k], 100) == min(shared, 100)
