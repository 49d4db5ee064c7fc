"""Filter audit, Jaccard join, fill in the middle."""

import hashlib
import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from matchlake.llm import catalog, fill_middle, filter_audit, jaccard_join

TESTDATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Names that these operators use inside.
NAMES = ("doc", "n", "form", "output", "h1", "part", "mask", "good", "toxic", "text_key", "set_key", "node", "tokens", "sid", "bucket", "_text")


@pytest.fixture(scope="module")
def clashing(make_docs, hostile):
    docs = make_docs(hostile)
    return docs.select("*", *[docs["lang"].alias(c) for c in NAMES if c not in docs.columns])


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_fill_middle"])
def test_query_matches_sql(spark, name):
    got = catalog.QUERIES[name](spark, TESTDATA)
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    want = con.execute(catalog.ORACLES[name])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def brute_audit(rows, labels):
    """Each order walked document by document."""
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    masks = []
    for i, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if any((t or "") == text and j is not None and (i is None or j < i) for j, t, _ in rows):
            fails.add("E")
        masks.append((source or "", i, fails))
    out = {}
    for part in {m[0] for m in masks}:
        for order in permutations("ABCDE"):
            left = [(i, f) for p, i, f in masks if p == part]
            every = list(left)
            for k, letter in enumerate(order):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                out[part, "".join(order), k + 1] = [
                    letter,
                    len(left),
                    len(gone),
                    sum(letter in f and bool(f & set(order[:k])) for _, f in every),
                    sum(f == {letter} for _, f in every),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
    for key, row in out.items():
        row.append(sum(r[2] for (p, _, _), r in out.items() if p == key[0] and r[0] == row[0]))
    return out


def test_audit_of_hostile_rows(spark, clashing, hostile):
    labels = [(0, 1, 0), (3, 0, 1), (3, 1, 1), (105, 1, 1), (106, None, 1), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(filter_audit.cells(filter_audit.document_masks(clashing, frame)))
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in found.collect()}
    assert got == brute_audit(hostile, labels)
    assert filter_audit.audit(filter_audit.cells(filter_audit.document_masks(clashing.limit(0), frame))).count() == 0


def test_audit_levels_are_one_recursion(spark):
    """A prefix of k filters is there once for each mask, whatever the data."""
    rows = filter_audit.steps(spark, "ABC").groupBy("step").count().collect()
    assert {r.step: r["count"] for r in rows} == {1: 3 * 8, 2: 6 * 8, 3: 6 * 8}


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_join(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    smallest = {}
    for k, (i, _, _) in enumerate(rows):
        smallest[find(k)] = min((x for x in (smallest.get(find(k)), i) if x is not None), default=None)
    return sorted(str((i, len(sets[k]), smallest[find(k)])) for k, (i, _, _) in enumerate(rows))


def test_join_of_hostile_rows(clashing, hostile):
    found = jaccard_join.similar_sets(clashing)
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in found.collect()) == brute_join(hostile)
    assert jaccard_join.similar_sets(clashing.limit(0)).count() == 0


@pytest.mark.parametrize("middle", [True, False])
def test_join_loses_no_link(make_docs, middle, monkeypatch):
    """Stars and chains of edited texts with and without their middle, a passage that most texts share, repeated
    texts, sizes at the bound. Small buckets make postings of a token meet over many tasks."""
    monkeypatch.setattr(jaccard_join, "FLUSH", 300)
    monkeypatch.setattr(jaccard_join, "BUCKET", 500)
    rng = random.Random(11 + middle)
    prose = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(n)]
    passage, texts = prose(40), []
    for size in (12, 45, 120):
        base = prose(size)
        texts += [base] * (2 * middle)
        for _ in range(25):
            copy = list(base)
            for at in rng.sample(range(size), rng.randrange(1, 5)):
                copy[at] = prose(1)[0]
            texts.append(copy[: rng.choice([size, size, size - 1, int(0.8 * size) + 3])])
    chain = prose(60)
    for _ in range(12):
        chain = [*chain[3:], *prose(3)]
        texts.append(chain)
    texts += [[*prose(rng.randrange(60)), *passage, *prose(rng.randrange(60))] for _ in range(40)]
    texts += [[*passage, *prose(k)] for k in range(12)] + [prose(k) for k in range(7)]
    rng.shuffle(texts)
    rows = [(k, " ".join(t), "s") for k, t in enumerate(texts)]
    found = jaccard_join.similar_sets(make_docs(rows).repartition(5)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in found) == brute_join(rows)


def test_screens_keep_every_partner():
    """Any two similar sets share as many of their probes as the screen asks for."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        size, extra = int(rng.integers(5, 400)), rng.integers(0, 1 << 62, 2000)
        both = extra[: max(1, int(0.8 * size) + int(rng.integers(0, size)))]
        rest = extra[len(both) :]
        left = np.sort(np.append(both, rest[: int(rng.integers(0, len(both) // 8 + 1))]))
        right = np.sort(np.append(both, rest[-int(rng.integers(1, len(both) // 8 + 2)) :]))
        if len(left) < 5 or 9 * len(both) < 4 * (len(left) + len(right)):
            continue
        a, b = left[: jaccard_join.probe_size(len(left))], right[: jaccard_join.probe_size(len(right))]
        assert len(np.intersect1d(a, b)) >= 1 + jaccard_join.least_common(len(left)) // 20


def brute_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_of_hostile_rows(make_docs, clashing, hostile):
    more = [(1000 + k, t, "s1") for k, t in enumerate(["<P>", "a <S> b", "<", "a<", "<P", "a <P", "S> b", " ", " a ", "   x", "\x00 \x1f", "é" * 3000 + " <M"] * 4)]
    for rows, docs in ((hostile, clashing), (more, make_docs(more))):
        found = fill_middle.fill_in_middle(docs)
        got = found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored(found.output, found.form).alias("back"))
        want = [(i, *brute_fill(i, t), t or "") for i, t, _ in rows]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    same = fill_middle.transform(clashing)
    assert same.columns == clashing.columns
    assert sorted(str(r.text) for r in same.collect()) == sorted(str(brute_fill(i, t)[-1]) for i, t, _ in hostile)
    assert fill_middle.fill_in_middle(clashing.limit(0)).count() == 0


def test_fill_of_slices(make_docs, hostile, monkeypatch):
    """Slices of any size give the same rows."""
    docs = make_docs(hostile)
    want = sorted(map(str, fill_middle.fill_in_middle(docs).collect()))
    monkeypatch.setattr(fill_middle, "SLICE", 100)
    assert sorted(map(str, fill_middle.fill_in_middle(docs).collect())) == want
