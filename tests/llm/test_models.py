"""Quality, toxicity and language-model scores; the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from matchlake.llm import attention_lm, catalog, compression_quality, toxicity

DATA = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    ones = label.sum()
    return (order[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize(
    "module,label,parts,rest,threshold,least",
    [(compression_quality, "quality", 3, 1, 0.5, 0.97), (toxicity, "toxic", 4, 2, 0.3, 0.88)],
)
def test_held_out(spark, module, label, parts, rest, threshold, least):
    got = module.query(spark, DATA).toPandas()
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= threshold)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % parts == rest) for i, h in zip(got.doc_id, got.held_out, strict=True))
    known = got.merge(spark.read.parquet(f"{DATA}/labels.parquet").toPandas(), on="doc_id")
    known = known[known.held_out]
    assert auc(known.score.to_numpy(), known[label].to_numpy()) > least


@pytest.mark.parametrize("module,label", [(compression_quality, "quality"), (toxicity, "toxic")])
def test_hostile_labels(spark, make_docs, hostile, module, label):
    docs = make_docs(hostile)
    ddl = "doc_id long, quality int, toxic int, score string"
    rows = [(i, k % 2, k % 2, "x") for k, (i, _, _) in enumerate(hostile)] + [(0, None, None, "x"), (1, 0, 0, "x"), (1, 1, 1, "x")]
    for some in (rows, [(i, 1, 1, "x") for i, *_ in rows], []):
        got = module.score(docs, spark.createDataFrame(some, ddl)).collect()
        assert len(got) == len(hostile)
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert module.score(docs.limit(0), spark.createDataFrame(rows, ddl)).count() == 0


def test_label_model_counts_copies_once():
    """Ten voters that say the same weigh less than two that agree independently."""
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    noisy = np.where(rng.random(4000) < 0.8, truth, ~truth)
    votes = [np.where(noisy, 2, 1)] * 10
    votes += [np.where(np.where(rng.random(4000) < 0.85, truth, ~truth), 2, 1) for _ in range(3)]
    v = np.stack(votes, axis=1)
    post = toxicity.LabelModel(0.3).fit(v)
    assert ((post > 0.5) == truth).mean() > 0.88
    assert any(len(g) >= 10 for g in toxicity.LabelModel.correlated(v, [np.ones(len(v))], 0.8))


def test_gradients():
    model = attention_lm.Attention(np.ones(attention_lm.IDS))
    model.w = {k: v.astype(float) for k, v in model.w.items()}
    rng = np.random.default_rng(0)
    ids, target = (rng.integers(0, attention_lm.IDS, (2, attention_lm.WINDOW)) for _ in range(2))
    _, grads = model.gradients(ids, target)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        sides = []
        for move in (1e-5, -2e-5):
            model.w[name][at] += move
            sides.append(model.gradients(ids, target)[0])
        model.w[name][at] += 1e-5
        assert abs((sides[0] - sides[1]) / 2e-5 - grad[at]) < 1e-6


def test_each_id_scored_once_and_sums_to_one():
    rng = np.random.default_rng(3)
    model = attention_lm.Attention(rng.random(attention_lm.IDS))
    sizes = np.array([1, 5, 32, 33, 48, 49, 200])
    stream = rng.integers(0, attention_lm.IDS, sizes.sum())
    got = model.score(stream, sizes)
    half, start = attention_lm.WINDOW // 2, 0
    for size in sizes.tolist():
        target = model.place[stream[start : start + size]]
        before = np.concatenate([[attention_lm.START], target[:-1]])
        for t in range(size):
            begin = 0 if t < attention_lm.WINDOW else (t // half - 1) * half
            z = model.attend(before[None, begin : t + 1], t - begin)["z"][0]
            every = model.log_probabilities(np.repeat(z, attention_lm.IDS, 0), np.arange(attention_lm.IDS))
            assert abs(np.exp(every.astype(float)).sum() - 1) < 1e-3
            assert abs(every[target[t]] - got[start + t]) < 1e-3
            if t > 40:
                break
        start += size


def test_spelling_is_unique():
    ranks = attention_lm.read_ranks(attention_lm.VOCABULARY)
    words = [w.encode() for w in ("the", "there", "therein", "é", "a" * 1000, "ñandú", "x")]
    pieces = attention_lm.choose_pieces({(p, final): 1 for p in (b"the", b"there", b"in") for final in (True, False)})
    ids, sizes = attention_lm.Spelling(ranks, pieces).spell_all([*words, b"", b"the"])
    spelled = np.split(ids, np.cumsum(sizes)[:-1])
    assert spelled.pop().tolist() == [pieces[b"the", True]] and spelled.pop().tolist() == [attention_lm.END]
    spelled = [tuple(s.tolist()) for s in spelled]
    assert spelled[0] == (pieces[b"the", True],) and spelled[-1] == (ord("x") + 256,)
    for k, a in enumerate(spelled):
        assert all(a != b[: len(a)] for j, b in enumerate(spelled) if j != k)


@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
def test_base_scores(make_docs, hostile, block_bytes):
    got = attention_lm.score(make_docs(hostile), steps=3, block_bytes=block_bytes).collect()
    low = [(i, ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
                for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]) for i, t, _ in hostile]
    out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in low]
    seen = Counter(w for (_, ws), o in zip(low, out, strict=True) if not o for w in ws)
    n, v = seen.total(), len(seen)
    want = sorted((str(i), o, len(ws), sum(seen[w] > 0 for w in ws), n,
                   round(sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
                  for (i, ws), o in zip(low, out, strict=True))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_no_rows_to_score(make_docs, hostile):
    assert attention_lm.score(make_docs(hostile).limit(0), steps=1).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, before, SMALL), "test")
        assert after.columns == names
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
        if name != "mixing":
            assert after.count() <= before.count()
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert last.count() == before.count() == corpus_pipeline.run(spark, SMALL).count()


def test_pipeline_hostile(spark, make_docs, hostile):
    import corpus_pipeline

    for docs in (make_docs(hostile), make_docs(hostile).limit(0)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.staged(stage(spark, docs, SMALL), "test")
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_all_are_registered():
    import __spark_entry__

    assert set(catalog.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert len({name.split("_")[0] for name in catalog.QUERIES}) == 13
