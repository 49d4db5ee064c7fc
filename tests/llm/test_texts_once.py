"""The language model takes texts apart once, shuffles numbers in their place and keeps few bytes per word."""

import numpy as np
from pyspark.sql import functions as F

from matchlake.llm import attention_lm


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_not_shuffled_and_words_kept_small(make_docs, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 300, 200)), "a") for k in range(40)]
    first, kept, staged = {}, {}, attention_lm.staged

    def spy(df, name):
        first[name] = plan_of(df)
        kept[name] = staged(df, name)
        return kept[name]

    monkeypatch.setattr(attention_lm, "staged", spy)
    monkeypatch.setattr(attention_lm, "train", lambda model, found, total, steps: model)
    got = attention_lm.score(make_docs(rows), block_bytes=4_000).collect()
    assert len(got) == len(rows) and sum(r.n_tokens for r in got) == 201 * len(rows)
    readers = [name for name, plan in first.items() if "text#" in plan]
    assert len(readers) == 1 and "Exchange" not in first[readers[0]]
    coded = kept["coded-texts"]
    sizes = [F.sum(F.octet_length(f.name)) for f in coded.schema if f.dataType.typeName() == "binary"]
    assert sum(coded.agg(*sizes).first()) <= 6 * 201 * len(rows)


def test_scores_are_the_mixture_of_model_and_counts(make_docs, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 200, size)), "a") for k, size in enumerate([0, 1, 40, 90] * 8)]
    monkeypatch.setattr(attention_lm, "train", lambda model, found, total, steps: model)
    docs = make_docs(rows)
    scores = {mix: {r.doc_id: r for r in attention_lm.score(docs, mix=mix, block_bytes=700).collect()} for mix in (0.5, 1.0, 1e-9)}
    counts, total = {}, scores[0.5][0].train_tokens
    for k, text, _ in rows:
        if not scores[0.5][k].held_out:
            for word in [*attention_lm.words_of(text), b""]:
                counts[word] = counts.get(word, 0) + 1
    assert total == sum(counts.values())
    for k, text, _ in rows:
        words = [*attention_lm.words_of(text), b""]
        if all(w in counts for w in words):
            alone = sum(np.log10(counts[w] / total) for w in words)
            assert abs(scores[1e-9][k].score - alone) < 1e-4 * len(words)
        # Each word's probability is the mean of both, so the whole is at least either with half its weight.
        assert scores[0.5][k].score > scores[1.0][k].score - len(words) * np.log10(2) - 1e-4
    assert len({round(r.score, 6) for r in scores[1.0].values()}) > 8


def test_numbers_come_back():
    numbers = np.array([0, 1, 65535, 65536, 2**31 - 1], np.int32)
    assert attention_lm.unpacked(attention_lm.packed(numbers)).tolist() == numbers.tolist()
    assert attention_lm.unpacked(attention_lm.packed(numbers[:0])).tolist() == []
