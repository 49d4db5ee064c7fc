"""The language model learns from every word of every training text."""

import zlib
from collections import Counter

import numpy as np

from matchlake.llm import attention_lm


def test_every_training_word_is_in_a_lesson(make_docs, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 300, size)), "a") for k, size in enumerate([0, 1, 511, 512, 513, 2000] * 6)]
    seen = []

    def spy(model, found, total, steps):
        seen.append((total, model, found.collect()))
        return model

    monkeypatch.setattr(attention_lm, "train", spy)
    attention_lm.score(make_docs(rows), block_bytes=20_000).collect()
    total, model, found = seen[0]
    docs = {k: [*attention_lm.words_of(t), b""] for k, t, _ in rows if zlib.crc32(str(k).encode()) % 5 != 1}
    assert total == sum(map(len, docs.values()))
    got = {k: [] for k in docs}
    for row in sorted(found, key=lambda r: (r.doc_id, r.n)):
        ids = np.frombuffer(row.ids, np.int16).tolist()
        assert ids[0] == (got[row.doc_id][-1] if row.n else attention_lm.START)
        got[row.doc_id] += ids[1:]
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in docs.items()}
    place_of = {}
    for k, doc in docs.items():
        for word, place in zip(doc, got[k], strict=True):
            assert place_of.setdefault(word, place) == place
    assert place_of[b""] == model.place[attention_lm.END]


def test_every_word_of_lessons_is_a_target():
    rng = np.random.default_rng(1)
    runs = [np.append(attention_lm.START, rng.integers(0, 1000, n)).astype(np.int16) for n in (1, 40, 300, 7)]
    ids, target = attention_lm.windows(runs, rng)
    want, got = Counter(np.concatenate([r[1:] for r in runs]).tolist()), Counter(target.ravel().tolist())
    assert not want - got and got.total() - want.total() < attention_lm.WINDOW
    assert (ids[:, 1:] == target[:, :-1]).mean() > 0.9


def test_ids_of_words_sum_to_one():
    size, ids = attention_lm.SPELLED, attention_lm.IDS
    pieces = {(b"the", False): 600, (b"there", True): ids + 3, (b"tha", False): ids + 4}
    keys = np.array([600 * size + 300, 600 * size + ids + 3, size * size + 600, size * size + ids + 3, size * size + ord("t")])
    rest = attention_lm.Rest(pieces, keys, np.array([5, 2, 7, 9, 1]))
    after = [rest.logs(np.array([600, k]), np.array([0]))[0] for k in range(size)]
    assert abs(np.exp(after).sum() - 1) < 1e-9
    first = rest.logs(np.array([ord("t"), ids + 3, ids + 4]), np.arange(3))
    assert abs(np.exp(first).sum() - 1) < 1e-9 and rest.unit[ids + 3] == ord("t") and rest.unit[600] == 600
    assert rest.units[600] == 7 and rest.units[ord("t")] == 10
