"""The language model predicts every id of a word from all before it, not its first id alone."""

import zlib

import numpy as np

from matchlake.llm import attention_lm

SIZE, IDS = attention_lm.SPELLED, attention_lm.IDS
PIECES = {(b"the", False): 600, (b"there", True): IDS + 3, (b"tha", False): IDS + 4, (b"in", True): 601}
# A final byte has 256 added, as a single id or after others.
WORDS = [[600, 601], [IDS + 4, ord("x"), ord("y") + 256], [IDS + 3], [601], [attention_lm.END], [ord("t"), 601], [ord("t") + 256]]


def model_and_words():
    keys = np.array([600 * SIZE + 601, (IDS + 4) * SIZE + 120, 120 * SIZE + 377, SIZE * SIZE + 600, SIZE * SIZE + IDS + 3])
    rest = attention_lm.Rest(PIECES, np.sort(keys), np.array([5, 2, 7, 9, 1]))
    model = attention_lm.Attention(rest.units, rest.told)
    words = attention_lm.Spelled(np.concatenate(WORDS), attention_lm.tables_of(model, PIECES, rest))
    return model, words


def path(word):
    """What the model predicts after a word's unit, with the unit before it."""
    first = word[0]
    shared = ord("t") if first in (IDS + 3, IDS + 4) else first
    return [SIZE + shared, *word] if shared < 256 else word


def test_words_are_told_apart():
    model, words = model_and_words()
    paths = [path(w) for w in WORDS]
    assert words.ids.tolist() == sum(paths, []) and words.steps.tolist() == [len(p) - 1 for p in paths]
    assert words.units.tolist() == [model.place[p[0] - SIZE if p[0] >= SIZE else p[0]] for p in paths]
    assert sorted(model.tail_place.tolist()) == list(range(SIZE))


def test_gradients_of_further_ids():
    model, words = model_and_words()
    model.w = {k: v.astype(float) for k, v in model.w.items()}
    rng = np.random.default_rng(0)
    told = rng.integers(0, len(WORDS), (2, attention_lm.WINDOW))
    at = np.roll(told, 1, axis=1), told
    given = words.units[at[0]], words.units[at[1]], words, at
    _, grads = model.gradients(*given)
    assert set(grads) == set(model.w)
    for name, grad in grads.items():
        place = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        sides = []
        for move in (1e-5, -2e-5):
            model.w[name][place] += move
            sides.append(model.gradients(*given)[0])
        model.w[name][place] += 1e-5
        assert abs(grad[place]) > 0 and abs((sides[0] - sides[1]) / 2e-5 - grad[place]) < 1e-6


def test_each_further_id_is_scored_from_all_before_it():
    model, words = model_and_words()
    rng = np.random.default_rng(3)
    sizes = np.array([1, 5, 32, 49, 70])
    told = rng.integers(0, len(WORDS), sizes.sum())
    units, tails = model.score_places(words.units[told], sizes, words, told)
    half, start, w = attention_lm.WINDOW // 2, 0, model.w
    for size in sizes.tolist():
        mine = told[start : start + size]
        for t in range(size):
            begin = 0 if t < attention_lm.WINDOW else (t // half - 1) * half
            before = [None if k == 0 else int(mine[k - 1]) for k in range(begin, t + 1)]
            ids = np.array([[attention_lm.START if k is None else words.units[k] for k in before]])
            more = np.array([[np.zeros(attention_lm.WIDTH) if k is None else sum((w["piece"][i] for i in path(WORDS[k])[1:]), np.zeros(attention_lm.WIDTH)) for k in before]])
            z = model.attend(ids, t - begin, more.astype(np.float32))["z"][0, 0]
            assert abs(model.log_probabilities(z[None], words.units[mine[t : t + 1]])[0] - units[start + t]) < 1e-3
            ahead, want = path(WORDS[mine[t]]), 0
            for j in range(1, len(ahead)):
                r = z + w["last"][ahead[j - 1]] + sum(w["piece"][i] for i in ahead[:j])
                y = r + np.maximum(r @ w["tail_up"] + w["tail_up_bias"], 0) @ w["tail_down"]
                every = model.log_probabilities(np.repeat(y[None].astype(np.float32), SIZE, 0), np.arange(SIZE), "tail_")
                assert abs(np.exp(every.astype(float)).sum() - 1) < 1e-3
                want += every[model.tail_place[ahead[j]]]
            assert abs(want - tails[start + t]) < 1e-3
        start += size


def test_lessons_hold_every_id(make_docs, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 300, size)), "a") for k, size in enumerate([0, 1, 511, 512, 513] * 4)]
    seen = []
    monkeypatch.setattr(attention_lm, "STORED", 1000)
    monkeypatch.setattr(attention_lm, "train", lambda model, found, total, steps: seen.append((model, found.collect())) or model)
    assert attention_lm.score(make_docs(rows), block_bytes=20_000).count() == len(rows)
    model, found = seen[0]
    got = {}
    for row in sorted(found, key=lambda r: (r.doc_id, r.n)):
        words = attention_lm.Spelled(np.frombuffer(row.spelt, np.int16), model.tables)
        assert words.units.tolist() == np.frombuffer(row.ids, np.int16).tolist()
        spelt = [row.spelt[2 * b : 2 * (b + s)] for b, s in zip(words.spelt_begin.tolist(), words.spelt_size.tolist(), strict=True)]
        assert spelt[0] == (got[row.doc_id][-1] if row.n else np.int16(attention_lm.LEAD).tobytes())
        got.setdefault(row.doc_id, []).extend(spelt[1:])
    spelling = {}
    for k, text, _ in rows:
        if zlib.crc32(str(k).encode()) % 5 != 1:
            for word, ids in zip([*attention_lm.words_of(text), b""], got.pop(k), strict=True):
                assert spelling.setdefault(word, ids) == ids
    assert not got and len(set(spelling.values())) == len(spelling)


def test_what_follows_a_unit_is_learned_from_the_words_before(make_docs):
    """The number of a y is that of the x before it. Units are always those of x and y."""
    rng = np.random.default_rng(7)
    rows = [(k, " ".join(f"x{n} y{n}" for n in rng.integers(10, 30, 60)), "a") for k in range(120)]
    got = attention_lm.score(make_docs(rows), mix=1.0, steps=600).where("held_out").collect()
    # By counts alone each of 120 numbers takes log10(20) = 1.3.
    assert got and np.mean([r.score for r in got]) > -120


def test_small_numbers_come_back():
    for numbers in ([], [0], [0, 255], [256, 0, 65535], [65536, 1], [2**24, 2**31 - 1]):
        numbers = np.array(numbers, np.int64)
        assert attention_lm.unpacked_small(attention_lm.packed_small(numbers)).tolist() == numbers.tolist()
