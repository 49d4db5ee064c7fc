"""Links of short texts in the Jaccard join, where one shingle decides."""

import random

from matchlake.llm import jaccard_join


def sets_of(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def classes(rows):
    """Smallest id reachable, by comparing all pairs."""
    found = {i: sets_of(t) for i, t, _ in rows}
    root = {i: i for i in found}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in found:
        for b in found:
            if a < b and 100 * len(found[a] & found[b]) >= 80 * len(found[a] | found[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: top(i) for i in found}


def test_short_sets(make_docs):
    rng, rows = random.Random(3), []
    # All texts of up to 14 words and their neighbours: a word more at either end, one less, one changed.
    for size in range(1, 15):
        for _ in range(2):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            rows += [words, [*words, "more"], ["more", *words], words[1:] or words, [*words[:-1], "other"]]
    rng.shuffle(rows)
    rows = [(k, " ".join(words), "a") for k, words in enumerate(rows)]
    want = classes(rows)
    eight = {i for i, t, _ in rows if len(t.split()) == 8}
    assert any(want[i] != i for i in eight)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_sets(make_docs(rows).repartition(4)).collect()}
    assert got == want
