"""Near copies share one document's weight; documents with a common part keep theirs."""

import random

from matchlake.llm import toxicity


def test_weights(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    footer, copied = prose(60), prose(150)
    rows = [(k, 0, f"{prose(140)} {footer}") for k in range(300)]
    rows += [(1000 + k, 1, copied) for k in range(40)] + [(2000, 0, ""), (2001, 0, ""), (2002, 1, "one")]
    got = toxicity.weighted(spark.createDataFrame(rows, "doc_id long, label int, text string")).collect()
    weight = {r.doc_id: r.weight for r in got}
    assert len(got) == len(rows) and all(weight[k] == 1 for k in (*range(300), 2002))
    assert all(abs(weight[1000 + k] - 1 / 40) < 1e-9 for k in range(40)) and weight[2000] == weight[2001] == 0.5
