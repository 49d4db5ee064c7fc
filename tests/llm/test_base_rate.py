"""Scores keep the classes' shares when the sample is capped."""

import random

from matchlake.llm import compression_quality


def test_score_keeps_the_base_rate(spark):
    """Texts that say nothing of their label must score about the share of label 1, whatever the sample holds."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs = [(k, " ".join(rng.choice(words) for _ in range(60))) for k in range(1400)]
    labels = [(k, int(k % 7 > 0)) for k, _ in docs]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    for cap in (30, 3000):
        got = compression_quality.score(docs, labels, excerpts=cap, calibration=cap).toPandas()
        assert abs(got.score.mean() - 6 / 7) < 0.08
