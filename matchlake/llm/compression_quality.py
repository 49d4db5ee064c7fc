"""Quality classifier from compression with zstandard dictionaries.

Two raw-content dictionaries are made of excerpts of good and of bad labelled documents. Every text is cut
into pieces and each piece is compressed with either dictionary and with none. The difference of the two
sizes, normalised by the length, says which dictionary knows the text better, over all pieces and in the
worst; the size without a dictionary, likewise normalised, says how much the text repeats itself. A
logistic calibration on other labelled documents turns them into the probability of label 1.

What is learned from is bounded: EXCERPTS documents a class for the dictionaries, CALIBRATION a class for
the calibration, whose intercept is then moved to the classes' shares among all training labels. Scoring is one pass over whole texts without a shuffle.

Cases: null and empty texts have no bytes, difference 0 and size 1, and get the score that follows from
that. Without labels of both classes the score is the share of label 1 (0.5 if there is none). Labels
with null ids, or with two values for an id, are left out. Repeated rows score alike; other columns are
ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.labels import labelled_sample, logistic, remainder, sigmoid, training_labels

PARTS, HELD_OUT = 3, 1
EXCERPTS, EXCERPT_BYTES, CALIBRATION = 256, 440, 3000
PIECE, LEVEL = 1000, 3
SIZES = "struct<difference:double,alone:double,worst:double,bytes:bigint>"


def excerpt(text: bytes) -> bytes:
    """EXCERPT_BYTES from a place given by the text's hash."""
    spare = len(text) - EXCERPT_BYTES
    at = int.from_bytes(hashlib.md5(text).digest()[:8], "big") % spare if spare > 0 else 0
    return text[at : at + EXCERPT_BYTES]


def compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if dictionary is None:
        return zstandard.ZstdCompressor(**plain)
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **plain)


def sizes(text: str | None, bad, good, alone) -> tuple[float, float, float, int]:
    """(difference, size alone, worst piece's difference, bytes), sizes per byte; a difference above 0
    speaks for good text."""
    data = (text or "").encode()
    if not data:
        return 0.0, 1.0, 0.0, 0
    difference, single, worst = 0, 0, 1.0
    # Pieces of even length, so that none is a scrap.
    count = -(-len(data) // PIECE)
    cuts = [len(data) * k // count for k in range(count + 1)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        piece = data[lo:hi]
        d = len(bad.compress(piece)) - len(good.compress(piece))
        difference += d
        single += len(alone.compress(piece))
        worst = min(worst, d / (hi - lo))
    return difference / len(data), single / len(data), worst, len(data)


def columns(x: pd.DataFrame) -> np.ndarray:
    d, s, w = (x[c].to_numpy(float) for c in ("difference", "alone", "worst"))
    short = 10 / np.sqrt(100 + x["bytes"].to_numpy(float))
    parts = [np.ones_like(d), 10 * d, 10 * w, 5 * s, 10 * d * short, 5 * s * short, 5 * short, 50 * d * d, 10 * s * s]
    return np.stack(parts, axis=1)


def measure(bad: bytes, good: bytes):
    @F.pandas_udf(SIZES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = compressor(bad), compressor(good), compressor(None)
        for texts in batches:
            yield pd.DataFrame([sizes(t, *tools) for t in texts], columns=["difference", "alone", "worst", "bytes"])

    return measured


def fit(sample: DataFrame, excerpts: int, base_rate: float) -> dict | float:
    """Dictionaries and weights from a labelled sample; a plain score if a class is missing.

    base_rate is the share of label 1 that the scores are for.
    """
    half = F.pmod(F.xxhash64("doc_id", F.lit("excerpt")), F.lit(2))
    sample = sample.withColumn("half", half)
    shares = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    pools = []
    for value in (0, 1):
        mine = sample.where((F.col("label") == value) & (F.col("text") != ""))
        # Half of the class at most goes into a dictionary, the calibration reads the other half.
        rows = mine.where("half = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(excerpts).select("text")
        spread = rows.select(F.substr("text", *_cut("text")).alias("text")).collect()
        pools.append(b"\n".join(excerpt(r[0].encode()) for r in spread))
    if not all(pools):
        return base_rate
    rest = sample.where("half = 1").select("label", measure(*pools)("text").alias("x")).select("label", "x.*").toPandas()
    if rest["label"].nunique() < 2:
        return base_rate
    weights = logistic(columns(rest), rest["label"].to_numpy(float), ridge=0.1)
    # The sample holds the classes in other shares than the labels.
    prior = rest["label"].mean()
    weights[0] += np.log(base_rate / (1 - base_rate)) - np.log(prior / (1 - prior))
    return {"bad": pools[0], "good": pools[1], "weights": weights.tolist()}


def _cut(text: str) -> tuple:
    """Start and length of a window of a long text, so that no more than a window reaches the driver."""
    window = 8 * EXCERPT_BYTES
    spare = F.greatest(F.length(text) - window, F.lit(1))
    return (F.pmod(F.xxhash64(text), spare) + 1).cast("int"), F.lit(window)


def score(docs: DataFrame, labels: DataFrame, excerpts: int = EXCERPTS, calibration: int = CALIBRATION) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    most = 2 * max(excerpts, calibration)
    known = training_labels(labels, "quality", PARTS, HELD_OUT)
    ones, zeros = known.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    base_rate = ((ones or 0) + 1) / ((ones or 0) + (zeros or 0) + 2)
    model = fit(labelled_sample(docs, labels, "quality", PARTS, HELD_OUT, (most, most)), excerpts, base_rate)
    if isinstance(model, float):
        value = F.lit(model)
        scored = docs
    else:
        weights = np.array(model["weights"])

        @F.pandas_udf("double")
        def calibrated(x: pd.DataFrame) -> pd.Series:
            return pd.Series(sigmoid(columns(x) @ weights))

        scored = docs.withColumn("_sizes", measure(model["bad"], model["good"])("text"))
        value = calibrated("_sizes")
    scored = scored.select("doc_id", (remainder(F.col("doc_id"), PARTS) == HELD_OUT).alias("held_out"), value.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
