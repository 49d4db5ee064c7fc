"""Bounded samples of labelled documents, and logistic regression on few columns."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import smallest, staged


def remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo parts; 0 for a null id's empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def training_labels(labels: DataFrame, label: str, parts: int, held_out: int) -> DataFrame:
    """(doc_id, label) without ids whose remainder is held_out, null ids, and ids with two labels."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_other"))
    known = known.where((F.col("label") == F.col("_other")) & (remainder(F.col("doc_id"), parts) != held_out))
    return known.select("doc_id", "label")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, rows: tuple[int, int]):
    """Staged (doc_id, label, text) of at most rows[0] documents labelled 0 and rows[1] labelled 1.

    Of the training labels, the smallest hashes of the ids are taken, so the sample is the same in every
    run. The ids are bounded by `rows` and broadcast. docs: (doc_id, text).
    """
    known = staged(training_labels(labels, label, parts, held_out), "known-labels")
    there = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    picked = None
    for value, most in enumerate(rows):
        mine = known.where(F.col("label") == value)
        part = smallest(mine, F.xxhash64("doc_id"), most, there.get(value, 0), "doc_id")
        picked = part if picked is None else picked.union(part)
    picked = staged(picked.select("doc_id", "label"), "sample-ids")
    # An id that several rows have counts once.
    found = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min("text").alias("text")
    )
    return staged(found.select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text")), "sample")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of columns x for labels y by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move * min(1.0, 5 / (np.abs(move).max() + 1e-12))
        if np.abs(move).max() < 1e-6:
            break
    return w
