"""Mixing sources to target weights by hash-threshold histograms.

Sources in order of code points, null last, get the weights in turn. They share `share` of all words;
a target stops at `most` times its source's words and the excess is shared again by weight.

A target is met with whole copies of all documents of the source plus one more copy of those whose hash
lies below a threshold. The threshold comes from sums of words by source and hash bucket: the bucket in
which the budget ends is refined into finer buckets until one hash value is left, so each level reads
the rows of one bucket per source. Nothing is sorted and documents meet only one row per source.
Thresholds of smaller budgets lie below those of larger ones: a smaller mix is part of a larger one.

Cases: a null or empty text has no words and is never taken. Sources without words have target 0.
Null ids hash like any other. Repeated rows share a hash and are taken together, so a source's sum is
off its target by half a document, or half such a group, at most. Other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from matchlake.llm.common import join_rows, numbered, staged, text_key
from matchlake.llm.quality_rules import word_array

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
HASH_BITS, LEVEL_BITS = 60, 10


def place(id_col: Column, text: Column) -> Column:
    """A document's place in its source's hash order, 0 to 2**60 - 1."""
    return F.shiftrightunsigned(F.xxhash64(id_col, text_key(text)), 64 - HASH_BITS)


def words(text: Column) -> Column:
    return F.size(word_array(F.coalesce(text, F.lit("")))).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds the target to (source, source_size). The level - words per unit of weight - is raised until
    the set of sources at their limit no longer grows; each step is one aggregate."""
    ranked = numbered(sources, "source", "rank")
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = staged(
        ranked.select(
            "source",
            "source_size",
            F.get(table, F.pmod("rank", F.lit(len(weights)))).alias("weight"),
            (most * F.col("source_size")).cast("double").alias("limit"),
        ),
        "weights",
    )
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1
    while True:
        full = F.col("limit") <= level * F.col("weight")
        got, taken, weight = ranked.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if got == before or not weight:
            break
        before, level = got, (budget - (taken or 0.0)) / weight
    return ranked.select("source", "source_size", F.least("limit", level * F.col("weight")).alias("target"))


def thresholds(rows: DataFrame, aims: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, below): every document is taken `copies` times, and once
    more where its place is less than `below`. rows: (source, place, size)."""
    size = F.col("source_size")
    copies = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int")
    aims = aims.withColumn("copies", copies).withColumn("left", F.col("target") - F.col("copies") * size)
    done = []
    # Bounds of the bucket being refined: its first place, and the words still wanted from it.
    state = staged(aims.withColumn("low", F.lit(0).cast("bigint")), "mix-aims")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = join_rows(rows, state.select("source", "low"), ["source"]).where(
            F.shiftright("place", shift + LEVEL_BITS) == F.shiftright("low", shift + LEVEL_BITS)
        )
        buckets = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("place").alias("first"), F.max("place").alias("last")
        )
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        buckets = buckets.withColumn("upto", F.sum("words").over(running))
        ends = join_rows(buckets, state.drop("low"), ["source"]).where(F.col("upto") > F.col("left"))
        end = F.min(F.struct("bucket", "words", "first", "last", "upto")).alias("end")
        ends = ends.groupBy("source").agg(end)
        joined = staged(join_rows(state, ends, ["source"], "left"), "mix-level")
        all_taken, single = F.col("end").isNull(), F.col("end.first") == F.col("end.last")
        wanted = F.col("left") - (F.col("end.upto") - F.col("end.words"))
        nearest = F.when(2 * wanted > F.col("end.words"), F.col("end.last") + 1).otherwise(F.col("end.first"))
        below = F.when(all_taken, F.lit(1 << HASH_BITS)).otherwise(nearest)
        shown = [*aims.columns[:3], "copies", below.alias("below")]
        done.append(joined.where(all_taken | single).select(*shown))
        rest = joined.where(~(all_taken | single))
        if shift == 0 or rest.isEmpty():
            break
        state = rest.select(
            *aims.columns[:3], "copies", wanted.alias("left"), F.shiftleft("end.bucket", shift).alias("low")
        )
        state = staged(state, "mix-aims")
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return staged(out, "mix-thresholds")


def plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST):
    """(rows, thresholds): rows has one line per document: doc_id, source, size, place."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"),
        place(F.col(id_col), F.col(text_col)).alias("place"),
    )
    rows = staged(rows, "mix-rows")
    sources = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    return rows, thresholds(rows.select("source", "place", "size"), targets(sources, weights, share, most))


def taken_copies() -> Column:
    return F.col("copies") + F.when(F.col("place") < F.col("below"), 1).otherwise(0)


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **options) -> DataFrame:
    """The mixed documents in docs' own columns, each as often as the mix takes it."""
    _, limits = plan(docs, id_col, text_col, source_col, **options)
    doc = F.col("doc")
    packed = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(source_col).alias("source"),
        place(F.col(id_col), F.col(text_col)).alias("place"),
        (words(F.col(text_col)) > 0).alias("any"),
    )
    rows = join_rows(packed.where("any"), limits, ["source"]).withColumn("times", taken_copies())
    rows = rows.where("times > 0").select("doc", F.explode(F.sequence(F.lit(1), "times")))
    return rows.select(*[doc[c].alias(c) for c in docs.columns])


def query(spark, sf_dir):
    rows, limits = plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = join_rows(rows, limits, ["source"])
    taken = (taken_copies() * F.col("size")).cast("bigint")
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source")
