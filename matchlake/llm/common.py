"""Helpers shared by the text operators: scratch tables, word patterns, row keys, components."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the session names in spark.checkpoint.dir. A folder of this machine takes its
    place only in local mode, where it is shared by all tasks."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="matchlake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends here, and later plans see
    the true size of the table. row_group: bytes of a row group, if not Parquet's own."""
    path = scratch(df.sparkSession, name)
    options = {"parquet.block.size": str(row_group)} if row_group else {}
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """64-bit hash of a text, null and empty apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def smallest(df: DataFrame, mark: Column, rows: int, total: int, ties: str) -> DataFrame:
    """The `rows` rows with the smallest 64-bit hash `mark`, of about `total`.

    Only hashes below a bound that lets about twice as many through are sorted, so each task sends its share of
    those and not `rows` rows.
    """
    marked = df.withColumn("_mark", mark)
    share = 2 * rows / max(total, 1)
    if share < 1:
        marked = marked.where(F.col("_mark") < F.lit(int(-(2**63) + share * 2**64)))
    return marked.orderBy("_mark", ties).limit(rows).drop("_mark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_rows(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which any may be null; right's other columns must have names of their own."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(right, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """Adds the 0-based place in the order of one column, nulls last, without one task for all rows.

    Rows are range-partitioned, sorted and written; a row's place is that in its partition plus the
    rows of earlier partitions, of which there is one count each.
    """
    key = F.col(order).asc_nulls_last()
    fixed = staged(
        df.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()), "sorted"
    )
    fixed = fixed.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = fixed.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return fixed.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_at")).select(*df.columns, name)
