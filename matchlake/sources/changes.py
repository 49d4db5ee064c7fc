"""Change capture for append-only tables: which incoming rows change a key, and which partitions to look at.

An incoming row is a change if it differs from the newest stored row of its key. So a value that returns (A, B, A) is
stored again, and one that stays is not. An index of keys beside the table, a Bloom filter of one hash per partition
made of Spark's bitmaps, tells which partitions may hold a key; the others are not read. Each load adds its own keys
to the index, in one small row per partition and 32,768 places.
"""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = ("_key1", "_key2", "_row1", "_row2")
# Places of the filter. A key of another partition shares a place with probability keys / PLACES, which costs a read.
PLACES = 1 << 27
BITMAP = 1 << 15


def with_marks(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Adds two hashes each of the key and of the row's fields. A row without a key is a key of its own."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    def mark(salt: int, columns: Sequence[str]) -> Column:
        return F.xxhash64(F.lit(salt), *columns)

    return df.withColumns(
        {
            **{f"_key{n}": F.when(known, mark(n, keys)).otherwise(mark(n + 2, fields)) for n in (1, 2)},
            **{f"_row{n}": mark(n + 4, fields) for n in (1, 2)},
        }
    )


def changed(rows: DataFrame, stored: DataFrame, loaded_at: str) -> DataFrame:
    """Marked rows that are not among the newest stored rows of their key; repeated ones stay as they are. The stored
    rows are combined by key and content before they are shuffled, so a hot key costs a row per task."""
    key = ["_key1", "_key2"]
    wanted = stored.join(rows.select(*key).distinct(), key, "left_semi")
    kinds = wanted.groupBy(*MARKS).agg(F.max(loaded_at).alias("_at"))
    last = kinds.groupBy(*key).agg(F.max("_at").alias("_last"))
    newest = kinds.join(last, key).where(F.col("_at") == F.col("_last")).select(*MARKS)
    return rows.join(newest, list(MARKS), "left_anti")


def part_name(partition_by: str | None) -> Column:
    return F.coalesce(F.col(partition_by).cast("string"), F.lit("")) if partition_by else F.lit("")


def _place() -> Column:
    return F.pmod(F.col("_key1"), F.lit(PLACES)) + 1


def add_to_index(marked: DataFrame, partition_by: str | None, path: str) -> None:
    """Appends the rows' keys to the index; its rows are combined in each task before they meet."""
    at = marked.select(part_name(partition_by).alias("part"), _place().alias("at"))
    cells = at.groupBy("part", F.bitmap_bucket_number("at").alias("bucket"))
    bits = cells.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits.write.mode("append").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part string, bucket bigint, bits binary").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        read_index(spark, path)
    except AnalysisException:
        return False
    return True


def touched_parts(marked: DataFrame, index: DataFrame) -> list[str]:
    """Partitions that may hold a key of the rows; as many at most as the table has folders."""
    at = marked.select(_place().alias("at")).distinct()
    at = at.select(F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at").alias("bit"))
    # A bucket's rows by load and partition are looked at for each place in it.
    byte = F.conv(F.hex(F.substring("bits", F.expr("CAST(bit DIV 8 AS INT) + 1"), F.lit(1))), 16, 10).cast("int")
    there = F.getbit(byte, F.expr("CAST(bit % 8 AS INT)")) == 1
    return [r[0] for r in index.join(at, "bucket").where(there).select("part").distinct().collect()]
