"""Table readers and writers. The storage format is a parameter, so Delta works where its package is."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from matchlake.sources import versions

CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, path: str, schema: StructType, lines: bool = True) -> DataFrame:
    """JSON with a declared schema. lines=True reads one object per line, which can be split;
    otherwise each file is one (pretty-printed) array."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_json_tolerant(
    spark: SparkSession, path: str, schema: StructType, lines: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text and file of what could not be read.

    lines=True judges each line by itself; otherwise a file is one array and stands or falls whole.
    """
    text = spark.read.text(path, wholetext=not lines).where(F.trim("value") != "")
    raw = text.select("value", F.col("_metadata.file_path").alias("file"))
    if lines:
        kept = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        parsed = raw.withColumn("row", F.from_json("value", kept, {"columnNameOfCorruptRecord": CORRUPT}))
        bad = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
        good = parsed.where(~bad)
    else:
        parsed = raw.withColumn("rows", F.from_json("value", ArrayType(schema)))
        bad = F.col("rows").isNull()
        good = parsed.select(F.explode("rows").alias("row"))
    columns = [F.col(f"row.{c}").alias(c) for c in schema.fieldNames()]
    return good.select(*columns), parsed.where(bad).select("value", "file")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """A table folder; of a versioned table its current version."""
    if fmt == "parquet" and versions.current(spark, path) is not None:
        return versions.read(spark, path)
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", True) if merge_schema else reader).load(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "delta")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Relational source. partition = (column, lower, upper, parts) reads in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if partition:
        column, lower, upper, parts = partition
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **(properties or {})).mode(mode).save()


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    merge_schema: bool = False,
    replace_partitions: bool = False,
    rebalance: bool = False,
    cluster_by: Sequence[str] = (),
) -> int:
    """Writes and returns the row count, observed during the write instead of counted again.

    replace_partitions overwrites only the partitions present in df. rebalance shuffles rows to even
    files per partition, for results whose tasks would each write a sliver into every partition.
    cluster_by does so by those columns and sorts by them: rows of a key lie together, so later
    partial aggregates by the key come out nearly complete and files can be skipped by it. A key
    larger than a file is still split over several.
    """
    seen = Observation()
    if cluster_by:
        layout = [*partition_by, *cluster_by]
        df = df.hint("rebalance", *partition_by, cluster_by[0]).sortWithinPartitions(*layout)
    elif rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if merge_schema and fmt == "delta":
        writer = writer.option("mergeSchema", True)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return int(seen.get["rows"])


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> int:
    return write_table(df, path, mode, partition_by)


def write_delta(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    merge_schema: bool = False,
) -> int:
    return write_table(df, path, mode, partition_by, "delta", merge_schema)
