"""Top-k, paging and row numbers that stay distributed and run no job while a frame is built."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows; `order` must end in a unique column. Each task keeps only k rows."""
    return df.orderBy(*order).limit(k)


def with_ordinal(
    df: DataFrame, order: Sequence[Column], name: str, bucket: Column, descending: bool = False
) -> DataFrame:
    """1-based position in the total order, without pulling all rows into one task.

    `bucket` must not contradict the order: rows of an earlier bucket come earlier. A row's position is its place in
    its bucket plus the rows of the buckets before, so only one count per bucket is summed centrally.
    """
    keyed = df.withColumn("_bucket", bucket)
    first = F.col("_bucket").desc_nulls_last() if descending else F.col("_bucket").asc_nulls_first()
    before = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select(F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    placed = keyed.withColumn("_at", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    numbered = placed.join(starts, F.col("_bucket").eqNullSafe(F.col("_of")))
    return numbered.select((F.col("_start") + F.col("_at")).alias(name), *df.columns)


def page(
    df: DataFrame,
    order: Sequence[Column],
    bucket: Column,
    descending: bool = False,
    number: int = 1,
    per_page: int = 20,
) -> DataFrame:
    """One page, cut out by row number at any depth; `order` must end in a unique column."""
    if number < 1 or not 1 <= per_page <= 100:
        raise ValueError("pages start at 1 and hold 1 to 100 rows")
    skip = (number - 1) * per_page
    numbered = with_ordinal(df, order, "_row", bucket, descending)
    return numbered.where(F.col("_row").between(skip + 1, skip + per_page)).orderBy("_row").limit(per_page).drop("_row")


def total(df: DataFrame) -> DataFrame:
    """Number of rows over all pages, in one row; also where a page is empty."""
    return df.agg(F.count("*").alias("total"))


def page_with_total(
    df: DataFrame,
    order: Sequence[Column],
    bucket: Column,
    descending: bool = False,
    number: int = 1,
    per_page: int = 20,
) -> DataFrame:
    """One page, each row with the number of rows over all pages. A page past the end has no rows; `total` has the
    number then."""
    return page(df, order, bucket, descending, number, per_page).withColumn("total", total(df).scalar())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """Last n rows per key. The rank filter is applied before the shuffle too, so a hot key sends
    at most n rows per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
