"""Facts stored in buckets of a key, so that joins and windows on it need no exchange of the fact.

Rows of a key lie in one bucket; a key that holds a third of all rows makes one long bucket, so such facts are better
bucketed by several columns (match and over), which serves windows over those columns alike. Two tables join without
an exchange if they have the same keys and number of buckets. Each task writes into every bucket it has rows
for; the table is dealt by its key first, so a bucket is one file.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 64


def write_bucketed(
    df: DataFrame, table: str, by: Sequence[str], buckets: int = BUCKETS, order: Sequence[str] = (), path: str | None = None
) -> None:
    """Writes or replaces a catalog table in buckets of `by`, sorted by `by` and `order` within each."""
    if buckets < 1 or not by:
        raise ValueError("a bucketed table has at least one key and one bucket")
    dealt = df.repartition(buckets, *[F.col(c) for c in by])
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by, *[c for c in order if c not in by])
    (writer.option("path", path) if path else writer).saveAsTable(table)
