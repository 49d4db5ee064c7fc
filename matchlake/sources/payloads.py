"""Payloads kept whole as VARIANT, so that a field a producer adds is readable before any schema names it.

Payloads that do not parse become null variants and are counted by `drift`; other rows are unaffected.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VARIANT_TYPES = {"string": "STRING", "boolean": "BOOLEAN", "int": "BIGINT", "bigint": "BIGINT", "double": "DOUBLE"}


def with_variant(df: DataFrame, text: str = "payload", name: str = "data") -> DataFrame:
    """Adds the payload as a variant; null where it is null or does not parse."""
    return df.withColumn(name, F.try_parse_json(text))


def field(data: str, path: str, kind: str) -> Column:
    """Value at a JSON path; null where it is absent or of another type."""
    return F.try_variant_get(data, path, kind)


def fields(df: DataFrame, data: str = "data") -> DataFrame:
    """(field, type, payloads): each top-level field and type found, and how many payloads have it."""
    parts = F.variant_get(data, "$", "map<string, variant>")
    is_object = F.schema_of_variant(data).startswith("OBJECT")
    each = df.where(is_object).select(F.explode(parts).alias("field", "_value"))
    kind = F.regexp_extract(F.schema_of_variant("_value"), r"^\w+", 0)
    return each.groupBy("field", F.coalesce(kind, F.lit("VOID")).alias("type")).agg(F.count("*").alias("payloads"))


def drift(df: DataFrame, declared: StructType, data: str = "data") -> DataFrame:
    """Rows (field, declared, found, payloads, status) where payloads depart from the schema.

    `added`: no schema field; `missing`: in no payload; `retyped`: another type than declared (whole numbers may stand
    for doubles); `unreadable`: payloads that are no JSON object, with a null field. Nulls are not a type.
    """
    spark = df.sparkSession
    names = [(f.name, VARIANT_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())) for f in declared]
    wanted = spark.createDataFrame(names, "field string, declared string")
    found = fields(df, data).where(F.col("type") != "VOID").withColumnRenamed("type", "found")
    fits = F.col("declared") == F.col("found")
    fits |= (F.col("declared") == "DOUBLE") & (F.col("found").isin("BIGINT", "DECIMAL"))
    status = F.when(F.col("declared").isNull(), "added").when(F.col("found").isNull(), "missing").when(~fits, "retyped")
    rows = wanted.join(found, "field", "full").withColumn("status", status).where("status is not null")
    bad = ~F.coalesce(F.schema_of_variant(data).startswith("OBJECT"), F.lit(False))
    unread = df.agg(F.count_if(bad).alias("payloads")).where("payloads > 0").withColumn("status", F.lit("unreadable"))
    out = rows.unionByName(unread, allowMissingColumns=True)
    return out.select("field", "declared", "found", F.coalesce("payloads", F.lit(0)).alias("payloads"), "status")
