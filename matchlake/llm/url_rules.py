"""URL filter by sort-merge range join: nested rules as intervals of reversed-host keys.

The key of a rule is its host with the labels reversed, a slash, and its path: `com.example//en/`. A URL
is probed once for each of its host's label suffixes, with its whole path, so a rule fits exactly where
its key is a prefix of a probe, that is, where the probe lies in the rule's interval. Prefix intervals
are nested or apart. Probes and rules are cut into key ranges, a rule goes to every range that it
overlaps, each range is sorted, and one sweep keeps the stack of the rules that are still open; its top
is the longest that fits. Of a URL's probes the longest rule wins; of equal lengths that with the longer
host; of two verdicts for one rule, block.

Only distinct keys are probed, and each key's rule is joined back to the hosts and paths that have it: all
root pages under `.com` are the one probe `com//`, so no key range holds more than one row of a key.
Range bounds come from a sample of SAMPLE keys per range; it decides how even the ranges are, nothing else.

Cases: a null url, or one without "://", has an empty host and path and gets the default verdict unless a
rule fits the empty host. Null rules are dropped. Tables may be empty. Other columns are ignored.
"""

import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import join_rows, smallest, staged

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SAMPLE = 20
# Longest part of a key that is kept as a range bound.
BOUND_CHARS = 256
LAST = "\U0010ffff"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (range, key, rules first). The stack holds (key, rule host, rule path, verdict)."""
    here, stack = None, []
    for batch in batches:
        out = []
        columns = (batch[c] for c in ("range", "key", "is_probe", "host", "path", "verdict"))
        for part, key, is_probe, host, path, verdict in zip(*columns, strict=True):
            if part != here:
                here, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_probe:
                stack.append((key, host, path, verdict))
            elif stack:
                out.append((key, *stack[-1][1:]))
        yield pd.DataFrame(out, columns=["key", "rule_host", "rule_path", "rule_verdict"])


def match(urls: DataFrame, rules: DataFrame, parts: int | None = None) -> DataFrame:
    """(host, path, rule, verdict) for each distinct (host, path) of urls that a rule fits."""
    spark = urls.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    labels = reversed_labels(F.col("host"))
    rules = rules.dropna(subset=["host", "path", "verdict"]).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = staged(
        rules.withColumn("key", F.concat(F.array_join(labels, "."), F.lit("/"), "path")).withColumn(
            "labels", F.size(labels)
        ),
        "url-rules",
    )
    deepest = rules.agg(F.max("labels")).first()[0] or 0
    probes = urls.select("host", "path").distinct().withColumn("_labels", labels)
    suffixes = F.when(
        F.lit(deepest) > 0, F.sequence(F.lit(1), F.least(F.size("_labels"), F.lit(max(deepest, 1))))
    ).otherwise(F.array().cast("array<int>"))
    probes = probes.withColumn("_n", F.explode(suffixes))
    key = F.concat(F.array_join(F.slice("_labels", F.lit(1), F.col("_n")), "."), F.lit("/"), F.col("path"))
    probes = staged(probes.select("host", "path", key.alias("key")), "url-probes")

    probed = staged(probes.select("key").distinct(), "url-keys")

    sample = smallest(probed, F.xxhash64("key"), SAMPLE * parts, probed.count(), "key")
    keys = sorted(r[0] for r in sample.select(F.left("key", F.lit(BOUND_CHARS))).collect())
    bounds = sorted(set(keys[SAMPLE::SAMPLE]))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in key], dtype="int32")

    @F.pandas_udf("int")
    def range_before(key: pd.Series) -> pd.Series:
        return pd.Series([bisect_left(bounds, k) for k in key], dtype="int32")

    none = F.lit(None).cast("string")
    dealt_probes = probed.select(
        range_of("key").alias("range"), "key", F.lit(True).alias("is_probe"), none.alias("host"), none.alias("path"),
        none.alias("verdict"),
    )
    spans = rules.withColumn("_low", range_of("key")).withColumn("_high", range_before(F.concat("key", F.lit(LAST))))
    dealt_rules = spans.select(
        F.explode(F.sequence("_low", "_high")).alias("range"),
        "key",
        F.lit(False).alias("is_probe"),
        "host",
        "path",
        "verdict",
    )
    rows = dealt_probes.union(dealt_rules).repartition(parts, "range").sortWithinPartitions("range", "key", "is_probe")
    found = rows.mapInPandas(_sweep, "key string, rule_host string, rule_path string, rule_verdict string")
    found = probes.join(staged(found, "url-key-rules"), "key")
    best = F.max(
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"),
            F.length("rule_host").alias("host_size"),
            F.concat("rule_host", "rule_path").alias("rule"),
            F.col("rule_verdict").alias("verdict"),
        )
    )
    return found.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, id_col="page_id", url_col="url", default="allow", parts=None) -> DataFrame:
    """One row per page: id, host, path, the longest rule that fits, verdict."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    found = staged(match(urls, rules, parts), "url-verdicts")
    judged = join_rows(urls, found, ["host", "path"], "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def query(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


SQL = """
WITH rules(h, p, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), cut AS (
    SELECT row_number() OVER () AS r, page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
    SELECT r, page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ranked AS (
    SELECT r, h || p AS rule, verdict,
        row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, length(h) DESC) AS place
    FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT u.page_id, u.host, u.path, k.rule, coalesce(k.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN ranked k ON u.r = k.r AND k.place = 1
"""
