"""Filter interaction audit: what each filter removes, alone and after others, in every order of the filters.

Every document becomes a mask of the filters it fails, and documents of equal part, mask and labels are
counted, so that a part has at most one cell per mask. A recursive common table expression then enumerates the
orders: a level extends each prefix of filters by an unused letter, joins the mask cells that the prefix has left or
touched, carries the bits applied so far and emits that step's metrics for each cell. Its size depends on
the number of filters alone (325 prefixes of five filters, by 32 masks); the parts' counts are joined to its
last rows and summed. Whole-table duplicates are judged by counts of (text, id), not by a window over equal texts.

Cases: a null text is empty; it has no words, and fails what an empty text fails. Null parts are the empty string.
Null ids come after all others and are alike. Repeated rows each count; rows with the id of the first holder of a
text are not its duplicates. An id's labels are its largest; documents without labels, or without an id, have none. An empty table
has no parts and no rows. Other columns are ignored.
"""

from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import staged
from matchlake.llm.quality_rules import word_array

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at the text alone."""
    words = word_array(text)
    letters = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * letters > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def document_masks(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """(part, doc, text, good, toxic, mask): one row per document, without its text and without filter E."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("doc_id"), text.alias("_text")
    )
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("_text")).values())]
    masks = rows.select("part", "doc_id", F.unhex(F.sha2("_text", 256)).alias("text"), sum(bits, F.lit(0)).alias("mask"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    joined = masks.join(known, masks["doc_id"] == known["_label_id"], "left")
    return joined.select("part", "doc_id", "text", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def cells(masks: DataFrame) -> DataFrame:
    """Staged (part, mask, docs, good, toxic): documents by part and failed filters, duplicates among them."""
    doc = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    rows = masks.groupBy("text", doc.alias("doc"), "part", "mask").agg(
        F.count("*").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    counts = ("docs", "good", "toxic")
    # Of the rows of a text in one part only the first id's can be originals; the rest is summed.
    firsts = rows.groupBy("text", "part", "mask").agg(
        F.min(F.struct("doc", *counts)).alias("first"), *[F.sum(c).alias(c) for c in counts]
    )
    firsts = staged(firsts, "audit-texts")
    origin = staged(firsts.groupBy("text").agg(F.min("first.doc").alias("origin")), "audit-origins")
    met = firsts.join(origin, "text")
    is_first = F.col("first.doc") == F.col("origin")
    original = [F.when(is_first, F.col("first")[c]).otherwise(0).alias(c) for c in counts]
    copies = [(F.col(c) - F.when(is_first, F.col("first")[c]).otherwise(0)).alias(c) for c in counts]
    split = met.select(
        "part", F.inline(F.array(F.struct("mask", *original), F.struct((F.col("mask") + 16).alias("mask"), *copies)))
    )
    total = split.where("docs > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])
    return staged(total, "audit-cells")


def steps(spark, letters: str = "ABCDE") -> DataFrame:
    """(prefix, step, letter, mask, kept, removed, redundant, unique_fails): what the last filter of each prefix does
    to a document that fails the filters of `mask`, as 0 or 1."""
    values = ", ".join(f"('{c}', {1 << k})" for k, c in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE filters(next, bit) AS (VALUES {values}),
        masks(cell) AS (SELECT CAST(id AS INT) FROM range({1 << len(letters)})),
        walk(prefix, letter, step, applied, own, mask, kept, removed, redundant, unique_fails) AS (
            SELECT CAST('' AS STRING), CAST('' AS STRING), 0, 0, 0, cell, 1, 0, 0, 0 FROM masks
            UNION ALL
            SELECT prefix || next, next, step + 1, applied | bit, bit, cell,
                IF(cell & (applied | bit) = 0, 1, 0),
                IF(cell & applied = 0 AND cell & bit <> 0, 1, 0),
                IF(cell & applied <> 0 AND cell & bit <> 0, 1, 0),
                IF(cell = bit, 1, 0)
            FROM walk JOIN filters ON applied & bit = 0 JOIN masks ON cell = mask
        )
        SELECT prefix, step, letter, mask, kept, removed, redundant, unique_fails FROM walk WHERE step > 0
    """)


def audit(cell_counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order and step with the step's counts. cell_counts: (part, mask, docs, good, toxic)."""
    walk = staged(steps(cell_counts.sparkSession, letters), "audit-steps")
    met = cell_counts.join(walk, "mask")
    weighed = {
        "kept": F.col("docs") * F.col("kept"),
        "removed": F.col("docs") * F.col("removed"),
        "redundant": F.col("docs") * F.col("redundant"),
        "unique_fails": F.col("docs") * F.col("unique_fails"),
        "good_lost": F.col("good") * F.col("removed"),
        "toxic_lost": F.col("toxic") * F.col("removed"),
    }
    sums = met.groupBy("part", "prefix", "step", "letter").agg(*[F.sum(x).cast("bigint").alias(c) for c, x in weighed.items()])
    # A prefix begins as many orders as there are orders of the letters left.
    orders = F.array(*[F.lit(factorial(len(letters) - k)) for k in range(len(letters) + 1)])
    same = Window.partitionBy("part", "letter")
    sums = sums.withColumn("shapley", F.sum(F.col("removed") * F.get(orders, F.col("step"))).over(same).cast("bigint"))
    whole = walk.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    parts = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.length("filter_order"))).alias("_length"))
    parts = parts.select("filter_order", F.left("filter_order", F.col("_length")).alias("prefix"))
    return sums.join(parts, "prefix").select("part", "filter_order", F.col("step").cast("int"), "letter", *COUNTS, "shapley")


def query(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(cells(document_masks(docs, labels)))


SQL = r"""
WITH f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS o
    FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, row_number() OVER () AS r,
        min(doc_id) OVER (PARTITION BY t) AS origin FROM d
), known AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), fails AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > origin THEN 16 ELSE 0 END AS mask
    FROM w LEFT JOIN known USING (doc_id)
), cells AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, mask
), placed AS (
    SELECT o, k AS step, o[k:k] AS letter, (SELECT bit FROM f WHERE f.letter = o[k:k]) AS bit,
        coalesce((SELECT sum(bit) FROM f WHERE contains(o[1:k - 1], f.letter)), 0) AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS k)
), counted AS (
    SELECT part, o, step, letter,
        sum(CASE WHEN mask & CAST(before + bit AS BIGINT) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & CAST(before AS BIGINT) = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & CAST(before AS BIGINT) > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & CAST(before AS BIGINT) = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & CAST(before AS BIGINT) = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, placed GROUP BY part, o, step, letter
)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, letter, CAST(kept AS BIGINT) AS kept,
    CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
