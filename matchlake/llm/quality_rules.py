"""Quality rules from repeated text: word statistics inside a document, line frequency across documents.

A line is normalised (lower case, digits to 0, white space folded), hashed, and counted per host by the
distinct documents that hold it. Lines above the limits are boilerplate and are removed; a document
that keeps too little is rejected. All of it is DataFrame expressions.

Distinct documents: equal texts are one document. A line that at least min_docs different texts of a host
hold is shared. A text with more than OWN_SHARE of its words in lines that are not shared is a document of
its own; a text below it is little but shared lines, and all such texts with the same smallest shared line
count as one. So the lines of a block (menu, header, licence) are all found, however often they come
together, while a page copied a thousand times with a line changed here or there is one document, or a few.
Near copies that differ in more than OWN_SHARE of their words count as documents of their own.

The limit is a number of documents, so a line is judged alike in small and large hosts.

Cases: a null or empty text has no words and no lines, so it fails the base rules. Null hosts form one
host, null ids are ordinary ids, repeated rows are judged alike, other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import BLANKS, join_rows, staged, text_key

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Share of a text's words outside shared lines, from which on it is a document of its own.
OWN_SHARE = 0.2


def line_key(line: Column) -> Column:
    """16 hex digits for a normalised line."""
    folded = F.regexp_replace(F.btrim(F.lower(line), F.lit(BLANKS)), r"[\x20\x09-\x0D]+", " ")
    return F.left(F.md5(F.regexp_replace(folded, "[0-9]", "0").cast("binary")), F.lit(16))


def word_array(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def with_repeats(df: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the number of words that lie in a window of WINDOW words found twice or more.

    Windows are hashed; a document without equal hashes is done. In the others the (hash, place)
    pairs are sorted, and the places with an equal neighbour cover the words counted.
    """
    hashes, size = F.col("_hashes"), F.size("_hashes")
    window = F.transform(
        F.sequence(F.lit(0), size - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
    )
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_windows", F.when(size >= WINDOW, window).otherwise(none)).drop("_hashes")
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_pairs", F.when(repeats, pairs)).drop("_windows")
    place = F.col("_pairs")
    near = F.filter(
        place,
        lambda e, k: F.coalesce(F.get(place, k - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get(place, k + 1)["h"] == e["h"], F.lit(False)),
    )
    df = df.withColumn("_starts", F.sort_array(F.transform(near, lambda e: e["i"]))).drop("_pairs")
    starts = F.col("_starts")
    covered = F.aggregate(
        F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), s - F.coalesce(F.get(starts, k - 1), s - WINDOW))),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return df.withColumn(name, F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_starts")


def line_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"):
    """One staged row per document: its words' statistics, and key and words of each of its lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).alias("host"),
        text_key(F.col(text_col)).alias("text_key"),
        text.alias("_text"),
        word_array(text).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("_lines"),
    )
    base = with_repeats(base, "_words", "n_repeat_words")
    counted = base.select(
        "doc_id",
        "host",
        "text_key",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.translate("_text", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(
            "_lines", lambda line: F.struct(line_key(line).alias("key"), F.size(word_array(line)).alias("words"))
        ).alias("lines"),
    )
    return staged(counted, "line-statistics")


def frequent_lines(stats: DataFrame, min_docs: int) -> DataFrame:
    """(host, key) of lines that at least min_docs distinct documents of the host hold."""
    # Key and words as one string: arrays of strings are made distinct by hash, those of structs pair by pair.
    packed = F.transform("lines", lambda x: F.concat(x["key"], x["words"].cast("string")))
    lines = stats.select("host", "text_key", F.array_distinct(packed).alias("_lines"))
    all_words = F.aggregate("_lines", F.lit(0).cast("bigint"), lambda n, x: n + F.substr(x, F.lit(17)).cast("bigint"))
    lines = lines.select("host", "text_key", all_words.alias("all_words"), F.explode("_lines").alias("_line")).select(
        "host", "text_key", "all_words", F.left("_line", F.lit(16)).alias("key"),
        F.substr("_line", F.lit(17)).cast("bigint").alias("words"),
    )
    texts = lines.select("host", "key", "text_key").distinct().groupBy("host", "key").agg(F.count("*").alias("texts"))
    shared = staged(texts.where(F.col("texts") >= min_docs).select("host", "key"), "shared-lines")

    held = join_rows(lines, shared, ["host", "key"], "left_semi")
    by_text = held.groupBy("host", "text_key").agg(
        F.max("all_words").alias("all_words"), F.collect_set(F.struct("key", "words")).alias("held")
    )
    own = F.col("all_words") - F.aggregate("held", F.lit(0).cast("bigint"), lambda n, x: n + x["words"])
    told = F.when(own > OWN_SHARE * F.col("all_words"), F.col("text_key").cast("string"))
    told = F.coalesce(told, F.array_min("held.key"))
    documents = by_text.select("host", F.explode("held.key").alias("key"), told.alias("told")).distinct()
    counts = documents.groupBy("host", "key").agg(F.count("*").alias("docs"))
    return staged(counts.where(F.col("docs") >= min_docs).select("host", "key"), "frequent-lines")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = 50,
    min_kept: float = 0.3,
    min_words: int = 10,
    max_repeat_pct: int = 20,
) -> DataFrame:
    """One row per document: statistics, words in removed lines, keys of removed lines, base verdict
    and verdict. min_kept is the share of its words a document must keep."""
    stats = line_statistics(docs, id_col, text_col, host_col)
    frequent = frequent_lines(stats, min_docs)
    lines = stats.select("doc_id", "host", "text_key", F.inline("lines"))
    hit = join_rows(lines, frequent, ["host", "key"], "left_semi")
    # Rows that agree in id, text and host have the same lines removed.
    removed = hit.groupBy("doc_id", "host", "text_key").agg(F.collect_set("key").alias("removed_keys"))
    judged = join_rows(stats, removed, ["doc_id", "host", "text_key"], "left")
    judged = judged.withColumn("removed_keys", F.coalesce("removed_keys", F.array().cast("array<string>")))
    gone = F.filter("lines", lambda x: F.array_contains(F.col("removed_keys"), x["key"]))
    removed_words = F.aggregate(gone, F.lit(0).cast("bigint"), lambda n, x: n + x["words"])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    kept_share = F.col("n_words") - F.col("removed_words") >= min_kept * F.col("n_words")
    return (
        judged.withColumn("removed_words", F.when(F.size("removed_keys") > 0, removed_words).otherwise(F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & kept_share)
        .drop("lines")
    )


def clean(
    docs: DataFrame, id_col="doc_id", text_col="text", host_col="source", length_col: str | None = None, **limits
) -> DataFrame:
    """The documents that are kept, without their frequent lines, in their own columns. length_col, if it
    is named, is the text's number of characters and follows the text."""
    verdict = judge(docs, id_col, text_col, host_col, **limits).where("kept")
    verdict = verdict.groupBy("doc_id", "host", "text_key").agg(F.first("removed_keys").alias("removed_keys"))
    doc = F.col("doc")
    packed = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(id_col).alias("doc_id"),
        F.col(host_col).alias("host"),
        text_key(F.col(text_col)).alias("text_key"),
    )
    text = doc[text_col]
    left = F.filter(
        F.split(text, "\n"),
        lambda line: (F.btrim(line, F.lit(BLANKS)) == "")
        | ~F.array_contains(F.col("removed_keys"), line_key(line)),
    )
    text = F.when(F.size("removed_keys") > 0, F.array_join(left, "\n")).otherwise(text)
    kept = join_rows(packed, verdict, ["doc_id", "host", "text_key"])
    changed = {text_col: text}
    if length_col:
        length = F.when(F.size("removed_keys") > 0, F.length(text).cast(docs.schema[length_col].dataType))
        changed[length_col] = length.otherwise(doc[length_col])
    return kept.select(*[changed.get(c, doc[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words",
    )


BLANK_SQL = r"[\x20\x09-\x0D]+"
SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), windows AS (
    SELECT r, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS win
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1
), repeats AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r
), lines AS (
    SELECT w.r, d.source, x.line AS line, left(md5(regexp_replace(regexp_replace(regexp_replace(lower(x.line),
        '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g')), 16) AS k
    FROM w JOIN d USING (r), unnest(w.ls) AS x(line)
), entries AS (
    SELECT DISTINCT l.source, md5(d.t) AS text, l.k, len(regexp_extract_all(l.line, '[^\x20\x09-\x0D]+')) AS n
    FROM lines l JOIN d USING (r)
), whole AS (
    SELECT source, text, sum(n) AS n FROM entries GROUP BY source, text
), held AS (
    SELECT e.* FROM entries e JOIN (SELECT source, k FROM entries GROUP BY source, k HAVING count(*) >= 50) s
    ON e.source IS NOT DISTINCT FROM s.source AND e.k = s.k
), told AS (
    SELECT h.source, h.k, CASE WHEN w.n - sum(h.n) OVER same > 0.2 * w.n THEN h.text ELSE min(h.k) OVER same END AS told
    FROM held h JOIN whole w ON h.source IS NOT DISTINCT FROM w.source AND h.text = w.text
    WINDOW same AS (PARTITION BY h.source, h.text)
), frequent AS (
    SELECT source, k FROM told GROUP BY source, k HAVING count(DISTINCT told) >= 50
), gone AS (
    SELECT l.r, sum(len(regexp_extract_all(l.line, '[^\x20\x09-\x0D]+'))) AS n
    FROM lines l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.k = f.k GROUP BY l.r
), base AS (
    SELECT d.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
    FROM d JOIN w USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - removed_words >= 0.3 * n_words AS kept,
    removed_words
FROM base
"""
