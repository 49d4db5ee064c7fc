"""Fill-in-the-middle transformation as a pyarrow.compute pipeline.

A text is cut into units: a word with the blanks before it, or the blanks at the end. For each Arrow batch the units
are split into list arrays and flattened with the index of their parent; a unit's ordinal in its text decides
its role - prefix, middle or suffix; the units of each role are filtered, put back into lists and joined
into one piece per text, and the pieces are joined in the order of the text's form. There is no loop over
texts or units, and no shuffle: every document is transformed where it is read.

Which texts change, where they are cut and in what order they are written depends on the id and the seed only.

Units are separated by the byte 0xFF, which no UTF-8 text holds, so any text can be cut. Texts that hold one of the
marks themselves stay plain, and so every output can be turned back into its text (`restored`).

Bounds: a batch is handled in slices of about SLICE bytes; a longer text is a slice of its own.

Cases: a null or empty text has no units and is plain, its output the empty text. Blanks alone are one unit. A null
id has the hash of an empty id. Repeated rows give equal outputs. Other columns, whatever their names,
are not read; `transform` keeps them.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 42, 50, 80
SPLIT = b"\xff"
SLICE = 4 << 20
COLUMNS = {"n": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType(), "output": StringType()}


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _modulo(x: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def _pieces(units: pa.Array, role: pa.Array, wanted: int, sizes: pa.Array) -> pa.Array:
    """The units of one role, in lists of the given sizes, joined."""
    ends = pc.cumulative_sum(pa.concat_arrays([pa.array([0], pa.int64()), sizes])).cast(pa.int32())
    mine = pa.ListArray.from_arrays(ends, pc.filter(units, pc.equal(role, wanted)))
    return pc.binary_join(mine, b"")


def rearranged(text: pa.Array, h: list[pa.Array], rate: int, spm: int, marks: tuple[str, str, str]) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a slice of texts."""
    raw = pc.fill_null(text, "").cast(pa.binary())
    lists = pc.split_pattern(pc.replace_substring_regex(raw, pattern=UNIT, replacement=rb"\1" + SPLIT), SPLIT)
    # Each unit is followed by a separator, so a list ends with an empty element.
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    starts = pc.subtract(pc.cumulative_sum(pc.add(n, 1)), pc.add(n, 1))
    ordinal = pc.subtract(pa.array(range(len(units)), pa.int64()), pc.take(starts, parent))
    cuts = [_modulo(x, pc.add(n, 1)) for x in h[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    # 0 prefix, 1 middle, 2 suffix, 3 the empty element.
    role = pc.add(
        pc.add(
            pc.greater_equal(ordinal, pc.take(low, parent)).cast(pa.int64()),
            pc.greater_equal(ordinal, pc.take(high, parent)).cast(pa.int64()),
        ),
        pc.greater_equal(ordinal, pc.take(n, parent)).cast(pa.int64()),
    )
    prefix = _pieces(units, role, 0, low)
    middle = _pieces(units, role, 1, pc.subtract(high, low))
    suffix = _pieces(units, role, 2, pc.subtract(n, high))
    first, second, third = (m.encode() for m in marks)
    psm = pc.binary_join_element_wise(first, prefix, second, suffix, third, middle, b"")
    backward = pc.binary_join_element_wise(second, suffix, first, prefix, third, middle, b"")
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h[2], hundred), rate))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(raw, mark.encode()))
    is_spm = pc.less(_modulo(h[3], hundred), spm)
    form = pc.if_else(plain, "plain", pc.if_else(is_spm, "spm", "psm"))
    output = pc.if_else(plain, raw, pc.if_else(is_spm, backward, psm))

    def chars(piece):
        return pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(piece.cast(pa.string())).cast(pa.int64()))

    return [n, form, chars(prefix), chars(middle), output.cast(pa.string())]


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for k, size in enumerate(sizes):
        if k > at and total + size > most:
            yield at, k - at
            at, total = k, 0
        total += size
    if len(sizes) > at:
        yield at, len(sizes) - at


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), keep: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n units, form, prefix_chars, middle_chars, output.

    rate is the percentage of texts that are rearranged, spm that of these which put the suffix first. With keep,
    there is also `doc`, a struct of docs' own columns.
    """
    h = draws(F.col(id_col), seed)
    own = [F.struct(*docs.columns).alias("doc")] if keep else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *own, F.col(text_col).alias("text"), *[x.alias(f"h{k + 1}") for k, x in enumerate(h)]
    )
    kept = rows.drop("text", "h1", "h2", "h3", "h4").columns

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*kept, *COLUMNS]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for at, count in _slices(sizes, SLICE):
                part = batch.slice(at, count)
                found = rearranged(part.column("text"), [part.column(f"h{k}") for k in (1, 2, 3, 4)], rate, spm, marks)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *found], names=names)

    schema = rows.select(*kept).schema
    for name, kind in COLUMNS.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(transform, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that was rearranged. Rearranged texts hold no mark, so each mark is there once."""
    either = "|".join(rf"\Q{m}\E" for m in marks)
    parts = F.split(output, either, -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    backward = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", backward).otherwise(output)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs' own columns with the rearranged texts."""
    found = fill_in_middle(docs, id_col, text_col, keep=True, **options)
    return found.select(*[(F.col("output") if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    found = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), u AS (
    SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
        CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
        CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM d
), c AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi FROM u
), p AS (
    SELECT *, array_to_string(units[1:lo], '') AS prefix, array_to_string(units[lo + 1:hi], '') AS middle,
        array_to_string(units[hi + 1:n], '') AS suffix,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
