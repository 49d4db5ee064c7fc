"""SimHash near duplicates found with BK-trees.

Fingerprints within RADIUS bits agree in at least one of four 16-bit blocks, so each distinct
fingerprint goes to four shards, one per block value. A task builds a shard's BK-tree - children keyed
by their integer Hamming distance to the parent - and looks each fingerprint up by following only the
edges within the radius. Every tree is bounded: a shard above max_tree fingerprints is dealt anew by
three of six blocks of its remaining bits (again at least three agree), and once more if need be, after
which 12 bits are left and a tree has at most 4096 entries. No link is lost and nothing is capped.

A shard's tree goes to the task that queries it through the shuffle. To broadcast the trees would put
the fingerprints of all documents on the driver.

Only links that connect a shard's classes are written, not all pairs. Classes over shards come from
connected components.

Cases: a null or empty text has fingerprint zero and links like any other. Equal texts share a
fingerprint and are one entry. Null ids are never a class id unless a class has no other; other columns
are ignored. Repeated rows are one document to `deduplicate`, which keeps one row of a class.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import join_rows, staged, text_key
from matchlake.llm.components import components

BITS, BLOCKS, RADIUS = 64, 4, 3
SHINGLE = 3
SEED = 42
# Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the hashes of the word shingles, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(grams), CHUNK):
        part = grams[at : at + CHUNK]
        hashes = np.fromiter((digest(g, SEED) for g in part), np.uint64, len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(2 * counts > len(grams), bitorder="little")
    return int(bits.view(np.int64)[0])


class BKTree:
    """Distinct fingerprints by Hamming distance. A node is [value, {distance: child}]."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add_and_find(self, value: int, radius: int) -> list[int]:
        """Inserts value and returns the earlier values within the radius."""
        if self.root is None:
            self.root = [value, {}]
            return []
        found, stack = [], [self.root]
        while stack:
            node = stack.pop()
            d = (node[0] ^ value).bit_count()
            if d <= radius:
                found.append(node[0])
            children = node[1]
            if len(children) <= 2 * radius:
                stack.extend(child for k, child in children.items() if -radius <= k - d <= radius)
            else:
                stack.extend(children[k] for k in range(d - radius, d + radius + 1) if k in children)
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return found
            node = child


def tree_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links (a, b), a > b, that join the values' classes: each value to the smallest of its class.

    The values are signed 64-bit numbers; the tree counts bits of the unsigned ones.
    """
    tree, parent = BKTree(), {}

    def root(v: int) -> int:
        while parent.get(v, v) != v:
            parent[v] = parent.get(parent[v], parent[v])
            v = parent[v]
        return v

    for value in values:
        for other in tree.add_and_find(value % (1 << 64), radius):
            a, b = root(value), root(other - (1 << 64) if other >> 63 else other)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(v, r) for v in list(parent) if (r := root(v)) != v]


LINK_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _linker(radius: int):
    """Reads rows (shard, fp) sorted by shard; a shard may go on in the next batch."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shard, held = None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            fps = batch.column("fp").to_numpy()
            if not len(shards):
                continue
            cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            out = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if shards[lo] != open_shard:
                    if len(held) > 1:
                        out += tree_links(held, radius)
                    open_shard, held = shards[lo], []
                held += fps[lo:hi].tolist()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=LINK_SCHEMA)
        if len(held) > 1 and (out := tree_links(held, radius)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=LINK_SCHEMA)

    return links


def _pieces(value: Column, width: int, count: int) -> list[Column]:
    return [F.shiftright(value, width * i).bitwiseAND((1 << width) - 1) for i in range(count)]


def _packed(parts: list[Column], width: int) -> Column:
    total = F.lit(0).cast("bigint")
    for k, part in enumerate(parts):
        total = total.bitwiseOR(F.shiftleft(part, width * k))
    return total


def _deal(rows: DataFrame, width: int, count: int, chosen: int) -> DataFrame:
    """Adds to each row's shard every choice of blocks of its remaining bits `rest`."""
    pieces = _pieces(F.col("rest"), width, count)
    options = []
    for n, pick in enumerate(combinations(range(count), chosen)):
        left = [pieces[i] for i in range(count) if i not in pick]
        key = F.xxhash64("shard", F.lit(n), _packed([pieces[i] for i in pick], width))
        options.append(F.struct(key.alias("shard"), _packed(left, width).alias("rest")))
    dealt = rows.select("fp", F.explode(F.array(*options)).alias("x"))
    return dealt.select("x.shard", "fp", "x.rest")


def shards(nodes: DataFrame, max_tree: int) -> DataFrame:
    """(shard, fp) such that fingerprints within RADIUS bits meet in some shard."""
    level = _deal(nodes.select(F.lit(0).cast("bigint").alias("shard"), "fp", F.col("fp").alias("rest")), 16, BLOCKS, 1)
    done = []
    for width in (8, 4):
        full = level.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > max_tree).select("shard")
        full = staged(full, "full-shards")
        done.append(level.join(full, "shard", "left_anti").select("shard", "fp"))
        if full.isEmpty():
            return _union(done)
        level = staged(_deal(level.join(full, "shard"), width, 6, 3), "finer-shards")
    return _union([*done, level.select("shard", "fp")])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) per row, staged."""

    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return staged(
        docs.select(
            F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), fp(F.col(text_col)).alias("fp")
        ),
        "fingerprints",
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_tree: int = 1024
) -> DataFrame:
    """One row per document: doc_id, text_key, fp, root (a fingerprint naming its class), component_id
    (the smallest id of its class)."""
    prints = fingerprints(docs, id_col, text_col, shingle)
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    spark = docs.sparkSession
    spread = shards(nodes, max_tree)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_shards = spread.repartition(count, "shard").sortWithinPartitions("shard")
    links = sorted_shards.mapInArrow(_linker(RADIUS), "a bigint, b bigint")
    roots = components(links)
    rooted = staged(
        nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    ids = staged(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "class-ids")
    classes = staged(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, that with the smallest id, in docs' own columns."""
    found = near_duplicates(docs, id_col, text_col, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    kept = staged(found.groupBy("root").agg(first).select("first.doc_id", "first.text_key").distinct(), "kept")
    packed = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("text_key"),
    )
    rows = join_rows(packed, kept, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir):
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
