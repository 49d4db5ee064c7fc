"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities.

Documents of an old shard fall into hashed blocks, whose bytes are summed in one aggregate. The flow
network has the old shards as sources and the new shards as sinks; bytes that stay in their shard cost
nothing, bytes that move cost one each. The flows are then filled with blocks, largest first, and what a
block over- or underfills is carried to the next old shard. Affected shards are rewritten, several files
a shard, and a document's slot is its place in its shard's files.

The driver holds one number per (old shard, block), at most old shards x blocks, whatever the data.

Cases: a null or empty text has no bytes and counts ROW_BYTES. Null ids hash with their text. Repeated
rows share a block and move together. An empty table gives empty shards. Other columns are kept in the
shard files; the digest rows do not need them.
"""

from collections import deque

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import scratch, staged, text_key

ROW_BYTES = 8
OLD_SHARDS, NEW_SHARDS, BLOCKS = 16, 24, 2048
# Text bytes a rewritten file should hold.
FILE_BYTES = 256 << 20


def minimum_cost_flow(supply: list[int], demand: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, at the least total moved. sum(supply) == sum(demand).

    Successive shortest paths on the bipartite network: a residual path is found over (free) stays and
    (costly) moves, and carries as much as its tightest edge allows.
    """
    n, m = len(supply), len(demand)
    flow = np.zeros((n, m), np.int64)
    for i in range(min(n, m)):
        flow[i, i] = min(supply[i], demand[i])
    cost = np.ones((n, m), np.int64)
    for i in range(min(n, m)):
        cost[i, i] = 0
    left = np.array(supply, np.int64) - flow.sum(1)
    room = np.array(demand, np.int64) - flow.sum(0)
    while left.any():
        # Cheapest path from any old shard with bytes left to any new shard with room.
        far = np.iinfo(np.int64).max // 4
        at_old, at_new = np.where(left > 0, 0, far), np.full(m, far)
        from_new, from_old = np.full(n, -1), np.full(m, -1)
        queue = deque(np.flatnonzero(left > 0).tolist())
        while queue:
            i = queue.popleft()
            for j in np.flatnonzero(at_old[i] + cost[i] < at_new).tolist():
                at_new[j], from_old[j] = at_old[i] + cost[i, j], i
                back = at_new[j] - cost[:, j]
                for k in np.flatnonzero((flow[:, j] > 0) & (back < at_old)).tolist():
                    at_old[k], from_new[k] = back[k], j
                    if k not in queue:
                        queue.append(k)
        end = min(np.flatnonzero(room > 0).tolist(), key=lambda j: (at_new[j], j))
        path, j, most = [], end, int(room[end])
        while True:
            i = int(from_old[j])
            path.append((i, j, 1))
            if from_new[i] < 0:
                most = min(most, int(left[i]))
                break
            j = int(from_new[i])
            path.append((i, j, -1))
            most = min(most, int(flow[i, j]))
        for i, j, sign in path:
            flow[i, j] += sign * most
        left[path[-1][0]] -= most
        room[end] -= most
    return {(int(i), int(j)): int(flow[i, j]) for i, j in zip(*np.nonzero(flow), strict=True)}


def even(total: int, parts: int) -> list[int]:
    return [total * (k + 1) // parts - total * k // parts for k in range(parts)]


def fill_flows(blocks: list[tuple[int, int, int]], flows: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """(old, block, bytes) rows to (old, block, shard): each block to the destination of its old shard
    that lacks most."""
    by_old: dict[int, list] = {}
    for old, block, size in blocks:
        by_old.setdefault(old, []).append((-size, block))
    carry: dict[int, int] = {}
    out = []
    for old in sorted(by_old):
        want = {j: f + carry.pop(j, 0) for (i, j), f in sorted(flows.items()) if i == old}
        for size, block in sorted(by_old[old]):
            j = max(want, key=lambda k: (want[k], -abs(k - old), -k))
            want[j] += size
            out.append((old, block, j))
        for j, rest in want.items():
            carry[j] = carry.get(j, 0) + rest
    return out


def doc_bytes(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + ROW_BYTES).cast("bigint")


def old_and_block(id_col: Column, text: Column, old_shards: int, blocks: int) -> tuple[Column, Column]:
    """The layout before: shards by hash of the document; and the document's block."""
    mark = F.xxhash64(id_col, text_key(text))
    old = F.pmod(mark, F.lit(old_shards)).cast("int")
    return old, F.pmod(F.shiftrightunsigned(mark, 20), F.lit(blocks)).cast("int")


def plan(docs: DataFrame, id_col="doc_id", text_col="text", new_shards=NEW_SHARDS, old_shards=OLD_SHARDS, blocks=BLOCKS):
    """(old, block, shard) for all blocks with documents, as a list."""
    old, block = old_and_block(F.col(id_col), F.col(text_col), old_shards, blocks)
    sums = docs.select(old.alias("old"), block.alias("block"), doc_bytes(F.col(text_col)).alias("size"))
    rows = [tuple(r) for r in sums.groupBy("old", "block").agg(F.sum("size").alias("size")).collect()]
    supply = [0] * old_shards
    for old_shard, _, size in rows:
        supply[old_shard] += size
    return fill_flows(rows, minimum_cost_flow(supply, even(sum(supply), new_shards)))


def affected(moves: list[tuple[int, int, int]], old_shards: int) -> set[int]:
    """Old and new shards that a block leaves or enters, and shards that did not exist."""
    changed = {s for old, _, shard in moves if old != shard for s in (old, shard)}
    return changed | {shard for _, _, shard in moves if shard >= old_shards}


def rewrite(
    docs: DataFrame, moves, path: str, shards=None, id_col="doc_id", text_col="text", old_shards=OLD_SHARDS, blocks=BLOCKS,
    file_bytes: int = FILE_BYTES, total_bytes: int | None = None,
) -> None:
    """Writes the documents of `shards` (all by default) to path/_shard=N, in docs' own columns.

    Shards are cut into pieces of about file_bytes by block, so that no task writes a whole shard.
    """
    spark = docs.sparkSession
    layout = spark.createDataFrame(moves, "_old int, _block int, _shard int")
    old, block = old_and_block(F.col(id_col), F.col(text_col), old_shards, blocks)
    if total_bytes is None:
        total_bytes = docs.agg(F.sum(doc_bytes(F.col(text_col)))).first()[0] or 0
    count = len({shard for _, _, shard in moves}) or 1
    pieces = max(1, min(blocks, round(total_bytes / count / file_bytes)))
    # The layout has at most old_shards x blocks rows of 12 bytes.
    placed = docs.withColumns({"_old": old, "_block": block}).join(F.broadcast(layout), ["_old", "_block"])
    if shards is not None:
        placed = placed.where(F.col("_shard").isin(*shards))
    target = (F.col("_shard") * pieces + F.pmod("_block", F.lit(pieces))).cast("int")
    dealt = placed.withColumn("_piece", target).repartition(count * pieces, "_piece")
    dealt.drop("_old", "_block", "_piece").write.option("compression", "zstd").partitionBy("_shard").parquet(path)


def slots(written: DataFrame) -> DataFrame:
    """Adds slot, the row's place in its shard: rows of the shard's earlier files, and those before it."""
    rows = written.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    files = rows.groupBy("_shard", "_file").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_shard", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = staged(starts.drop("_shard"), "file-starts")
    return rows.join(starts, "_file").withColumn("slot", F.col("_start") + F.col("_row")).drop("_start", "_row", "_file")


def reshard(docs: DataFrame, id_col="doc_id", text_col="text", new_shards=NEW_SHARDS, path: str | None = None) -> DataFrame:
    """Plans, rewrites, and reads the new files: one digest row per document, from the files.

    The files hold docs' own columns and stay at path, by default a new folder `shards-...` of the shared
    one, which is among the frame's inputFiles().
    """
    moves = plan(docs, id_col, text_col, new_shards)
    path = path or scratch(docs.sparkSession, "shards")
    rewrite(docs, moves, path, id_col=id_col, text_col=text_col)
    schema = docs.select(id_col, text_col).schema.add("_shard", "integer")
    written = docs.sparkSession.read.schema(schema).parquet(path)
    written = written.withColumnsRenamed({id_col: "doc_id", text_col: "text"})
    text = F.coalesce("text", F.lit(""))
    return slots(written).select(
        "doc_id",
        doc_bytes(F.col("text")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark, sf_dir):
    return reshard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
