"""N-gram Jaccard join over a token-group matrix: documents whose sets of five-word shingles are similar.

A document's set holds the 64-bit hashes of its distinct shingles; equal sets are one node. Two sets a, b link
when 9 * common >= 4 * (a + b), which is a Jaccard similarity of 0.8. All links between components are found:

1. Screens. A set with a partner shares most of its tokens. First the lowest quarter of each set's tokens, in
   hash order, is counted by how many of them another set has among its own lowest quarter; then all tokens
   of the sets left. Tasks send a token once, however many of their sets hold it. Sets without enough shared
   tokens have no partner and are done.
2. Groups. Sets meet in buckets by each of ROUNDS minima of seeded hashes. Every member of a bucket is verified
   against the bucket's head, the set with the largest share of shared tokens, which is near the middle of
   a group of copies. Verified links make cores: groups that are one component. Each other set joins the
   fullest of its buckets, so that similar sets without a link lie together.
3. Matrix. (group, token, members that hold it): the union of each group's tokens. Tokens are ordered by
   the number of groups that hold them, rarest first. A set can link with a member of a group only if a token
   of its prefix in that order is in a member's prefix; such pairs of set and group are candidates.
4. Bound. The matrix gives how many of the set's tokens lie in the union of the group's other members; below the
   overlap that the smallest partner in the group needs, no member can link. Only groups that reach the
   bound are opened, and their members verified one by one.

Pairs inside a core, and from the larger of two cores, are not looked for: they would link nothing anew. Work
grows with sets times groups near them, never with the square of a group of copies; no bucket is capped. Any
number of sets may meet in a bucket or group, since buckets are joined with heads or aggregated, never collected.

Cases: a text of fewer than five words has one shingle, its words; null and empty texts, and those without words,
have an empty set and are their own class. Rows with equal ids or texts are judged alike. A null id is a class's
id only where the class has no other. Ids may be of any ordered type. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

from matchlake.llm.common import staged, text_key
from matchlake.llm.components import components

SHINGLE = 5
ROUNDS = 4
SEED = 42
# Postings that a task gathers before it sends them, that a bucket of tokens should hold, and those it may hold
# where there are four buckets a partition already.
FLUSH, BUCKET, MOST_IN_BUCKET = 1 << 20, 1 << 18, 1 << 21
# A filter of text keys has FILTER_BITS a key, and MOST_BITS (16 MB) in all.
FILTER_BITS, MOST_BITS = 32, 1 << 27
_MIX = np.random.default_rng(SEED).integers(0, 1 << 63, SHINGLE + ROUNDS, np.uint64) * np.uint64(2) + np.uint64(1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def tokens(text: str | None) -> np.ndarray:
    """Distinct shingle hashes in ascending order, as signed numbers."""
    words = (text or "").encode().lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        found = [digest(b" ".join(words), SEED + len(words))] if words else []
        return np.array(found, np.uint64).view(np.int64)
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    total = hashes[: len(hashes) - SHINGLE + 1] * _MIX[0]
    for k in range(1, SHINGLE):
        # Each word is mixed with its place, so that the sum tells orders apart.
        total = _scramble(total) + hashes[k : len(hashes) - SHINGLE + 1 + k] * _MIX[k]
    return np.unique(_scramble(total).view(np.int64))


def least_common(n: int | Column):
    """Tokens that a set of n must share with any partner."""
    return F.floor((4 * n + 4) / 5) if isinstance(n, Column) else (4 * n + 4) // 5


def probe_size(n: int) -> int:
    """Lowest tokens of a set that the first screen counts: any two similar sets share `probe_least` of them."""
    return min(n, n - least_common(n) + 1 + n // 20)


def probe_least(n: Column) -> Column:
    """A partner has at least least_common(n) tokens, so its probe holds that much more than a plain prefix."""
    return 1 + F.floor(least_common(n) / 20)


# --- screens ------------------------------------------------------------------------------------------------

POSTINGS = "bucket bigint, tokens binary, sets binary"
NONE = 0


def _distinct(tok: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (token, set) rows by token, and whether the next row has the same token."""
    order = np.lexsort((own, tok))
    tok, own = tok[order], own[order]
    fresh = np.append(True, (tok[1:] != tok[:-1]) | (own[1:] != own[:-1]))
    tok, own = tok[fresh], own[fresh]
    return tok, own, tok[1:] == tok[:-1]


def _bundle(tok: np.ndarray, own: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Postings packed by bucket of tokens."""
    bucket = (tok.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)), len(order))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        mine = order[lo:hi]
        yield int(bucket[mine[0]]), tok[mine].tobytes(), own[mine].tobytes()


def _sender(buckets: int, least):
    """Reads (set, tokens) and sends (token, set) postings. Sets that share a token inside a task are counted there
    (bucket -1: set, hits); of these the token is sent on once, without a set, so that others hear of it."""

    def send(tok: np.ndarray, own: np.ndarray):
        tok, own, same = _distinct(tok, own)
        twice = np.append(False, same) | np.append(same, False)
        out = []
        if twice.any():
            sets, hits = np.unique(own[twice], return_counts=True)
            out.append((-1, sets.tobytes(), hits.astype(np.int64).tobytes()))
            first = twice & np.append(True, ~same)
            tok = np.concatenate([tok[~twice], tok[first]])
            own = np.concatenate([own[~twice], np.full(int(first.sum()), NONE)])
        if len(tok):
            out += _bundle(tok, own, buckets)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for tok, key in _sets(batch, least):
                held.append((tok, key))
                size += len(tok)
                if size >= FLUSH:
                    yield from _batches(send(*_flat(held)))
                    held, size = [], 0
        if held:
            yield from _batches(send(*_flat(held)))

    return run


def _flat(held):
    own = np.repeat(np.array([key for _, key in held], np.int64), [len(tok) for tok, _ in held])
    return np.concatenate([tok for tok, _ in held]), own


def _batches(rows, most: int = 1 << 26):
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += len(row[1]) + len(row[2])
        if size >= most:
            yield _batch(part)
            part, size = [], 0
    if part:
        yield _batch(part)


def _batch(rows):
    kinds = (pa.int64(), pa.binary(), pa.binary())
    columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "tokens", "sets"])


def _sets(batch: pa.RecordBatch, least) -> Iterator[tuple[np.ndarray, int]]:
    """(tokens to count, set) of a batch of texts, or of stored token arrays."""
    if least == "probe":
        for text in batch.column("text"):
            tok = tokens(text.as_py())
            if len(tok):
                yield tok[: probe_size(len(tok))], set_key(tok)
    else:
        keys = batch.column("set_key").to_pylist()
        for key, tok in zip(keys, arrays(batch.column("tokens")), strict=True):
            yield tok, key


def arrays(column) -> Iterator[np.ndarray]:
    """Rows of a list column as arrays."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths())])
    for lo, hi in zip(ends, ends[1:], strict=False):
        yield flat[lo:hi]


def set_key(tok: np.ndarray) -> int:
    """64 bits of a set's name for the screens, where sets that collide only count too much; never NONE."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tok.tobytes(), SEED) | 1).view(np.int64))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, tokens, sets) of rows sorted by bucket; rows of a bucket below zero stay apart."""
    here, held = None, []

    def joined():
        return here, *(np.concatenate([np.frombuffer(r[k], np.int64) for r in held]) for k in (0, 1))

    for batch in batches:
        for bucket, tok, own in zip(*(batch.column(c).to_pylist() for c in ("bucket", "tokens", "sets")), strict=True):
            if held and (bucket != here or here < 0):
                yield joined()
                held = []
            here = bucket
            held.append((tok, own))
    if held:
        yield joined()


def _counter(buckets: int):
    """Postings sorted by bucket of tokens, to (set, hits) of the tokens that more than one set holds, packed by bucket
    of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for here, tok, own in _by_bucket(batches):
            if here < 0:
                sets, hits = tok, own
            else:
                tok, own, same = _distinct(tok, own)
                # NONE stands for sets that were counted where they were found; a token of its kind is shared already.
                shared = (np.append(False, same) | np.append(same, False)) & (own != NONE)
                sets, hits = np.unique(own[shared], return_counts=True)
            if len(sets):
                yield from _batches(_bundle(sets, hits.astype(np.int64), buckets))

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed (set, hits) sorted by bucket of sets, to one row per set."""
    for _, sets, hits in _by_bucket(batches):
        names, place = np.unique(sets, return_inverse=True)
        total = np.zeros(len(names), np.int64)
        np.add.at(total, place, hits)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], names=["set_key", "hits"])


def shared_counts(rows: DataFrame, total: int, least) -> DataFrame:
    """(set_key, hits): how many of a set's counted tokens another set has too. total: tokens, about."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, total // MOST_IN_BUCKET, min(total // BUCKET, 4 * parts))
    sent = rows.mapInArrow(_sender(buckets, least), POSTINGS)
    # What tasks have counted themselves needs no meeting; it is dealt anywhere.
    deal = F.when(F.col("bucket") < 0, F.xxhash64("tokens")).otherwise(F.col("bucket"))
    sent = sent.withColumn("deal", deal).repartition(max(parts, buckets // 8), "deal").sortWithinPartitions("bucket")
    packed = sent.select("bucket", "tokens", "sets").mapInArrow(_counter(max(parts, buckets // 8)), POSTINGS)
    return packed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_summed, "set_key bigint, hits bigint")


# --- sets ---------------------------------------------------------------------------------------------------

KEYED = StructType().add("node", StringType()).add("set_key", LongType()).add("n", LongType())


@F.pandas_udf(KEYED)
def keyed(texts: pd.Series) -> pd.DataFrame:
    out = []
    for text in texts:
        tok = tokens(text)
        out.append((xxhash.xxh3_128_hexdigest(tok.tobytes(), SEED), set_key(tok), len(tok)) if len(tok) else (None, 0, 0))
    return pd.DataFrame(out, columns=["node", "set_key", "n"])


@F.pandas_udf(ArrayType(LongType()))
def token_array(texts: pd.Series) -> pd.Series:
    return pd.Series([tokens(t) for t in texts])


@F.pandas_udf(ArrayType(LongType()))
def minima(column: pd.Series) -> pd.Series:
    """The smallest hash of a set by each seed."""
    return pd.Series([[int(_scramble(t.view(np.uint64) * m).min().view(np.int64)) for m in _MIX[SHINGLE:]] for t in column])


@F.pandas_udf(BooleanType())
def similar(left: pd.Series, right: pd.Series) -> pd.Series:
    out = []
    for a, b in zip(left, right, strict=True):
        both = np.concatenate([a, b])
        both.sort()
        out.append(9 * int((both[1:] == both[:-1]).sum()) >= 4 * len(both))
    return pd.Series(out, dtype=bool)


def key_filter(spark, keys: DataFrame, count: int):
    """A column function that lets through all of `keys`' numbers and few others: a bitmap of bounded size."""
    bits = min(MOST_BITS, max(1 << 15, 1 << (FILTER_BITS * max(count, 1)).bit_length()))
    place = F.pmod(F.xxhash64("text_key"), F.lit(bits))
    # Spark's bitmaps start at 1.
    rows = keys.select((place + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
    rows = rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    table = bytearray(bits >> 3)
    for bucket, part in rows:
        table[(bucket - 1) << 12 : bucket << 12] = part
    shared = spark.sparkContext.broadcast(bytes(table))

    @F.pandas_udf(BooleanType())
    def there(at: pd.Series) -> pd.Series:
        at, held = at.to_numpy(), np.frombuffer(shared.value, np.uint8)
        return pd.Series((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return there(place)


def _screened(sets: DataFrame, counts: DataFrame, least: Column) -> DataFrame:
    return sets.join(counts, "set_key").where(F.col("hits") >= least)


def candidate_sets(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Staged (sid, node, n, tokens, hits, mins) of the sets that may have a partner."""
    spark = docs.sparkSession
    texts = docs.select("text")
    total = rows.agg(F.sum("n")).first()[0] or 0
    counts = staged(shared_counts(texts, total // 4, "probe"), "shared-probes")
    # A set under four tokens is similar to equal sets only; one of four also to those of five that hold it.
    sets = rows.where("n >= 4").groupBy("node").agg(
        F.first("set_key").alias("set_key"), F.first("n").alias("n"), F.min("text_key").alias("text_key")
    )
    first = staged(_screened(sets, counts, probe_least(F.col("n"))), "screened-sets")
    there = key_filter(spark, first, first.count())
    mine = docs.select(text_key(F.col("text")).alias("text_key"), "text").where(there)
    # Equal texts are one row before their tokens are made.
    mine = mine.groupBy("text_key").agg(F.min("text").alias("text"))
    held = first.drop("hits").join(mine, "text_key").select("node", "set_key", "n", token_array("text").alias("tokens"))
    held = staged(held, "screened-tokens")
    total = held.agg(F.sum("n")).first()[0] or 0
    counts = staged(shared_counts(held.select("set_key", "tokens"), total, "all"), "shared-tokens")
    left = _screened(held, counts, least_common(F.col("n")))
    left = left.select(F.monotonically_increasing_id().alias("sid"), "node", "n", "tokens", "hits", minima("tokens").alias("mins"))
    return staged(left, "candidate-sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Staged (a, b), a > b, of the pairs (a, b) that are similar."""
    tok = sets.select("sid", "tokens")
    both = pairs.join(tok.toDF("a", "left"), "a").join(tok.toDF("b", "right"), "b")
    both = both.where(similar("left", "right"))
    return staged(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "verified-links")


def _fits(a: Column, b: Column) -> Column:
    """Whether sets of a and b tokens can be similar at all."""
    return (5 * a >= 4 * b) & (5 * b >= 4 * a)


def grouped(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with the buckets' heads, and staged (sid, n, grp, core, root, size) of each set's group."""
    keys = sets.select("sid", "n", (F.col("hits") / F.col("n")).alias("share"), F.posexplode("mins").alias("turn", "low"))
    keys = keys.select("sid", "n", "share", F.xxhash64("turn", "low").alias("bucket"))
    head = F.max(F.struct("share", "n", "sid")).alias("head")
    buckets = staged(keys.groupBy("bucket").agg(F.count("*").alias("members"), head), "set-buckets")
    met = staged(keys.join(buckets.where("members > 1"), "bucket"), "bucket-members")
    pairs = met.where((F.col("sid") != F.col("head.sid")) & _fits(F.col("n"), F.col("head.n")))
    links = verified(pairs.select(F.col("sid").alias("a"), F.col("head.sid").alias("b")).distinct(), sets)
    roots = components(links).toDF("sid", "root")
    fullest = met.groupBy("sid").agg(F.max(F.struct("members", "bucket"))["bucket"].alias("bucket"))
    plain = sets.select("sid", "n").join(roots, "sid", "left").join(fullest, "sid", "left")
    plain = plain.withColumn("root", F.coalesce("root", "sid"))
    sizes = plain.groupBy("root").agg(F.count("*").alias("size"))
    plain = plain.join(sizes, "root")
    core = F.col("size") > 1
    grp = F.when(core, F.xxhash64(F.lit("core"), "root")).otherwise(F.xxhash64(F.lit("loose"), F.coalesce("bucket", "sid")))
    return links, staged(plain.select("sid", "n", grp.alias("grp"), core.alias("core"), "root", "size"), "set-groups")


def group_links(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) of sets with members of the groups that reach the bound."""
    ranges = groups.groupBy("grp").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.first("core").alias("of_core"), F.max("size").alias("of_size")
    )
    ranges = staged(ranges, "group-ranges")
    placed = groups.select("sid", "n", "grp", "core", "size").join(sets.select("sid", "tokens"), "sid")
    cells = placed.select("grp", F.explode("tokens").alias("token")).groupBy("grp", "token").agg(F.count("*").alias("held"))
    matrix = staged(cells, "token-groups")
    # Only tokens of several groups, or of several members of a loose one, can be part of a new link.
    spread = matrix.groupBy("token").agg(F.count("*").alias("groups"), F.max("held").alias("most"))
    spread = staged(spread.where("groups > 1 or most > 1"), "token-spread")
    known = matrix.join(spread, "token").join(ranges.select("grp", "low", "of_core"), "grp")
    useful = known.where((F.col("groups") > 1) | (~F.col("of_core") & (F.col("held") > 1)))
    useful = useful.withColumn("useful", F.lit(True))
    enough = useful.groupBy("grp").agg(F.count("*").alias("tokens"), F.first("low").alias("low"))
    enough = staged(enough.where(F.col("tokens") >= least_common(F.col("low"))).select("grp"), "live-groups")
    useful = staged(useful.join(enough, "grp").select("grp", "token", "held", "groups"), "live-cells")
    rows = placed.join(enough, "grp").select("sid", "n", "grp", "core", "size", F.explode("tokens").alias("token"))
    rows = rows.join(useful, ["grp", "token"])
    order = F.sort_array(F.collect_list(F.struct("groups", "token"))).alias("ranked")
    rows = rows.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n", "grp", "core", "size")], order)
    rows = rows.where(F.size("ranked") >= least_common(F.col("n")))
    # The tokens that no other group has come first in the order.
    short = (F.col("n") - least_common(F.col("n")) + 1 - (F.col("n") - F.size("ranked"))).cast("int")
    rows = rows.withColumn("prefix", F.slice("ranked.token", F.lit(1), F.greatest(short, F.lit(0))))
    rows = staged(rows.withColumn("ranked", F.col("ranked.token")), "ranked-sets")

    starts = rows.select("grp", F.explode("prefix").alias("token")).distinct().join(ranges, "grp")
    starts = starts.select("token", F.col("grp").alias("to"), "low", "high", "of_core", "of_size")
    asked = rows.select("sid", "n", "grp", "core", "size", F.explode("prefix").alias("token"))
    # Of two cores the smaller one asks; a core does not ask loose sets, which ask it.
    larger = (F.col("of_size") > F.col("size")) | ((F.col("of_size") == F.col("size")) & (F.col("to") > F.col("grp")))
    asks = F.when(F.col("core"), F.col("of_core") & larger & (F.col("to") != F.col("grp"))).otherwise(F.lit(True))
    reach = (5 * F.col("high") >= 4 * F.col("n")) & (4 * F.col("low") <= 5 * F.col("n"))
    met = asked.join(starts, "token").where(asks & reach).select("sid", "n", "grp", "to", "low").distinct()
    met = staged(met, "set-group-candidates")

    mine = rows.select("sid", F.explode("ranked").alias("token"))
    hit = met.join(mine, "sid").join(useful.select(F.col("grp").alias("to"), "token", "held"), ["to", "token"])
    other = F.col("held") > F.when(F.col("to") == F.col("grp"), 1).otherwise(0)
    smallest = F.greatest(F.col("low"), least_common(F.col("n")))
    need = ((4 * (F.col("n") + smallest) + 8) / 9).cast("bigint")
    bound = hit.groupBy("sid", "to").agg(F.sum(other.cast("int")).alias("common"), F.first(need).alias("need"))
    opened = staged(bound.where("common >= need").select("sid", "to"), "opened-groups")

    members = groups.select(F.col("grp").alias("to"), F.col("sid").alias("b"), F.col("n").alias("of_n"), F.col("root").alias("of_root"))
    asking = opened.join(groups.select("sid", "n", "root"), "sid")
    pairs = asking.join(members, "to").where(_fits(F.col("n"), F.col("of_n")) & (F.col("root") != F.col("of_root")))
    pairs = pairs.select(F.greatest("sid", "b").alias("a"), F.least("sid", "b").alias("b")).distinct()
    return verified(staged(pairs, "opened-pairs"), sets)


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, node (a name of its set; null if empty), component_id."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    named = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), keyed("text").alias("k"))
    rows = staged(named.select("doc_id", "text_key", "k.node", "k.set_key", "k.n"), "keyed-sets")
    sets = candidate_sets(docs, rows)
    links, groups = grouped(sets)
    links = links.union(group_links(sets, groups))
    roots = components(links).toDF("sid", "root")
    linked = roots.unionByName(roots.select(F.col("root").alias("sid"), "root").distinct())
    nodes = staged(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id")), "set-nodes")
    linked = staged(sets.select("sid", "node").join(linked, "sid").join(nodes, "node"), "linked-sets")
    classes = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(linked.join(classes, "root").select("node", "component_id"), "set-classes")
    classes = staged(
        nodes.join(classes, "node", "left").select("node", F.coalesce("component_id", "first_id").alias("component_id")),
        "node-classes",
    )
    named = rows.select("doc_id", "node", F.col("n").alias("n_shingles")).join(classes, "node", "left")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "n_shingles", "node", alone.alias("component_id"))


def query(spark, sf_dir):
    return similar_sets(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
