"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters. Words and word beginnings are counted over a bounded sample of labelled documents; those that
lean to a class beyond chance are put into lexicons by kind and rank. All documents of the sample count; near copies
(equal smallest hashes, and 0.8 of their runs of three words shared with the first of them) share the weight of one
document. A lexicon votes for its class where a text holds one of its entries and abstains elsewhere; one voter speaks against where no toxic entry occurs;
pattern voters look at shouting, repeated marks and sentences aimed at the reader.

Label model. The voters' votes are explained by a hidden class: expectation-maximisation estimates, for each
voter, how often it votes what in either class. Voters whose votes still agree or disagree given the
class are correlated; they are put into one factor with a joint table, and the model is fitted again. So
ten lexicons that say the same do not count as ten witnesses.

Classifier. A logistic regression on the entries a text holds learns the model's posterior labels, not the
labels themselves. It scores every whole text in one pass without a shuffle.

Bounds: SAMPLE documents of label 0 and 1, MAX_ENTRIES entries. Labels with null ids, or with two values for
an id, are left out.

Cases: null and empty texts hold no entry and get the score of that. Without labels of both classes the
score is the share of label 1 (0 if there is none). Repeated rows score alike; other columns are ignored.
"""

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from matchlake.llm.common import staged
from matchlake.llm.labels import labelled_sample, remainder, sigmoid

PARTS, HELD_OUT, THRESHOLD = 4, 2, 0.3
SAMPLE = (6000, 3000)
# Share of common runs from which documents are near copies.
SAME = 0.8
MAX_ENTRIES, MIN_DOCS = 4000, 3
# Votes of one side that a factor tells apart.
MOST_VOTES = 4
BEGINNINGS = (3, 4, 5, 6)
TOXIC_LEAN = 2.5
# Marks of a text: name, least number and share of its words that hold a toxic entry.
MARKS = (("#2", 2, 0.0), ("#3", 3, 0.0), ("#2%", 1, 0.02), ("#4%", 1, 0.04))
LEXICONS = 3
# Correlation of votes from which voters share a factor: overall, and within the classes.
COPIED, CORRELATED = 0.8, 0.25
EDGE = re.compile(r"^\W+|\W+$")
PATTERNS = (
    re.compile(r"(?:\b[A-Z]{3,}\b\W+){3}"),
    re.compile(r"[!?]{2,}"),
    re.compile(r"\b(?:you|your|du|dein|tu|ton|tus|usted)\b[^.!?]{0,40}[!]", re.IGNORECASE),
)


def entries(text: str | None) -> set[str]:
    """Words of a text, lower-cased and without marks at their ends, and their beginnings (`ab-`)."""
    words = {EDGE.sub("", w) for w in set((text or "").lower().split())}
    words.discard("")
    found = set(words)
    for n in BEGINNINGS:
        found.update(w[:n] + "-" for w in words if len(w) > n)
    return found


@F.pandas_udf(ArrayType(StringType()))
def entries_of(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted(entries(t)) for t in texts])


@F.pandas_udf(ArrayType(IntegerType()))
def pattern_hits(texts: pd.Series) -> pd.Series:
    return pd.Series([[int(p.search(t) is not None) for p in PATTERNS] for t in texts])


@F.pandas_udf(ArrayType(LongType()))
def runs(texts: pd.Series) -> pd.Series:
    """Distinct hashes of a text's runs of three words; of all its words where there are fewer."""

    def of(text: str) -> list[int]:
        words = text.lower().split()
        found = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        return [xxhash.xxh3_64_intdigest(r) >> 1 for r in found]

    return pd.Series([of(t) for t in texts])


def weighted(sample: DataFrame) -> DataFrame:
    """The sample with a weight per document: one over the number of its near copies, itself included.

    Documents are compared with the first one that has the same smallest hash under four hash functions; one that
    shares less than SAME of the runs with it counts as a document of its own.
    """
    smallest = F.array(*[F.array_min(F.transform("runs", lambda h, k=k: F.xxhash64(h, F.lit(k)))) for k in range(4)])
    marked = staged(sample.withColumn("runs", runs("text")).withColumn("marks", smallest), "sample-runs")
    first = marked.groupBy("marks").agg(F.min_by("runs", "doc_id").alias("first_runs"), F.min("doc_id").alias("first"))
    both = F.size(F.array_intersect("runs", "first_runs"))
    near = both >= SAME * (F.size("runs") + F.size("first_runs") - both)
    owned = marked.join(first, "marks").withColumn("group", F.when(near, F.col("first")).otherwise(F.col("doc_id")))
    share = 1 / F.count("*").over(Window.partitionBy("group"))
    return staged(owned.select("doc_id", "label", "text", share.alias("weight")), "weighted-sample")


def lexicon(sample: DataFrame, shares: dict[int, float]) -> pd.DataFrame:
    """The MAX_ENTRIES entries that separate the classes best: entry, documents by class, lean."""
    # Weights in whole millionths, so that sums do not depend on their order.
    seen = sample.select("label", F.round(F.col("weight") * 1e6).cast("long").alias("w"), F.explode(entries_of("text")).alias("entry"))
    of = {f"n{k}": F.sum(F.when(F.col("label") == k, F.col("w")).otherwise(0)) / 1e6 for k in (0, 1)}
    counts = seen.groupBy("entry").agg(*[value.alias(name) for name, value in of.items()])
    # Log-likelihood ratio of the entry's counts against the classes' shares of the sample.
    n0, n1, p1 = F.col("n0"), F.col("n1"), shares[1] / (shares[0] + shares[1])
    n = n0 + n1
    part = F.when(n1 > 0, n1 * F.log(n1 / (n * p1))).otherwise(0.0)
    part = part + F.when(n0 > 0, n0 * F.log(n0 / (n * (1 - p1)))).otherwise(0.0)
    lean = F.log((n1 + 0.5) / (shares[1] + 1.0) / ((n0 + 0.5) / (shares[0] + 1.0)))
    ranked = counts.where(n >= MIN_DOCS - 1e-3).withColumns({"evidence": 2 * part, "lean": lean})
    # Among so many entries chance gives about one with more evidence than this.
    least = 2 * np.log(max(ranked.count(), 2))
    return ranked.where(F.col("evidence") >= least).orderBy(F.desc("evidence"), "entry").limit(MAX_ENTRIES).toPandas()


def voters(words: pd.DataFrame) -> list[tuple[int, set[int]]]:
    """(class, entries) of each lexicon: entries by class, kind and turn in rank."""
    kind = words["entry"].map(lambda e: len(e) if e.endswith("-") else 0)
    out = []
    for value, sign in ((1, 1.0), (0, -1.0)):
        # Toxic entries must be near certain; ordinary words lean much less.
        strong = sign * words["lean"] > (TOXIC_LEAN if value else 0.0)
        for k in sorted(set(kind)):
            mine = words.index[strong & (kind == k)].tolist()
            out += [(value, set(mine[n::LEXICONS])) for n in range(LEXICONS) if mine[n::LEXICONS]]
    return out


def votes(held: list[set[int]], hits: np.ndarray, lexicons: list[tuple[int, set[int]]]) -> np.ndarray:
    """Votes per document and voter: 0 abstains, 1 against, 2 for."""
    toxic = set().union(*[words for value, words in lexicons if value], set())
    table = [[(value + 1) * bool(words & have) for value, words in lexicons] for have in held]
    table = np.array(table, np.int64).reshape(len(held), len(lexicons))
    clean = np.array([[int(not (toxic & have))] for have in held], np.int64)
    return np.concatenate([table, clean, 2 * hits], axis=1)


class LabelModel:
    """Hidden class and factors of voters; a factor has a table, for either class, of how many of its
    voters vote for and how many against."""

    def __init__(self, prior: float):
        self.prior = prior

    def fit(self, v: np.ndarray, weight: np.ndarray | None = None, rounds: int = 30) -> np.ndarray:
        """Posterior of the class. Voters that nearly copy each other have one voice from the start; those
        still correlated within the classes are joined after the first fit."""
        self.weight = np.ones(len(v)) if weight is None else weight
        groups = self.correlated(v, [self.weight], COPIED)
        voice = np.zeros(len(v))
        for group in groups:
            for_, against = ((v[:, group] == value).sum(1) for value in (2, 1))
            voice += (for_ - against) / np.maximum(for_ + against, 1)
        post = self._em(v, groups, sigmoid(voice), rounds)
        return self._em(v, self.correlated(v, [self.weight * post, self.weight * (1 - post)], CORRELATED, groups), post, rounds)

    def _em(self, v: np.ndarray, groups: list[list[int]], post: np.ndarray, rounds: int) -> np.ndarray:
        joint = []
        for group in groups:
            for_, against = ((v[:, group] == value).sum(1) for value in (2, 1))
            joint.append(np.minimum(for_, MOST_VOTES) * (MOST_VOTES + 1) + np.minimum(against, MOST_VOTES))
        for _ in range(rounds):
            logit = np.full(len(v), np.log(self.prior / (1 - self.prior)))
            self.tables = []
            for code in joint:
                n = (MOST_VOTES + 1) ** 2
                on = np.bincount(code, self.weight * post, n) + 0.1
                off = np.bincount(code, self.weight * (1 - post), n) + 0.1
                ratio = np.log(on / on.sum()) - np.log(off / off.sum())
                self.tables.append(ratio)
                logit += ratio[code]
            new = sigmoid(logit)
            if np.abs(new - post).max() < 1e-6:
                break
            post = new
        return post

    @staticmethod
    def correlated(v: np.ndarray, weights: list[np.ndarray], least: float, joined=()) -> list[list[int]]:
        """Groups of voters whose votes are correlated under any of the weights, and those joined before."""
        m = v.shape[1]
        sides = (v == 2).astype(float) - (v == 1)
        parent = list(range(m))

        def root(k: int) -> int:
            while parent[k] != k:
                k = parent[k]
            return k

        for group in joined:
            for k in group[1:]:
                parent[root(k)] = root(group[0])
        most = np.zeros((m, m))
        for weight in weights:
            total = weight.sum() + 1e-9
            x = sides - (weight[:, None] * sides).sum(0) / total
            cov = (x * weight[:, None]).T @ x / total
            sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
            most = np.maximum(most, np.abs(cov / np.outer(sd, sd)) * (total > 20))
        for a, b in combinations(range(m), 2):
            if most[a, b] > least:
                parent[root(b)] = root(a)
        groups: dict[int, list[int]] = {}
        for k in range(m):
            groups.setdefault(root(k), []).append(k)
        return list(groups.values())


def linear(held: list[list[int]], target: np.ndarray, weight: np.ndarray, size: int, steps: int = 300, ridge: float = 2e-4):
    """Bias and weights of a logistic regression on the entries held, for soft labels of weighted rows, by Adam."""
    weight = weight / weight.sum()
    mean = float(weight @ target)
    rows = np.repeat(np.arange(len(held)), [len(x) for x in held])
    cols = np.concatenate([np.array(x, np.int64) for x in held]) if len(rows) else np.empty(0, np.int64)
    w, m, s = (np.zeros(size + 1) for _ in range(3))
    w[-1] = np.log((mean + 1e-3) / (1 - mean + 1e-3))
    for t in range(1, steps + 1):
        p = sigmoid(np.bincount(rows, w[cols], len(held)) + w[-1])
        r = (p - target) * weight
        grad = np.append(np.bincount(cols, r[rows], size), r.sum())
        grad[:-1] += ridge * w[:-1] / 10
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-10)
    return float(w[-1]), w[:-1]


class Holder:
    """Finds the known entries of a text, and marks for how many of its words hold a toxic one."""

    def __init__(self, known: set[str], toxic: set[str]):
        self.known, self.toxic = known, toxic
        # What a word adds, so that a word is taken apart once per task.
        self.parts: dict[str, tuple] = {}

    def _of(self, word: str) -> tuple:
        bare = EDGE.sub("", word)
        options = [bare, *[bare[:n] + "-" for n in BEGINNINGS if len(bare) > n]] if bare else []
        found = tuple(e for e in options if e in self.known)
        if len(self.parts) > 1_000_000:
            self.parts.clear()
        self.parts[word] = found
        return found

    def __call__(self, text: str | None) -> set[str]:
        words = set((text or "").lower().split())
        found, hits, get = set(), 0, self.parts.get
        for word in words:
            got = get(word)
            if got is None:
                got = self._of(word)
            if got:
                found.update(got)
                hits += not self.toxic.isdisjoint(got)
        found.update(mark for mark, least, share in MARKS if hits >= least and hits > share * len(words))
        return found


def fit(sample: DataFrame, base_rate: float) -> dict | float:
    sample = weighted(sample)
    shares = {r[0]: float(r[1]) for r in sample.groupBy("label").agg(F.sum("weight")).collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0))
    words = lexicon(sample, shares)
    if not len(words):
        return base_rate
    names = [*words["entry"], *[mark for mark, _, _ in MARKS]]
    toxic = set(words["entry"][words["lean"] > TOXIC_LEAN])
    known = {e: k for k, e in enumerate(names)}

    @F.pandas_udf(ArrayType(IntegerType()))
    def held_entries(texts: pd.Series) -> pd.Series:
        holder = Holder(set(known), toxic)
        return pd.Series([sorted(known[e] for e in holder(t)) for t in texts])

    rows = sample.orderBy("doc_id").select("weight", held_entries("text").alias("held"), pattern_hits("text").alias("hits"))
    rows = rows.toPandas()
    held = [set(x) for x in rows["held"]]
    hits = np.array(rows["hits"].tolist(), np.int64).reshape(len(rows), len(PATTERNS))
    lexicons = voters(words) + [(1, {known[mark]}) for mark, _, _ in MARKS]
    v = votes(held, hits, lexicons)
    prior = shares[1] / (shares[0] + shares[1])
    weight = rows["weight"].to_numpy()
    post = LabelModel(prior).fit(v, weight)
    bias, weights = linear([sorted(x) for x in held], post, weight, len(names))
    # The sample holds the classes in other shares than the corpus.
    shift = np.log(base_rate / (1 - base_rate)) - np.log(prior / (1 - prior))
    kept = {e: float(weights[k]) for e, k in known.items()}
    return {"bias": bias + float(shift), "weights": kept, "toxic": toxic}


def scorer(spark, model: dict):
    """The classifier as a column function; at most MAX_ENTRIES weights are broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bias, weights = shared.value["bias"], shared.value["weights"]
        holder = Holder(set(weights), shared.value["toxic"])
        for texts in batches:
            sums = [bias + sum(sorted(weights[e] for e in holder(text))) for text in texts]
            yield pd.Series(sigmoid(np.array(sums, float)))

    return scored


def score(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    learn = labels.where(remainder(F.col("doc_id"), PARTS) != HELD_OUT)
    ones, zeros = learn.agg(F.sum((F.col("toxic") == 1).cast("int")), F.sum((F.col("toxic") == 0).cast("int"))).first()
    base_rate = ((ones or 0) + 1) / ((ones or 0) + (zeros or 0) + 2)
    model = fit(labelled_sample(docs, labels, "toxic", PARTS, HELD_OUT, sample), base_rate)
    value = F.lit(model) if isinstance(model, float) else scorer(docs.sparkSession, model)("text")
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), PARTS) == HELD_OUT).alias("held_out"), value.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
