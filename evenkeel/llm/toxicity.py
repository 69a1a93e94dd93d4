"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed words, of which training keeps those that tell
most about the label, alone or in pairs: a pair tells if the documents with both words
have another share of label 1 than the log odds of the two words add up to. The score is a bias, a weight for each term, and for each pair
of terms the product of their factors: a pair can weigh what neither term does alone.

Training takes a sample of at most about ``sample`` labelled rows, chosen by a digest
of the id; terms are counted and chosen by Spark, and the fit runs on the sample's
chosen terms, which the driver holds.

Defined results: null and empty texts have no terms and score the bias. With one
label only, or none, every text scores the smoothed share of label 1. A document
with several labels counts as toxic if one says so. Repeated rows each get a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType

from evenkeel.llm.common import sampled, small

WORDS = regex.compile(r"[\p{L}\p{M}]+")
SLOTS = 1 << 30  # wide, so that a rare word seldom shares the slot of a telling one


@dataclass(frozen=True)
class Training:
    sample: int = 20_000
    terms: int = 2048       # slots that the model has weights for, at most
    least_docs: int = 5     # documents of the sample that a term is in
    least_tells: float = 15.0  # chi-square of a term, which chance seldom reaches
    paired: int = 1024      # most frequent slots, whose pairs are looked at
    pair_tells: float = 40.0   # chi-square of a pair, which chance seldom reaches in so many pairs
    factors: int = 8
    epochs: int = 30
    batch: int = 256
    rate: float = 0.2
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    slots: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, terms: list[int]) -> float:
        logit = self.bias
        if terms:
            v = self.factors[terms]
            logit += self.weights[terms].sum() + 0.5 * ((v.sum(axis=0) ** 2) - (v ** 2).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def slot(word: str) -> int:
    return xxhash.xxh32_intdigest(word) % SLOTS


@pandas_udf(ArrayType(IntegerType()))
def slots(texts: pd.Series) -> pd.Series:
    """The distinct slots of each text's words, in order."""
    return texts.map(lambda t: sorted({slot(w) for w in set(WORDS.findall((t or "").lower()))}))


def _fit(rows: list[np.ndarray], labels: np.ndarray, terms: int, how: Training):
    """Bias, weights and factors by AdaGrad on the logistic loss."""
    draw = np.random.default_rng(how.seed)
    bias = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    w, v = np.zeros(terms), draw.normal(0, 0.05, (terms, how.factors))
    sum_b, sum_w, sum_v = 1e-6, np.full(terms, 1e-6), np.full((terms, how.factors), 1e-6)
    sizes = np.array([len(r) for r in rows])
    for _ in range(how.epochs):
        order = draw.permutation(len(rows))
        for i in range(0, len(order), how.batch):
            part = order[i:i + how.batch]
            flat = np.concatenate([rows[d] for d in part]).astype(np.int64)
            owner = np.repeat(np.arange(len(part)), sizes[part])
            total = np.zeros((len(part), how.factors))
            np.add.at(total, owner, v[flat])
            squares = np.bincount(owner, (v[flat] ** 2).sum(axis=1), len(part))
            logit = bias + np.bincount(owner, w[flat], len(part)) + 0.5 * (
                (total ** 2).sum(axis=1) - squares)
            off = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]) / len(part)
            grad_w = np.bincount(flat, off[owner], terms) + how.decay * w / len(part)
            grad_v = how.decay * v / len(part)
            np.add.at(grad_v, flat, off[owner][:, None] * (total[owner] - v[flat]))
            grad_b = off.sum()
            sum_b, sum_w, sum_v = sum_b + grad_b ** 2, sum_w + grad_w ** 2, sum_v + grad_v ** 2
            bias -= how.rate * grad_b / np.sqrt(sum_b)
            w -= how.rate * grad_w / np.sqrt(sum_w)
            v -= how.rate * grad_v / np.sqrt(sum_v)
    return bias, w, v


def _telling_pairs(rows: list[np.ndarray], labels: np.ndarray, slots: np.ndarray, how: Training) -> list[int]:
    """The slots of the pairs that tell, those of the pair that tells most first.

    What is compared with the labels of the documents that have both is the share that
    the log odds of the two add up to; the documents go by in blocks.
    """
    if len(slots) < 2:
        return []
    both = np.zeros((len(slots), len(slots)), np.float64)
    bad = both.copy()
    for i in range(0, len(rows), 2048):
        block = np.zeros((len(rows[i:i + 2048]), len(slots)), np.float32)
        for d, one in enumerate(rows[i:i + 2048]):
            block[d, np.flatnonzero(np.isin(slots, one, assume_unique=True))] = 1
        both += block.T @ block
        block = block[labels[i:i + 2048] > 0]
        bad += block.T @ block
    share = labels.mean()

    def odds(b, n):
        p = (b + share) / (n + 1)
        return np.log(p / (1 - p))

    one = odds(bad.diagonal(), both.diagonal())
    expected = 1 / (1 + np.exp(np.log(share / (1 - share)) - one[:, None] - one[None, :]))
    # A document more or less is chance, however few were expected.
    tells = (bad - both * expected) ** 2 / np.maximum(1, both * expected * (1 - expected))
    a, b = np.triu_indices(len(slots), 1)
    order = np.lexsort((b, a, -tells[a, b]))
    order = order[tells[a, b][order] >= how.pair_tells]
    return list(dict.fromkeys(int(slots[x]) for k in order[:how.terms] for x in (a[k], b[k])))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic)."""
    label = labels.where("toxic is not null and doc_id is not null").groupBy(
        F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    share = F.lit(min(1.0, how.sample / max(1, label.count())))
    label = label.where(sampled(F.col("_id"), share))
    rows = docs.select("doc_id", "text").join(
        small(label, 2 * how.sample), F.col("doc_id") == F.col("_id")).select(
        F.col("_toxic").alias("toxic"), slots(F.col("text")).alias("slots")).persist()
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    good, bad = sum(n for t, n in sizes.items() if not t), sum(n for t, n in sizes.items() if t)
    if not good or not bad:
        rows.unpersist()
        return Model({}, float(np.log((bad + 1) / (good + 1))), np.zeros(0),
                     np.zeros((0, how.factors)))
    # How far the term is from being as frequent with either label (chi-square).
    counts = rows.select((F.col("toxic") != 0).cast("int").alias("bad"),
                         F.explode("slots").alias("slot")).groupBy("slot").agg(
        F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= how.least_docs)
    expected = F.col("n") * (bad / (good + bad))
    told = counts.withColumn("tells", (F.col("b") - expected) ** 2 / expected / (
        1 - F.col("n") / (good + bad + 1.0)))
    told = told.where(F.col("tells") >= how.least_tells)
    alone = [r["slot"] for r in told.orderBy(F.desc("tells"), "slot").limit(how.terms).collect()]
    frequent = [r["slot"] for r in counts.orderBy(F.desc("n"), "slot").limit(how.paired).collect()]
    known = np.array(sorted({*alone, *frequent}), np.int32)
    sample = rows.select((F.col("toxic") != 0).alias("toxic"), F.array_intersect(
        "slots", F.array(*[F.lit(int(s)) for s in known]).cast("array<int>")).alias("slots")).toPandas()
    rows.unpersist()
    # The order of tasks is no matter to the fit.
    sample["slots"] = [np.sort(np.asarray(x, np.int32)) for x in sample["slots"]]
    sample["key"] = [x.tobytes() for x in sample["slots"]]
    sample = sample.sort_values(["toxic", "key"], kind="stable")
    labelled = sample["toxic"].to_numpy().astype(float)
    chosen = alone + [s for s in _telling_pairs(list(sample["slots"]), labelled, np.sort(np.array(
        frequent, np.int32)), how) if s not in set(alone)]
    chosen = chosen[:how.terms]
    at = {s: i for i, s in enumerate(chosen)}
    place = np.array([at.get(s, -1) for s in known.tolist()], np.int64)
    terms = [x[x >= 0] for x in (place[np.searchsorted(known, one)] for one in sample["slots"])]
    fitted = _fit(terms, labelled, len(chosen), how)
    return Model(at, *fitted)


def _scorer(shipped: Broadcast):
    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, kept = shipped.value, {}
        for texts in batches:
            found = []
            for text in texts:
                words = set(WORDS.findall((text or "").lower()))
                if len(kept) > 300_000:
                    kept = {}
                for word in words:
                    if word not in kept:
                        kept[word] = model.slots.get(slot(word))
                terms = {kept[w] for w in words}
                terms.discard(None)
                found.append(model.score(sorted(terms)))
            yield pd.Series(found, dtype="float64")

    return run


def score(text: Column, model: Model, df: DataFrame) -> Column:
    """Probability of label 1 for a text of the frame."""
    return _scorer(df.sparkSession.sparkContext.broadcast(model))(text)
