"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: its words in lower case and their first 3, 4 and 5
letters, hashed into ``BUCKETS``. The score is the logistic function of

    bias + sum of weights + sum over pairs of terms of (factors of one) . (factors of other)

so a pair such as an insult and the name of a group can count for more, or for less, than
its two words add up to. The pair sum is computed in linear time as half of the square of
the summed factors less the summed squares.

Training uses at most ``PER_CLASS`` labelled rows of each class, chosen by the hash of
their ids and weighted so that both classes count as often as in all labels. Of the terms
of these rows the ``TERMS`` whose counts differ most between the classes (a normal
deviate of ``DEVIATE`` or more, in ``LEAST_DOCS`` rows or more) are kept; all others score
nothing, so a long clean text does not add up noise. The machine is fitted in numpy with
Adagrad. Scoring reads every row and the whole text, in pieces.

Defined cases: a null or empty text, or one without a kept term, gets the score of the
bias. Of several labels of one document the highest counts; null labels and labels of
null ids are left out. With fewer than two classes every score is the share of class 1
(0 without labels). Of rows that share an id all are scored, and each may be trained on
within the bound. Ties of terms go to the smaller bucket. Equal texts get equal scores.
An empty table gives no rows. Other columns of ``docs`` are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tierworks.llm.common import id_hash, staged
from tierworks.llm.linear import sigmoid

PER_CLASS = 8_000
BUCKETS = 1 << 18
TERMS = 2_048
DEVIATE = 4.0
LEAST_DOCS = 3
PREFIXES = (3, 4, 5)
THRESHOLD = 0.3
FACTORS = 8
EPOCHS = 12
BATCH = 128
RATE = 0.1
WEIGHT_PENALTY = 1e-3
FACTOR_PENALTY = 1e-2
# Characters of a text read at once, and words whose terms are remembered.
PIECE = 1 << 20
REMEMBERED = 500_000

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def words_of(text: str | None) -> set[str]:
    """The different words of a whole text; long texts are cut between words."""
    lower, found, at = (text or "").lower(), set(), 0
    while at < len(lower):
        to = min(len(lower), at + PIECE)
        if to < len(lower) and (last := regex.search(r"(?r)[^\p{L}\p{N}]", lower, pos=at, endpos=to)):
            to = last.end()
        elif to < len(lower):  # one word longer than a piece
            end = regex.compile(r"[^\p{L}\p{N}]").search(lower, to)
            to = end.start() if end else len(lower)
        found.update(_WORD.findall(lower, at, to))
        at = to
    return found


def buckets_of(word: str) -> list[int]:
    """The buckets of a word's terms."""
    terms = [word] + ["^" * n + word[:n] for n in PREFIXES if len(word) > n]
    return [zlib.crc32(t.encode("utf-8", "replace")) % BUCKETS for t in terms]


class Machine(NamedTuple):
    buckets: np.ndarray  # the kept buckets, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, places: np.ndarray) -> float:
        """``places``: different rows of ``buckets`` that a text has."""
        if not len(places):
            return self.bias
        some = self.factors[places]
        pairs = (some.sum(axis=0) ** 2).sum() - (some**2).sum()
        return float(self.bias + self.weights[places].sum() + 0.5 * pairs)


def fit(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, buckets: np.ndarray, seed: int = 5) -> Machine:
    """``rows`` hold the places of each text's kept terms, ``weight`` what each text counts."""
    rng = np.random.default_rng(seed)
    bias = float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    weights, factors = np.zeros(len(buckets)), rng.normal(0, 0.05, (len(buckets), FACTORS))
    squares = [1e-8, np.full(weights.shape, 1e-8), np.full(factors.shape, 1e-8)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            some = order[at : at + BATCH]
            x = np.zeros((len(some), len(buckets)))
            for r, i in enumerate(some):
                x[r, rows[i]] = 1.0
            summed = x @ factors
            logit = bias + x @ weights + 0.5 * ((summed**2).sum(axis=1) - x @ (factors**2).sum(axis=1))
            off = weight[some] * (sigmoid(logit) - y[some]) / len(some)
            seen = x.mean(axis=0)
            slopes = [
                off.sum(),
                x.T @ off + WEIGHT_PENALTY * weights * seen,
                x.T @ (off[:, None] * summed) - factors * (x.T @ off)[:, None]
                + FACTOR_PENALTY * factors * seen[:, None],
            ]
            for k, slope in enumerate(slopes):
                squares[k] = squares[k] + slope**2
            steps = [RATE * g / np.sqrt(s) for g, s in zip(slopes, squares, strict=True)]
            bias, weights, factors = float(bias - steps[0]), weights - steps[1], factors - steps[2]
    return Machine(buckets, bias, weights, factors)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _bucketed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sets = [sorted({b for w in words_of(t) for b in buckets_of(w)}) for t in frame["text"]]
        yield frame[["doc_id", "toxic"]].assign(buckets=sets)


def _differing(rows: DataFrame, sizes: dict[float, int], terms: int) -> np.ndarray:
    """The buckets whose counts differ most between the classes, ascending."""
    n1, n = sizes[1.0], sizes[0.0] + sizes[1.0]
    share = F.col("docs") / F.lit(float(n))
    apart = F.col("toxic_docs") - n1 * share
    spread = F.sqrt(F.lit(n1 * (n - n1) / n) * share * (1 - share))
    counted = (
        rows.select("toxic", F.explode("buckets").alias("bucket")).groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("toxic").alias("toxic_docs"))
        .filter((F.col("docs") >= LEAST_DOCS) & (F.col("docs") < n))
        .withColumn("deviate", F.abs(apart / spread)).filter(F.col("deviate") >= DEVIATE)
    )
    best = counted.orderBy(F.desc("deviate"), "bucket").limit(terms).select("bucket").collect()
    return np.array(sorted(r["bucket"] for r in best), dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, terms: int = TERMS) -> Machine:
    """The machine from documents (doc_id, text) and labels (doc_id, toxic) not held out."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("double").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = sizes.get(1.0, 0) / max(1, sum(sizes.values()))
    nothing = Machine(
        np.zeros(0, np.int64), float(np.log(max(prior, 1e-12) / max(1 - prior, 1e-12))),
        np.zeros(0), np.zeros((0, FACTORS)),
    )
    if len(sizes) < 2:
        return nothing
    order = [id_hash(F.col("doc_id"), "toxic"), F.col("doc_id")]
    some = [known.filter(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0.0, 1.0)]
    # At most 2 * per_class ids, so the broadcast is bounded.
    wanted = some[0].unionByName(some[1]).select(F.col("doc_id").alias("id"), "toxic")
    sampled = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("id"))
    rows = staged(
        sampled.select("doc_id", "toxic", "text")
        .mapInPandas(_bucketed, "doc_id long, toxic double, buckets array<int>"),
        "toxic-terms",
    )
    found = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(found) < 2:
        return nothing
    kept = _differing(rows, found, terms)

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = [np.flatnonzero(np.isin(kept, b)).astype(np.int32) for b in frame["buckets"]]
            yield frame[["doc_id", "toxic"]].assign(places=own)

    narrow = rows.mapInPandas(places, "doc_id long, toxic double, places array<int>")
    # Ids can repeat, so the limit is set once more before rows reach the driver.
    frame = narrow.orderBy(*order, "places").limit(2 * per_class).toPandas()
    y = frame["toxic"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return nothing
    share = np.where(y == 1, prior / (y == 1).mean(), (1 - prior) / (y == 0).mean())
    return fit([np.asarray(p, dtype=np.int64) for p in frame["places"]], y, share, kept)


class Scorer:
    """Scores texts; the kept terms of words already met are remembered."""

    def __init__(self, machine: Machine) -> None:
        self.machine = machine
        self.place = {int(b): i for i, b in enumerate(machine.buckets)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _places(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = tuple(self.place[b] for b in buckets_of(word) if b in self.place)
        if len(word) <= 64:
            self.known[word] = found
        return found

    def score(self, text: str | None) -> float:
        known, places = self.known, set()
        for word in words_of(text):
            found = known.get(word)
            if found is None:
                found = self._places(word)
            if found:
                places.update(found)
        return float(sigmoid(self.machine.logit(np.array(sorted(places), dtype=np.int64))))


def scores(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    found = docs.select("doc_id", held_out().alias("held_out"), scored("text").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
