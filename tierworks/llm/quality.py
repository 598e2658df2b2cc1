"""Quality classifier by co-training of a text view and a metadata view.

The text view sees the whole text: hashed words, word pairs and byte trigrams
(``WORD_BUCKETS``, ``PAIR_BUCKETS`` and ``GRAM_BUCKETS`` numbers, the root of each bucket's
share) beside statistics of its bytes, words and lines. The metadata view sees only the
other columns (language, source, stated length). Both start from labelled rows; in every
round each view labels the rows of an unlabelled pool it is most confident of, and the
other view trains on them. Confidence is calibrated on labelled rows that are held back and has
to beat the share of the class by far, so a view that knows nothing hands nothing over. Each class gets its share of a round by the labelled rows, so
that the frequent class does not crowd out the other. In the end both are calibrated once more, and
a logistic regression over the two calibrated views scores all documents.

Training uses samples of at most ``LABELLED`` labelled and ``POOL`` unlabelled rows,
chosen by the hash of their ids; scoring reads every row and the whole text in batches.
The pool is drawn from documents without a label. Where they are fewer than ``POOL``,
labelled documents beyond the sample fill it up with their labels hidden.

Defined cases: a null text is empty; null metadata is a value of its own. Labels that are
null are left out, of several labels of one document the lowest counts. If the labels
have fewer than two classes, or too few rows, every document gets the score 1. Equal rows
get equal scores. An empty table gives no rows. If every document is in the labelled
sample, the pool is empty and no round runs: the views learn from the labels alone. Rows
of one hash are drawn by their id. Long texts are read whole, one at a time; what is kept of
each is a row of numbers. Other columns are never read, ``keep_rows`` passes them on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tierworks.llm import linear
from tierworks.llm.common import id_hash, packed

LABELLED = 4000
POOL = 4000
ROUNDS = 4
# Share of the pool each view may label in a round; how sure it has to be, and how many times
# less often wrong than calling every row by the class.
PER_ROUND = 0.05
CONFIDENT = 0.9
LIFT = 5
THRESHOLD = 0.5
LEAST_ROWS = 20
BUCKETS = 32

# Classes of bytes whose shares are features of the text view.
_CLASSES = np.zeros(256, dtype=np.int64)
for _number, _members in enumerate(
    [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t",
     b"\n\r", b".,;:'\"()-?", b"!", b"|", b"#$%&*@^~=+_<>{}[]/\\`", bytes(range(128, 256))],
    start=1,
):
    _CLASSES[list(_members)] = _number
_N_CLASSES = 11
STATISTICS = _N_CLASSES + 11
# Numbers for hashed words, pairs of neighbouring words, and runs of three bytes.
WORD_BUCKETS, PAIR_BUCKETS, GRAM_BUCKETS = 128, 64, 64
TEXT_FEATURES = STATISTICS + WORD_BUCKETS + PAIR_BUCKETS + GRAM_BUCKETS
# Hashed numbers are scaled down so often against statistics: there are many, and each says little.
CONTENT_DAMPING = 5.0
# Bytes of a text whose trigrams are hashed at a time.
GRAM_BYTES = 1 << 20


def _shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / max(1, counts.sum()))


def content_features(raw: bytes, words: list[bytes]) -> np.ndarray:
    """Root shares of hashed lower-case words, word pairs and byte trigrams of a text."""
    number = {w: zlib.crc32(w.lower()) for w in set(words)}
    hashed = np.fromiter(map(number.__getitem__, words), dtype=np.uint32, count=len(words))
    pairs = (hashed[:-1] * np.uint32(0x9E3779B1)) ^ hashed[1:]
    grams = np.zeros(GRAM_BUCKETS)
    for start in range(0, len(raw) - 2, GRAM_BYTES):
        at = np.frombuffer(raw[start : start + GRAM_BYTES + 2].lower(), dtype=np.uint8).astype(np.uint32)
        mixed = ((at[:-2] << 16) | (at[1:-1] << 8) | at[2:]) * np.uint32(0x9E3779B1)
        grams += np.bincount((mixed >> 16) % GRAM_BUCKETS, minlength=GRAM_BUCKETS)
    return np.concatenate([
        _shares(np.bincount((hashed >> 8) % WORD_BUCKETS, minlength=WORD_BUCKETS)),
        _shares(np.bincount((pairs >> 8) % PAIR_BUCKETS, minlength=PAIR_BUCKETS)),
        _shares(grams),
    ])


def text_features(text: str | None) -> np.ndarray:
    """Statistics of one text (byte classes, words, repetition, lines) and its content."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return np.zeros(TEXT_FEATURES)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    shares = np.bincount(_CLASSES, weights=counts, minlength=_N_CLASSES) / len(raw)
    n, different = len(words), len(set(words))
    repeated = sum(map(bytes.__eq__, words, words[1:])) / n
    upper = counts[65:91].sum()
    letters = upper + counts[97:123].sum() + counts[128:].sum()
    lines = raw.count(b"\n") + 1
    rest = [
        np.log1p(n),
        np.log1p(len(raw) / n),
        different / n,
        np.log1p(different) / np.log1p(n),
        repeated,
        np.sqrt(repeated),
        upper / max(1, letters),
        letters / len(raw),
        np.sqrt(shares[8]),
        np.sqrt(shares[7]),
        np.log1p(lines / n),
    ]
    return np.concatenate([shares, rest, content_features(raw, words)])


def metadata_features(frame: pd.DataFrame) -> np.ndarray:
    """Hashed language and source, and the stated length, of each row."""
    def buckets(values: pd.Series) -> np.ndarray:
        codes, different = pd.factorize(values, use_na_sentinel=False)
        places = [zlib.crc32(("" if pd.isna(v) else "=" + v).encode()) % BUCKETS for v in different]
        return np.eye(BUCKETS)[np.array(places, dtype=np.int64)[codes]]

    stated = pd.to_numeric(frame["n_chars"]).astype("float64")
    size = np.log1p(stated.clip(lower=0).fillna(0).to_numpy())
    return np.hstack([
        buckets(frame["lang"]), buckets(frame["source"]),
        np.stack([size, size**2 / 10, stated.isna().to_numpy(float)], axis=1),
    ])


class View(NamedTuple):
    """A classifier of one view: scaling, weights and the two numbers of its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    calibration: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return linear.logit((x - self.mean) / self.scale, self.weights)

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return linear.logit(self.raw(x)[:, None], self.calibration)


class Model(NamedTuple):
    text: View
    metadata: View
    combined: np.ndarray

    def score(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        views = np.stack([self.text.calibrated(text), self.metadata.calibrated(metadata)], axis=1)
        return linear.sigmoid(linear.logit(views, self.combined))


def _view(x: np.ndarray, y: np.ndarray, damping: np.ndarray | float = 1.0) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    scale = scale * damping
    return View(mean, scale, linear.fit((x - mean) / scale, y), np.array([1.0, 0.0]))


def platt(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept that make a view's scores probabilities, after Platt (1999).

    The targets are smoothed by one row a class, so few rows never make a view certain.
    """
    good = y.sum()
    targets = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    return linear.fit(raw[:, None], targets)


def most_confident(sure: np.ndarray, given: dict[int, float], prior: float) -> dict[int, float]:
    """New pseudo-labels of one round from a view's probabilities ``sure`` over the pool.

    A round labels ``PER_ROUND`` of the pool, of which the good class gets the share
    ``prior`` and the other the rest, at least one row each; rows in ``given``, and rows
    the view is not sure enough of, are passed over.
    """
    size = PER_ROUND * len(sure)
    found: dict[int, float] = {}
    for label, share in ((1.0, prior), (0.0, 1 - prior)):
        wrong = 1 - sure if label else sure
        order = np.argsort(wrong, kind="stable")
        enough = wrong[order] <= min(1 - CONFIDENT, (1 - share) / LIFT)
        fresh = [int(i) for i in order[enough] if int(i) not in given]
        found |= dict.fromkeys(fresh[: max(1, round(size * share))], label)
    return found


def co_train(
    labelled: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS,
    damping: tuple[np.ndarray | float, np.ndarray | float] = (1.0, 1.0),
) -> Model | None:
    """``labelled`` and ``pool`` hold one matrix for each of the two views; ``damping`` divides
    the standardised columns of a view, so that the ridge holds them back more."""
    if len(y) < LEAST_ROWS or len(np.unique(y)) < 2:
        return None
    held = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
        return None
    train = [(x[~held], y[~held]) for x in labelled]
    given: list[dict[int, float]] = [{}, {}]  # pseudo-labels each view was given
    views = [_view(*t, d) for t, d in zip(train, damping, strict=True)]
    prior = float(y[~held].mean())
    for _ in range(rounds if len(pool[0]) else 0):
        for sender, receiver in ((0, 1), (1, 0)):
            view = views[sender]
            view = view._replace(calibration=platt(view.raw(labelled[sender][held]), y[held]))
            sure = linear.sigmoid(view.calibrated(pool[sender]))
            given[receiver] |= most_confident(sure, given[receiver], prior)
        for k in (0, 1):
            rows = np.array(list(given[k]), dtype=int)
            x, known = train[k]
            views[k] = _view(
                np.vstack([x, pool[k][rows]]), np.concatenate([known, list(given[k].values())]),
                damping[k],
            )
    views = [
        v._replace(calibration=platt(v.raw(x[held]), y[held]))
        for v, x in zip(views, labelled, strict=True)
    ]
    stacked = np.stack([v.calibrated(x[held]) for v, x in zip(views, labelled, strict=True)], axis=1)
    return Model(views[0], views[1], linear.fit(stacked, y[held]))


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        stats = [text_features(t).tolist() for t in frame["text"]]
        yield frame.drop(columns="text").assign(stats=stats)


def pool_ids(docs: DataFrame, known: DataFrame, some: DataFrame, pool: int) -> DataFrame:
    """At most ``pool`` ids of documents outside the sample ``some``, those without a label first."""
    ids = docs.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    labelled = known.select("doc_id", F.lit(True).alias("labelled"))
    rest = ids.join(labelled, "doc_id", "left").join(some.select("doc_id"), "doc_id", "left_anti")
    order = [F.col("labelled").isNotNull(), id_hash(F.col("doc_id"), "pool"), F.col("doc_id")]
    return rest.orderBy(*order).limit(pool).select("doc_id")


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    """The model from documents (doc_id, text, lang, source, n_chars) and labels (doc_id, quality)."""
    order = [id_hash(F.col("doc_id"), "quality"), F.col("doc_id")]
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("quality")
    )
    some = known.orderBy(*order).limit(labelled)
    others = pool_ids(docs, known, some, pool).withColumn("quality", F.lit(None).cast("double"))
    # At most ``labelled + pool`` ids, so the broadcast is bounded.
    wanted = some.unionByName(others).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sampled = docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").cast("string"),
        F.col("source").cast("string"), F.col("n_chars").cast("double"),
    ).join(F.broadcast(wanted), F.col("id") == F.col("doc_id"))
    rows = sampled.select("doc_id", "text", "lang", "source", "n_chars", "quality").mapInPandas(
        _features,
        "doc_id long, lang string, source string, n_chars double, quality double, "
        "stats array<double>",
    )
    # Ids can repeat, so the limit is set once more before rows reach the driver.
    frame = rows.orderBy(*order, F.xxhash64("stats")).limit(labelled + pool).toPandas()
    text = np.array(frame["stats"].to_list(), dtype=float).reshape(len(frame), TEXT_FEATURES)
    metadata = metadata_features(frame)
    is_known = frame["quality"].notna().to_numpy()
    y = (frame["quality"][is_known] > 0).to_numpy(float)
    views = [text[is_known], metadata[is_known]], y, [text[~is_known], metadata[~is_known]]
    content = np.repeat([1.0, CONTENT_DAMPING], [STATISTICS, TEXT_FEATURES - STATISTICS])
    return co_train(*views, damping=(content, 1.0))


def score(model: Model | None, text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    """The probability that a document is good; 1 without a model."""

    @F.pandas_udf("double")
    def scored(text: pd.Series, lang: pd.Series, source: pd.Series, n: pd.Series) -> pd.Series:
        stats = np.array([text_features(t) for t in text]).reshape(len(text), TEXT_FEATURES)
        frame = pd.DataFrame({"lang": lang, "source": source, "n_chars": n})
        return pd.Series(model.score(stats, metadata_features(frame)))

    if model is None:
        return F.lit(1.0)
    return scored(text, lang.cast("string"), source.cast("string"), n_chars.cast("double"))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, keep."""
    model = train(docs, labels)
    found = score(model, *(F.col(c) for c in ("text", "lang", "source", "n_chars")))
    return docs.select("doc_id", found.alias("score")).withColumn(
        "keep", F.col("score") >= threshold
    )


def keep_rows(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with their columns as they are."""
    model = train(docs, labels)
    found = score(model, *(F.col(f"row.{c}") for c in ("text", "lang", "source", "n_chars")))
    return packed(docs).withColumn("score", found).filter(F.col("score") >= threshold).select("row.*")
