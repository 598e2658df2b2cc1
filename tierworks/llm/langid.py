"""Language identification by a byte convolutional network in numpy.

Bytes are embedded, filters of several widths run over windows of ``WINDOW`` bytes, each
filter's maximum over the window is kept, and a softmax layer gives the languages. All
windows of a text are classified in batches and their log probabilities averaged, so the
whole text counts. Training takes windows spread over the whole of sampled texts.

At most ``TRAIN_WINDOWS`` windows are used for training: documents are sampled by the
hash of their ids, about ``DOCS_PER_LANGUAGE`` of each language. If they have more
windows, the languages take turns until the bound is reached, so each keeps an equal
number or all it has; with more languages than that, each keeps one window.

Defined cases: a text that is null or has no letter gives ``und`` with score 0; so does
every text if there is nothing to learn from. Equal rows get equal results. A language
that none of the sampled documents has cannot be predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window, functions as F

from tierworks.llm.common import HASH_RANGE, id_hash, staged

WINDOW = 128
WINDOWS_PER_DOC = 8
DOCS_PER_LANGUAGE = 400
TRAIN_WINDOWS = 40_000
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 6
STEPS = 400
BATCH = 64
RATE = 0.01
# Windows classified at once.
PIECE = 2048

LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


class Network(NamedTuple):
    languages: list[str]
    embedding: np.ndarray  # byte -> EMBEDDING numbers
    kernel: np.ndarray  # filters of all widths over the largest one, zero beyond their own
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def _shape_mask() -> np.ndarray:
    """1 where a filter of its width has weights."""
    widest = max(WIDTHS)
    mask = np.zeros((widest, EMBEDDING, len(WIDTHS) * FILTERS), dtype=np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
    return mask.reshape(widest * EMBEDDING, -1)


def _gathered(embedded: np.ndarray) -> np.ndarray:
    """(windows, bytes, EMBEDDING) to the inputs of each filter position, padded at the end."""
    widest = max(WIDTHS)
    n, length, size = embedded.shape
    padded = np.zeros((n, length + widest - 1, size), dtype=np.float32)
    padded[:, :length] = embedded
    view = np.lib.stride_tricks.as_strided(
        padded, (n, length, widest * size), (padded.strides[0], padded.strides[1], padded.strides[2])
    )
    return np.ascontiguousarray(view)


def forward(net: Network, windows: np.ndarray):
    inputs = _gathered(net.embedding[windows])
    response = inputs.reshape(-1, inputs.shape[2]) @ net.kernel
    response = response.reshape(len(windows), windows.shape[1], -1)
    top = response.max(axis=1) + net.bias
    pooled = np.maximum(top, 0)
    logits = pooled @ net.out + net.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    log_p = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return inputs, response, pooled, log_p


def fit(windows: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = 7) -> Network | None:
    """Adam on cross-entropy; languages are drawn evenly, so a frequent one is no prior."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    wide, many = max(WIDTHS), len(WIDTHS) * FILTERS
    mask = _shape_mask()
    y = np.array([languages.index(x) for x in labels])
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    values = [
        draw(256, EMBEDDING, scale=0.5),
        draw(wide * EMBEDDING, many, scale=0.3) * mask,
        np.zeros(many, np.float32),
        draw(many, len(languages), scale=0.3),
        np.zeros(len(languages), np.float32),
    ]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        drawn = rng.integers(0, len(languages), BATCH)
        rows = np.array([by_language[k][rng.integers(0, len(by_language[k]))] for k in drawn])
        net = Network(languages, *values)
        inputs, response, pooled, log_p = forward(net, windows[rows])
        d_logits = np.exp(log_p)
        d_logits[np.arange(BATCH), y[rows]] -= 1
        d_logits /= BATCH
        d_pooled = (d_logits @ net.out.T) * (pooled > 0)
        # Only the position of a filter's maximum passes a gradient on.
        at = response.argmax(axis=1)
        taken = np.take_along_axis(inputs[:, :, :, None], at[:, None, None, :], axis=1)[:, 0]
        d_kernel = np.einsum("bif,bf->if", taken, d_pooled) * mask
        d_inputs = np.einsum("if,bf->bfi", net.kernel, d_pooled)
        positions = at[:, :, None] + np.arange(wide)
        inside = positions < windows.shape[1]
        octets = windows[rows][np.arange(BATCH)[:, None, None], np.minimum(positions, windows.shape[1] - 1)]
        d_embedding = np.zeros_like(net.embedding)
        np.add.at(
            d_embedding, octets[inside], d_inputs.reshape(BATCH, many, wide, EMBEDDING)[inside]
        )
        slopes = [d_embedding, d_kernel, d_pooled.sum(axis=0), pooled.T @ d_logits, d_logits.sum(axis=0)]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            ahead = first[k] / (1 - 0.9**step)
            values[k] = values[k] - RATE * ahead / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            values[k] = values[k].astype(np.float32)
    return Network(languages, *values)


def cut(text: bytes) -> np.ndarray:
    """All windows of a text, one after the other, the last padded with zero bytes."""
    count = max(1, -(-len(text) // WINDOW))
    padded = text.ljust(count * WINDOW, b"\0")
    return np.frombuffer(padded, dtype=np.uint8).reshape(count, WINDOW)


def predict(net: Network, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and probability of each text."""
    readable = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
    found, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    sums = np.zeros((len(readable), len(net.languages)))
    counts = np.zeros(len(readable))
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush() -> None:
        windows, owner = np.concatenate(waiting), np.concatenate(owners)
        for at in range(0, len(windows), PIECE):
            log_p = forward(net, windows[at : at + PIECE])[3]
            np.add.at(sums, owner[at : at + PIECE], log_p)
        waiting.clear()
        owners.clear()

    held = 0
    for k, i in enumerate(readable):
        windows = cut(texts[i].encode("utf-8", "replace"))
        counts[k] = len(windows)
        waiting.append(windows)
        owners.append(np.full(len(windows), k))
        held += len(windows)
        if held >= PIECE:
            flush()
            held = 0
    if waiting:
        flush()
    if readable:
        mean = sums / counts[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for k, i in enumerate(readable):
            best = int(p[k].argmax())
            found[i], score[i] = net.languages[best], float(p[k, best])
    return found, score


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _spread_windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for lang, text, order in zip(frame["lang"], frame["text"], frame["order"], strict=True):
            windows = cut(text.encode("utf-8", "replace"))
            chosen = np.unique(np.linspace(0, len(windows) - 1, WINDOWS_PER_DOC).astype(int))
            rows += [(lang, windows[i].tobytes(), order, int(i)) for i in chosen]
        yield pd.DataFrame(rows, columns=["lang", "window", "order", "at"])


def _evenly(windows: DataFrame, most: int) -> DataFrame:
    """``windows`` in order, or ``most`` of them (at least one a language) dealt in turns."""
    order = ["order", "at", "lang", "window"]
    if windows.count() <= most:
        return windows.orderBy(*order)
    # A language has the windows of about ``DOCS_PER_LANGUAGE`` documents here, not of all.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    languages = windows.select("lang").distinct().count()
    dealt = windows.withColumn("turn", turn).orderBy("turn", *order).limit(max(most, languages))
    return dealt.orderBy(*order).drop("turn")


def train(docs: DataFrame) -> Network | None:
    """The network learned from (doc_id, text, lang) of rows that are not held out."""
    usable = docs.select("doc_id", "text", "lang", id_hash(F.col("doc_id"), "lang").alias("order"))
    usable = usable.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(
        F.least(F.lit(1.0), F.lit(DOCS_PER_LANGUAGE) / F.count(F.lit(1))).alias("share")
    )
    # Written first, so that its size is known and the texts are not shuffled to meet it.
    sampled = usable.join(staged(counts, "language-shares"), "lang").filter(F.col("order") < F.col("share") * HASH_RANGE)
    windows = sampled.select("lang", "text", "order").mapInPandas(
        _spread_windows, "lang string, window binary, order long, at int"
    )
    frame = _evenly(staged(windows, "language-windows"), TRAIN_WINDOWS).toPandas()
    octets = np.frombuffer(b"".join(map(bytes, frame["window"])), dtype=np.uint8)
    return fit(octets.reshape(-1, WINDOW), frame["lang"].tolist())


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""

    @F.pandas_udf("lang string, score double")
    def guess(text: pd.Series) -> pd.DataFrame:
        lang, score = predict(net, text.tolist())
        return pd.DataFrame({"lang": lang, "score": score})

    if net is None:
        return docs.select(
            "doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
        )
    found = docs.select("doc_id", guess("text").alias("found"))
    return found.select(
        "doc_id", held_out().alias("held_out"), F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )
