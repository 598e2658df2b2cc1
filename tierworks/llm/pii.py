"""Personal data by a linear-chain conditional random field over word shapes.

Patterns give the base spans; the field adds spans that patterns miss. It is trained by
maximum likelihood on the small labelled table below. The features of a word are its
shape (letters and digits replaced by classes), the shapes of its neighbours and cue
words before it. Words of a batch of documents are decoded together by Viterbi in numpy.

The chain of a document is cut behind every ``UNIT`` words, at the next word without a
digit or an at sign, so no number is cut apart. Within a run of numbers longer than
``RUN`` words it is cut as well; there ``MARGIN`` words on both sides, more than a span can
have, are decoded with each part and left to their own. Time is linear in a text, memory
follows the longest one. Neighbouring spans of one kind are decoded as one run, which is cut again: behind
a word that ends with a comma or semicolon, at an at sign or address each, before an open
bracket or plus once a number is complete, and where a run holds nothing as a whole, into
the fewest and most even parts that do. A decoded span has to hold what its kind needs (an at sign, enough digits, a
valid check sum) and must not touch a base span.

Defined cases: a null text is empty and has no spans. Equal rows give equal results. An
empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierworks.llm.pii_base import KINDS, base_spans, is_card

LABELS = ("other", *KINDS)
UNIT = 512
RUN = 4096
MARGIN = 40
# Words a span has at most.
SPAN_WORDS = 32
FEATURES = 1024
STEPS = 150
RATE = 0.1
PENALTY = 1e-3

#: Words that announce personal data; fixed values.
CUES = ["phone", "telephone", "tel", "call", "fax", "mobile", "cell", "dial", "email", "e-mail",
        "mail", "write", "card", "visa", "mastercard", "credit", "pay", "ip", "host", "server",
        "address", "from"]

#: The labelled table: [kind|words] marks a span, all other words are ``other``.
LABELLED = """
please call [phone|(555) 010-2345] after noon
call us at [phone|555-010-7788] or write a letter
tel: [phone|020 7946 0018] office hours only
phone [phone|555.010.4433] is no longer in use
my mobile is [phone|0170 555 0123] thanks
fax [phone|(030) 555-0199] and nothing else
dial [phone|+44 20 7946 0321] today
reach the desk under [phone|+1 (555) 010-9876] at night
mobile: [phone|+49 170 5550199] or later
you can text [phone|555 010 6677] any time
the number [phone|(212) 555-0147] was given
phone: [phone|1-555-010-3322] extension none
write to [email|anna.smith@example.org] for details
mail [email|j_doe42@mail.example.com] now
email: [email|info@example.net] works
contact [email|root@localhost] on the machine
send it to [email|bob@intranet] please
mail me at [email|carol.white@mail7.example.com] soon
the reply came from [email|x.y@sub.example.co.uk] again
e-mail [email|admin@server] if it fails
from host [ip|10.0.0.1] to the router
the server [ip|192.168.17.4] was down
ip [ip|172.16.254.1] is blocked
address [ip|203.0.113.77] answered
logs show [ip|198.51.100.23] twice
connect to [ip|192.0.2.200] and wait
card [card|4111 1111 1111 1111] was charged
pay with [card|4012888888881881] today
visa [card|4111-1111-1111-1111] expires soon
credit card [card|5555555555554444] declined
the card [card|5105.1051.0510.5100] is old
mastercard [card|5105 1051 0510 5100] accepted
he used [card|378282246310005] again
the meeting is on 2024-01-15 at 10:30
version 2.0 was released in 2021
chapter 3 and section 4.2.1 of the book
it costs 1,234.50 dollars or 99 cents
in 1999 there were 12345 people and 42 houses
order 20391 has 3 items of 250 grams
password=5aaa9ac60bfe74b24b must not be shared
licensed under the apache license version 2.0
this work is licensed under cc by-nc 4.0
a score of 3-2 after 90 minutes
the years 1914-1918 and 1939-1945 were hard
see page 17 and table 5 for the data
the ratio was 0.25 to 1.75 in all
about 100000 copies were sold by 2010
released under the mit license in 2015
room 12b on floor 3 of building 7
key=ab12cd34ef56 and token=99aa88bb77
the and of them were by or
und die der auf dem weg zu haus
les enfants de la ville et du pays
el perro de la casa y los gatos
THE END!! OF!! IT!!
one | two | three | four
words*** with### signs$$$ after%%%
isbn 978-3-16-148410-0 of the book
id 00012345678901234567890 in the log
at 12:45:10 on 03/04/2020 in time
"""

_TO_CLASS = bytes.maketrans(
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256)),
    b"x" * 26 + b"X" * 26 + b"d" * 10 + b"x" * 128,
)
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_CUE_OF = {c.encode(): i for i, c in enumerate(CUES, start=1)}
_EDGES = frozenset(b".,;:!?\"'()[]{}<>")
_EDGES_BEFORE = {"phone": _EDGES - frozenset(b"(")}
_NONE = b""


def _bucket(n: int) -> int:
    return int(np.searchsorted([0, 1, 3, 4, 6, 9, 11, 15, 19], n))


def shape_features(shape: bytes) -> list[str]:
    """What the field sees of a word; ``shape`` has x, X and d for letters and digits."""
    if shape == _NONE:
        return ["edge"]
    letters = re.sub(rb"[xX]+", b"x", shape)
    coarse = re.sub(rb"d+", b"d", letters).decode("ascii", "replace")
    digits = shape.count(b"d")
    found = [f"coarse={coarse[:24]}", f"digits={_bucket(digits)}", f"dots={min(4, shape.count(b'.'))}"]
    if digits and len(letters) <= 24:
        found.append(f"shape={letters.decode('ascii', 'replace')}")
    for name, sign in (("at", b"@"), ("plus", b"+"), ("open", b"("), ("dash", b"-"),
                       ("equals", b"="), ("slash", b"/"), ("colon", b":")):
        if sign in shape:
            found.append(name)
    found.append("mixed" if digits and b"x" in letters else "plain")
    return found


def _numbers(prefix: str, features: list[str]) -> list[int]:
    return [zlib.crc32(f"{prefix}{f}".encode()) % FEATURES for f in features]


class Words(NamedTuple):
    """Words of one text as the field sees them."""

    shapes: list[bytes]
    cues: list[int]


def words_of(raw: bytes) -> Words:
    shapes = raw.translate(_TO_CLASS).split()
    return Words(shapes, [_CUE_OF.get(w.rstrip(b":"), 0) for w in raw.lower().split()])


def labelled_rows() -> list[tuple[bytes, list[int]]]:
    """The labelled table as texts and a label for each word."""
    rows = []
    for line in LABELLED.strip().splitlines():
        words: list[str] = []
        labels: list[int] = []
        for kind, inside, outside in re.findall(r"\[(\w+)\|([^\]]*)\]|([^\[]+)", line):
            here = (inside or outside).split()
            words += here
            labels += [LABELS.index(kind) if kind else 0] * len(here)
        rows.append((" ".join(words).encode(), labels))
    return rows


class Field(NamedTuple):
    """Weights of features for each label, and of labels that follow each other."""

    weights: np.ndarray
    follow: np.ndarray


def _token_features(words: Words) -> list[list[int]]:
    n = len(words.shapes)
    shape = lambda i: words.shapes[i] if 0 <= i < n else _NONE
    cue = lambda i: words.cues[i] if i >= 0 else 0
    return [
        _numbers("own:", shape_features(shape(i)))
        + _numbers("before:", shape_features(shape(i - 1)))
        + _numbers("after:", shape_features(shape(i + 1)))
        + _numbers("cue1:", [str(cue(i - 1))]) + _numbers("cue2:", [str(cue(i - 2))])
        for i in range(n)
    ]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(rows: list[tuple[bytes, list[int]]], steps: int = STEPS) -> Field:
    """Maximum likelihood by forward and backward sums over all rows at once, with Adam."""
    many = len(LABELS)
    length = max(len(labels) for _, labels in rows)
    x = np.zeros((len(rows), length, FEATURES))
    y = np.zeros((len(rows), length, many))
    there = np.zeros((len(rows), length), dtype=bool)
    for r, (raw, labels) in enumerate(rows):
        for t, features in enumerate(_token_features(words_of(raw))):
            np.add.at(x[r, t], features, 1.0)
            y[r, t, labels[t]] = 1
            there[r, t] = True
    both = there[:, 1:] & there[:, :-1]
    seen_follow = np.einsum("rti,rtj->ij", y[:, :-1] * both[..., None], y[:, 1:])
    values = [np.zeros((FEATURES, many)), np.zeros((many, many))]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    flat = x.reshape(-1, FEATURES)
    for step in range(1, steps + 1):
        weights, follow = values
        score = (flat @ weights).reshape(len(rows), length, many)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, length):
            step_on = _log_sum(ahead[:, t - 1, :, None] + follow, axis=1) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None], step_on, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            step_on = _log_sum(follow + (score[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
            back[:, t] = np.where(there[:, t + 1, None], step_on, 0.0)
        total = _log_sum(ahead[:, -1], axis=1)
        p = np.exp(ahead + back - total[:, None, None]) * there[..., None]
        pair = (
            ahead[:, :-1, :, None] + follow + (score[:, 1:] + back[:, 1:])[:, :, None, :]
            - total[:, None, None, None]
        )
        expected = (np.exp(pair) * both[..., None, None]).sum(axis=(0, 1))
        slopes = [
            flat.T @ (p - y).reshape(-1, many) / len(rows) + PENALTY * weights,
            (expected - seen_follow) / len(rows) + PENALTY * follow,
        ]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            values[k] = values[k] - RATE * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
            )
    return Field(*values)


class Decoder:
    """Viterbi over many texts at once, with the scores of shapes kept once worked out."""

    MOST_SHAPES = 200_000

    def __init__(self, field: Field) -> None:
        self.field = field
        self.cue_scores = np.stack([
            np.stack([field.weights[_numbers(p, [str(c)])].sum(axis=0) for c in range(len(CUES) + 1)])
            for p in ("cue1:", "cue2:")
        ])
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self._shape(_NONE)

    def _shape(self, shape: bytes) -> int:
        found = self.number.get(shape)
        if found is None:
            features = shape_features(shape)
            self.rows.append(np.stack([
                self.field.weights[_numbers(p, features)].sum(axis=0)
                for p in ("own:", "before:", "after:")
            ]))
            found = self.number[shape] = len(self.rows) - 1
        return found

    def decode(self, texts: list[Words]) -> list[np.ndarray]:
        """A label for every word of every text."""
        if len(self.rows) > self.MOST_SHAPES:
            self._forget()
        number = self.number
        # Scores, text, first word, words decoded ahead of it, words that count.
        units: list[tuple[np.ndarray, int, int, int, int]] = []
        parts, lengths, owners = [], [], []
        for owner, words in enumerate(texts):
            if not words.shapes:
                continue
            ids = np.array([number[s] if s in number else self._shape(s) for s in words.shapes])
            cues = np.array(words.cues)
            parts.append((ids, cues))
            owners.append(owner)
            lengths.append(len(ids))
        paths = [np.zeros(len(w.shapes), dtype=np.int64) for w in texts]
        if not parts:
            return paths
        table = np.stack(self.rows)
        for owner, (ids, cues) in zip(owners, parts, strict=True):
            score = table[ids, 0]
            score[1:] += table[ids[:-1], 1]
            score[0] += table[0, 1]
            score[:-1] += table[ids[1:], 2]
            score[-1] += table[0, 2]
            score += self.cue_scores[0][np.concatenate([[0], cues[:-1]])]
            score += self.cue_scores[1][np.concatenate([[0, 0], cues[:-2]])[: len(cues)]]
            at = ahead = 0
            shapes = texts[owner].shapes
            while at < len(ids):
                to = min(len(ids), at + UNIT)
                most = min(len(ids), at + UNIT + RUN)
                while to < most and (b"d" in shapes[to] or b"@" in shapes[to]):
                    to += 1
                inside = to < len(ids) and (b"d" in shapes[to] or b"@" in shapes[to])
                end = min(len(ids), to + MARGIN) if inside else to
                units.append((score[at - ahead : end], owner, at, ahead, to - at))
                ahead = min(MARGIN, to - at) if inside else 0
                at = to
        units.sort(key=lambda u: -len(u[0]))
        found = self._viterbi([u[0] for u in units])
        for path, (_, owner, at, ahead, size) in zip(found, units, strict=True):
            paths[owner][at : at + size] = path[ahead : ahead + size]
        return paths

    def _viterbi(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best label paths; ``scores`` come longest first, so those still running lead."""
        sizes = np.array([len(s) for s in scores])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate(scores)
        many = flat.shape[1]
        came_from = np.zeros((len(flat), many), dtype=np.int8)
        best = flat[starts].copy()
        running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        for t in range(1, sizes[0]):
            live = running[t]
            reach = best[:live, :, None] + self.field.follow
            source = reach.argmax(axis=1)
            came_from[starts[:live] + t] = source
            best[:live] = np.take_along_axis(reach, source[:, None, :], axis=1)[:, 0]
            best[:live] += flat[starts[:live] + t]
        label = best.argmax(axis=1)
        path = np.zeros(len(flat), dtype=np.int64)
        path[starts + sizes - 1] = label
        for t in range(sizes[0] - 1, 0, -1):
            live = running[t]
            label[:live] = came_from[starts[:live] + t, label[:live]]
            path[starts[:live] + t - 1] = label[:live]
        return [path[a : a + n] for a, n in zip(starts, sizes, strict=True)]


def _holds(kind: str, span: str) -> bool:
    digits = sum(c.isdigit() and c.isascii() for c in span)
    if kind == "email":
        name, _, host = span.partition("@")
        return bool(name and host) and name[-1].isalnum() and host[0].isalnum()
    if kind == "ip":
        parts = span.split(".")
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return is_card(span)
    return 7 <= digits <= 15 and not re.search(r"[A-Za-z=@/:]", span)


def _trimmed(kind: str, raw: bytes, start: int, end: int) -> tuple[int, int]:
    before = _EDGES_BEFORE.get(kind, _EDGES)
    while start < end and raw[start] in before:
        start += 1
    while end > start and raw[end - 1] in _EDGES:
        end -= 1
    return start, end


def _part(kind: str, raw: bytes, words: list[tuple[int, int]]) -> tuple[int, int] | None:
    """Start and end of the words without edges, if they hold what the kind needs."""
    start, end = _trimmed(kind, raw, words[0][0], words[-1][1])
    return (start, end) if end > start and _holds(kind, raw[start:end].decode("utf-8", "replace")) else None


def _parts(kind: str, raw: bytes, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans of a run of words of one kind."""
    pieces, at, digits = [], 0, 0
    for i in range(1, len(words) + 1):
        digits += sum(48 <= c <= 57 for c in raw[words[i - 1][0] : words[i - 1][1]])
        ended = i == len(words) or raw[words[i - 1][1] - 1 : words[i - 1][1]] in (b",", b";")
        opens = not ended and kind == "phone" and raw[words[i][0] : words[i][0] + 1] in (b"(", b"+")
        # A complete number has at most 15 digits, so longer pieces need no look.
        complete = opens and i - at <= SPAN_WORDS and digits <= 15 and _part(kind, raw, words[at:i])
        if ended or complete:
            pieces.append(words[at:i])
            at, digits = i, 0
    found = []
    for piece in pieces:
        whole = _part(kind, raw, piece)
        several = kind == "email" and raw[piece[0][0] : piece[-1][1]].count(b"@") > 1
        cut = _split(kind, raw, piece) if several or not whole else []
        found += cut or ([whole] if whole else [])
    return found


def _split(kind: str, raw: bytes, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts that hold: the fewest words left over, then the fewest and most even parts."""
    best: list[tuple] = [((0, 0, 0), -1, None)]
    for i in range(1, len(words) + 1):
        (left, parts, uneven), _, _ = best[i - 1]
        choice = ((left + 1, parts, uneven), i - 1, None)
        digits = 0
        for j in range(i - 1, -1, -1):
            digits += sum(48 <= c <= 57 for c in raw[words[j][0] : words[j][1]])
            # A number has at most 19 digits; mails and addresses are single words.
            if digits > 19 and j < i - 1 or kind in ("email", "ip") and j < i - 1 or i - j > SPAN_WORDS:
                break
            if part := _part(kind, raw, words[j:i]):
                (left, parts, uneven), _, _ = best[j]
                choice = min(choice, ((left, parts + 1, uneven + digits**2), j, part), key=lambda c: c[0])
        best.append(choice)
    found, i = [], len(words)
    while i:
        _, j, part = best[i]
        found += [part] if part else []
        i = j
    return found[::-1]


def added_spans(raw: bytes, path: np.ndarray, base: list[tuple[int, int, str]]) -> list:
    """Decoded spans in code points that hold what their kind needs and touch no base span.

    ``base`` ascends by start. Spans are found in order, so bytes become code points in one
    pass over the text.
    """
    if not path.any():
        return []
    bounds = [m.span() for m in _WORD.finditer(raw)]
    starts, ends = [a for a, _, _ in base], list(itertools.accumulate((b for _, b, _ in base), max))
    found, at = [], 0
    read = points = 0  # bytes, and the code points they are
    while at < len(path):
        to = at + 1
        while to < len(path) and path[to] == path[at]:
            to += 1
        if path[at]:
            kind = LABELS[path[at]]
            for start, end in _parts(kind, raw, bounds[at:to]):
                first = points + len(raw[read:start].decode("utf-8", "replace"))
                last = first + len(raw[start:end].decode("utf-8", "replace"))
                read, points = end, last
                ahead = bisect.bisect_left(starts, last)
                if not ahead or ends[ahead - 1] <= first:
                    found.append((first, last, kind))
        at = to
    return found


def listed(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered)


# Texts decoded together; what numpy holds depends on this many words at once.
DECODED_WORDS = 400_000


def find(docs: DataFrame, field: Field, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: counts of base spans by kind, base_sha256 and spans."""
    counts = [f"n_{k}" for k in KINDS]
    names = [*counts, "base_sha256", "spans"]
    types = [pa.int64()] * len(counts) + [pa.string()] * 2

    def rows_of(texts: list[str], decoder: Decoder):
        raws = [t.encode("utf-8", "replace") for t in texts]
        paths = decoder.decode([words_of(r) for r in raws])
        for t, raw, path in zip(texts, raws, paths, strict=True):
            base = base_spans(t)
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            yield (
                *(sum(s[2] == k for s in base) for k in KINDS), digest,
                listed(base + added_spans(raw, path, base)),
            )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(field)
        for batch in batches:
            found: list[tuple] = []
            waiting: list[str] = []
            held = 0
            for t in batch.column("text").to_pylist():
                waiting.append(t or "")
                held += len(waiting[-1]) // 4
                if held >= DECODED_WORDS:
                    found += rows_of(waiting, decoder)
                    waiting, held = [], 0
            found += rows_of(waiting, decoder)
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    schema = "doc_id long, " + "".join(f"{c} long, " for c in counts) + "base_sha256 string, spans string"
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(scan, schema)
