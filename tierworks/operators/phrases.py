"""Names of several words in free text, found by a dictionary of phrases.

A dictionary is a table of phrases with a kind each. Words are runs of letters and
digits; phrases and texts are compared word by word in lower case, whatever stands
between the words. Of matches that overlap, the leftmost wins, then the longest.

A dictionary of up to ``INLINE_PHRASES`` phrases travels with the tasks and texts are
matched where they are read (``with_spans``). A larger one never does: a bit map of fixed
size, made from all of its phrases, tells which places of a text can start one, and only
these candidates meet the table in a join (``find``). Both give the same spans.

Texts are read in one pass that holds as many words as the longest phrase has. A null or
empty text has no span; empty and null phrases are ignored; of several kinds of one
phrase the smallest counts; a phrase of more than ``MOST_WORDS`` words is refused.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.functions.masking import hash_normalised
from tierworks.session import fresh_path

# What runs in tasks travels with the job, so executors need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INLINE_PHRASES = 20_000
MOST_WORDS = 32
# Bits of the map: with a million phrases one place in eight is looked up in vain.
MAP_BITS = 1 << 23
# First words whose place in the map is remembered by a task.
REMEMBERED = 200_000

SPANS = "array<struct<start:int,end:int,phrase:string,kind:string>>"

_WORD = re.compile(r"[^\W_]+")


def normalised(phrase: str | None) -> str:
    """The words of a phrase in lower case, one space between them."""
    return " ".join(_WORD.findall(phrase or "")).lower()


def _bit(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % MAP_BITS


def dictionary(phrases: DataFrame, phrase: str = "phrase", kind: str | Column | None = None) -> DataFrame:
    """(phrase, kind, n_words): every different phrase once, ready to be matched."""

    @F.pandas_udf("string")
    def clean(values: pd.Series) -> pd.Series:
        return values.map(normalised)

    named = F.lit("NAME") if kind is None else F.col(kind) if isinstance(kind, str) else kind
    rows = phrases.select(clean(F.col(phrase).cast("string")).alias("phrase"), named.alias("kind"))
    one = rows.filter("phrase <> ''").groupBy("phrase").agg(F.min("kind").alias("kind"))
    return one.withColumn("n_words", F.size(F.split("phrase", " ")))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lengths(entries: DataFrame) -> list[int]:
    """The different numbers of words, at most ``MOST_WORDS`` of them."""
    longest = entries.agg(F.max("n_words")).first()[0] or 0
    if longest > MOST_WORDS:
        raise ValueError(f"a phrase has {longest} words, {MOST_WORDS} are the most")
    return sorted(r["n_words"] for r in entries.select("n_words").distinct().collect())


def candidates(
    text: str | None, lengths: Sequence[int], starts: Callable[[str], bool], holds: Callable[[str], bool]
) -> list[tuple[int, int, int, int, str]]:
    """(word, words, start, end, phrase) of all places that may hold a phrase.

    ``starts`` tells whether a phrase may begin with a word, ``holds`` whether words may be
    a phrase; words count from 0, start and end are code points.
    """
    found, last = [], deque(maxlen=lengths[-1] if lengths else 1)
    for at, match in enumerate(_WORD.finditer(text or "")):
        word = match[0].lower()
        last.append((match.start(), word, starts(word)))
        for n in lengths:
            if n > len(last):
                break
            start, _, may = last[-n]
            if may:
                phrase = " ".join(w for _, w, _ in (last[k] for k in range(-n, 0)))
                if holds(phrase):
                    found.append((at - n + 1, n, start, match.end(), phrase))
    return found


def leftmost_longest(found: list[tuple[int, int, int, int, str]]) -> list[tuple[int, int, int, int, str]]:
    """The matches that stay, in order: none overlaps another."""
    kept, free = [], 0
    for match in sorted(found, key=lambda m: (m[0], -m[1])):
        if match[0] >= free:
            kept.append(match)
            free = match[0] + match[1]
    return kept


def _remembering(test: Callable[[str], bool]) -> Callable[[str], bool]:
    known: dict[str, bool] = {}

    def tested(word: str) -> bool:
        found = known.get(word)
        if found is None:
            if len(known) >= REMEMBERED:
                known.clear()
            found = known[word] = test(word)
        return found

    return tested


def with_spans(df: DataFrame, text: str, entries: DataFrame, out: str = "spans") -> DataFrame:
    """``df`` with its spans (start, end, phrase, kind); no row moves.

    ``entries`` comes from ``dictionary`` and has at most ``INLINE_PHRASES`` phrases.
    """
    rows = entries.limit(INLINE_PHRASES + 1).collect()
    if len(rows) > INLINE_PHRASES:
        raise ValueError(f"more than {INLINE_PHRASES} phrases; use find")
    lengths = _lengths(entries)
    kinds = {r["phrase"]: r["kind"] for r in rows}
    first = frozenset(p.partition(" ")[0] for p in kinds)

    @F.pandas_udf(SPANS)
    def matched(texts: pd.Series) -> pd.Series:
        spans = (
            leftmost_longest(candidates(t, lengths, first.__contains__, kinds.__contains__)) for t in texts
        )
        return pd.Series([
            [{"start": a, "end": b, "phrase": p, "kind": kinds[p]} for _, _, a, b, p in row] for row in spans
        ])

    return df.withColumn(out, matched(F.col(text)))


def _bit_map(entries: DataFrame) -> bytes:
    """A bit for every phrase and every first word; its size does not depend on the table."""
    both = entries.select(
        F.explode(F.array("phrase", F.split_part("phrase", F.lit(" "), F.lit(1)))).alias("text")
    )
    bit = F.crc32(F.col("text").cast("binary")) % MAP_BITS
    octets = both.select(F.floor(bit / 8).cast("int").alias("octet"), (bit % 8).cast("int").alias("bit"))
    # At most ``MAP_BITS / 8`` rows of two small numbers.
    filled = octets.groupBy("octet").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("bits"))
    bits = bytearray(MAP_BITS // 8)
    for octet, value in filled.toPandas().itertuples(index=False):
        bits[octet] = value
    return bytes(bits)


def find(df: DataFrame, text: str, entries: DataFrame, key: str) -> DataFrame:
    """(key, start, end, phrase, kind) of every span; a dictionary of any size.

    ``key`` names each text; rows that share one give their spans together.
    """
    entries = _written(entries, "phrases")
    lengths, bits = _lengths(entries), _bit_map(entries)
    shown = df.schema[key].dataType.simpleString()

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        is_set = lambda t: bool(bits[_bit(t) >> 3] >> (_bit(t) & 7) & 1)
        starts = _remembering(is_set)
        for frame in frames:
            found = [
                (k, row, *match)
                for k, row, t in zip(frame["key"], frame["row"], frame["text"], strict=True)
                for match in candidates(t, lengths, starts, is_set)
            ]
            yield pd.DataFrame(found, columns=["key", "row", "at", "n", "start", "end", "phrase"])

    narrow = df.select(
        F.col(key).cast("string").alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    places = narrow.mapInPandas(
        scan, "key string, row long, at int, n int, start int, end int, phrase string"
    )
    # Written once, so that row numbers stay and a lost executor costs no second pass.
    places = _written(places, "phrase-places").join(entries.select("phrase", "kind"), "phrase")
    if not lengths or lengths[-1] == 1:
        kept = places
    else:
        kept = _resolved(places)
    return kept.select(F.col("key").cast(shown).alias(key), "start", "end", "phrase", "kind")


def _resolved(places: DataFrame) -> DataFrame:
    """Leftmost-longest over verified places.

    Places that overlap, directly or over others, form a cluster: a window over the places
    of a text finds where clusters begin, and only clusters of several places, a few
    words long, are resolved one by one.
    """
    along = Window.partitionBy("row").orderBy("at", F.desc("n"))
    ahead = along.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.col("at") + F.col("n")).over(ahead)
    opened = F.coalesce(F.col("at") >= reach, F.lit(True)).cast("int")
    numbered = places.withColumn("opens", opened).withColumn("cluster", F.sum("opens").over(along))

    def resolve(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) == 1:
            return frame
        rows = list(zip(frame["at"], frame["n"], range(len(frame)), strict=True))
        kept, free = [], 0
        for at, n, i in sorted(rows, key=lambda r: (r[0], -r[1])):
            if at >= free:
                kept.append(i)
                free = at + n
        return frame.iloc[kept]

    columns = ["key", "row", "cluster", "at", "n", "start", "end", "phrase", "kind"]
    sized = numbered.withColumn("places", F.count(F.lit(1)).over(Window.partitionBy("row", "cluster")))
    sized = _written(sized.select(*columns, "places"), "phrase-clusters")
    single = sized.filter("places = 1").select(*columns)
    several = sized.filter("places > 1").select(*columns)
    solved = several.groupBy("row", "cluster").applyInPandas(resolve, several.schema)
    return single.unionByName(solved)


def scan(df: DataFrame, columns: Sequence[str], entries: DataFrame) -> DataFrame:
    """Rows touched and matches found per text column and kind, like ``scan_text``."""
    parts = []
    for c in columns:
        spans = with_spans(df.select(F.col(c).alias("text")), "text", entries)
        kinds = spans.select(F.transform("spans", lambda s: s["kind"]).alias("kinds"))
        counted = kinds.select(
            F.explode(F.array_distinct("kinds")).alias("pii_class"), "kinds"
        ).select("pii_class", F.size(F.filter("kinds", lambda k: k == F.col("pii_class"))).alias("n"))
        parts.append(counted.groupBy("pii_class").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("n").alias("match_count")
        ).select(F.lit(c).alias("column_name"), "pii_class", "row_count", "match_count"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets, in one pass over a text."""

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, rows: pd.Series) -> pd.Series:
        def one(value, row):
            if value is None or row is None or not len(row):
                return value
            pieces, at = [], 0
            for span in row:
                pieces += [value[at : span["start"]], f"[{span['kind']}]"]
                at = span["end"]
            return "".join([*pieces, value[at:]])

        return pd.Series([one(t, r) for t, r in zip(texts, rows, strict=True)], dtype=object)

    return replaced(text, spans)


def first_of(spans: Column, kind: str, hashed: bool = False) -> Column:
    """The first phrase of a kind, NULL where there is none; as SHA-256 if ``hashed``."""
    value = F.get(F.filter(spans, lambda s: s["kind"] == F.lit(kind)), F.lit(0))["phrase"]
    return hash_normalised(value) if hashed else value
