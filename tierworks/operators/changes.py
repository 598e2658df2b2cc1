"""Change feeds between snapshots, applying changes, and tracked rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Kinds of change-feed rows.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = (
    "insert", "update_preimage", "update_postimage", "delete",
)
CHANGE_COLUMN = "_change_type"


def diff(
    old: DataFrame, new: DataFrame, key: Sequence[str] | str, ignore: Sequence[str] = ()
) -> DataFrame:
    """Change feed that turns ``old`` into ``new``; keys must be unique.

    Columns in ``ignore`` (audit columns, say) are carried but do not make a change.

    One full outer join on the key. Rows are compared column by column, NULL-safe,
    so no hash collision can hide a change. Tables bucketed by the key
    (``sinks.write_bucketed``) are joined without a shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if old.columns != new.columns:
        raise ValueError("both snapshots need the same columns in the same order")
    before = old.select(F.struct(*old.columns).alias("_before"))
    after = new.select(F.struct(*new.columns).alias("_after"))
    # NULL-safe, so a key column may be NULL; a whole key must still be unique.
    on = [F.col(f"_before.{k}").eqNullSafe(F.col(f"_after.{k}")) for k in keys]
    both = before.join(after, on, "full_outer")
    had, has = F.col("_before").isNotNull(), F.col("_after").isNotNull()

    def line(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias(CHANGE_COLUMN), F.col(row).alias("_row"))

    compared = [c for c in new.columns if c not in ignore]
    changed = both.filter(~_same("_before", "_after", compared))
    lines = (
        F.when(had & has, F.array(line(UPDATE_BEFORE, "_before"), line(UPDATE_AFTER, "_after")))
        .when(has, F.array(line(INSERT, "_after")))
        .otherwise(F.array(line(DELETE, "_before")))
    )
    return changed.select(F.inline(lines)).select("_row.*", CHANGE_COLUMN)


DIGEST_ROWS = 1_000


def buckets_for(rows: int, rows_per_bucket: int | None = None) -> int:
    """Buckets of about ``rows_per_bucket`` keys; a power of two, so it seldom changes."""
    return 1 << (rows // (rows_per_bucket or DIGEST_ROWS)).bit_length()


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("_bucket")


def digests(df: DataFrame, key: Sequence[str] | str, buckets: int, ignore: Sequence[str] = ()) -> DataFrame:
    """(_bucket, rows, one, two): what the rows of every key bucket come to.

    One pass that combines where rows are read. ``one`` and ``two`` are independent 64-bit
    sums of row hashes, so buckets that differ agree in all three with a probability of
    about 2 ** -128. Which columns are NULL is hashed too, since a hash skips NULLs.
    """
    keys = [key] if isinstance(key, str) else list(key)
    compared = [c for c in df.columns if c not in ignore]
    values = [F.to_json(c) if t.startswith("map") else F.col(c) for c, t in df.dtypes if c in compared]
    empty = [F.col(c).isNull() for c in compared]
    return df.groupBy(key_bucket(keys, buckets)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64(F.lit(1), *values, *empty)).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(2), *empty, *values)).alias("two"),
    )


def changed_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """The key buckets (_bucket) whose digests differ or that only one side has."""
    sides = F.count(F.lit(1))
    same = (sides == 2) & (F.min("rows") == F.max("rows"))
    for c in ("one", "two"):
        same = same & (F.min(c) == F.max(c))
    return old.unionByName(new).groupBy("_bucket").agg(same.alias("same")).filter("NOT same").select("_bucket")


def diff_changed(
    old: DataFrame, new: DataFrame, key: Sequence[str] | str, changed: DataFrame, buckets: int,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """``diff`` of the rows in ``changed`` buckets alone; all others stay where they are read."""
    keys = [key] if isinstance(key, str) else list(key)

    def within(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", key_bucket(keys, buckets)).join(changed, "_bucket", "left_semi").drop("_bucket")

    return diff(within(old), within(new), keys, ignore)


def aligned(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both snapshots with the columns of either, NULL where one lacks a column.

    A column whose type changed has the new type in both; old values that cannot be
    converted become NULL.
    """
    types = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}

    def shaped(df: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in df.schema.fields}
        return df.select(*[
            F.col(c) if have.get(c) == t
            else (F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c)
            for c, t in types.items()
        ])

    return shaped(old), shaped(new)


def _same(before: str, after: str, columns: Sequence[str]) -> Column:
    """Both rows exist and agree in ``columns``, NULLs included."""
    equal = F.col(before).isNotNull() & F.col(after).isNotNull()
    for c in columns:
        equal = equal & F.col(f"{before}.{c}").eqNullSafe(F.col(f"{after}.{c}"))
    return equal


def latest(df: DataFrame, key: Sequence[str] | str, sequence: Sequence[str] | str) -> DataFrame:
    """The row with the highest ``sequence`` per key.

    An aggregate, not a window: every map task sends one row per key, so a key with
    a third of all changes costs no more than any other. Rows that tie in
    ``sequence`` are decided by their remaining columns, the same way every time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [sequence] if isinstance(sequence, str) else list(sequence)
    rest = [c for c in df.columns if c not in keys and c not in order]
    winner = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(winner).select(*keys, "_row.*").select(*df.columns)


def apply(
    target: DataFrame,
    changes: DataFrame,
    key: Sequence[str] | str,
    sequence: Sequence[str] | str,
    kind: str = CHANGE_COLUMN,
) -> DataFrame:
    """``target`` after ``changes``: the last change per key wins, deletes remove the row.

    Pre-images of updates are ignored. Target columns that the changes lack are kept.
    Where the target carries the sequence columns, changes older than its row are
    ignored.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [sequence] if isinstance(sequence, str) else list(sequence)
    effective = latest(changes.filter(F.col(kind) != UPDATE_BEFORE), keys, order)
    carried = [c for c in target.columns if c not in keys]
    incoming = effective.select(
        *keys,
        F.struct(*[c for c in carried if c in changes.columns]).alias("_new"),
        F.struct(*[F.col(c) for c in order]).alias("_order"),
        F.col(kind).alias("_kind"),
    )
    merged = target.join(incoming, keys, "full_outer")
    if all(c in carried for c in order):
        current = F.coalesce(F.struct(*[F.col(c) for c in order]) <= F.col("_order"), F.lit(False))
        unseen = F.col(order[0]).isNull()
        merged = merged.withColumn("_kind", F.when(current | unseen, F.col("_kind")))
    alive = F.col("_kind").isNull() | (F.col("_kind") != DELETE)
    values = [
        F.when(F.col("_kind").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c)
        if c in changes.columns
        else F.col(c)
        for c in carried
    ]
    return merged.filter(alive).select(*keys, *values).select(*target.columns)


def merge_state(
    state: DataFrame, changes: DataFrame, key: Sequence[str], sequence: Sequence[str], kind: str
) -> DataFrame:
    """``state`` (a target with ``_seq`` and ``_deleted``) after ``changes``.

    Deleted rows stay as tombstones with the sequence of their delete, so an older change
    that arrives in a later batch cannot bring them back. Rows without a sequence are
    older than any change.
    """
    effective = latest(changes.filter(F.col(kind) != UPDATE_BEFORE), key, sequence)
    carried = [c for c in state.columns if c not in (*key, "_seq", "_deleted")]
    incoming = effective.select(
        *key,
        F.struct(*[c for c in carried if c in changes.columns]).alias("_new"),
        F.struct(*[F.col(c) for c in sequence]).alias("_order"),
        (F.col(kind) == DELETE).alias("_gone"),
    )
    merged = state.join(incoming, list(key), "full_outer")
    newer = F.col("_order").isNotNull() & (
        F.col("_seq").isNull() | (F.col("_seq") <= F.col("_order"))
    )
    pick = lambda new, old: F.when(newer, new).otherwise(old)
    values = [
        pick(F.col(f"_new.{c}"), F.col(c)).alias(c) if c in changes.columns else F.col(c)
        for c in carried
    ]
    return merged.select(
        *key, *values,
        pick(F.col("_order"), F.col("_seq")).alias("_seq"),
        pick(F.col("_gone"), F.coalesce("_deleted", F.lit(False))).alias("_deleted"),
    ).select(*state.columns)


def replay(old: DataFrame, feed: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """``old`` brought up to date with a feed made by ``diff`` (one change per key)."""
    keys = [key] if isinstance(key, str) else list(key)
    return apply(old, feed.filter(F.col(CHANGE_COLUMN) != UPDATE_BEFORE), keys, CHANGE_COLUMN)


def track_rows(df: DataFrame, key: Sequence[str] | str, version: int = 1) -> DataFrame:
    """Add a stable ``row_id`` from the key and the version the row was written in."""
    row_id = id_of(key).alias("row_id")
    return df.select("*", row_id, F.lit(version).cast("long").alias("row_version"))


def id_of(key: Sequence[str] | str) -> Column:
    """The ``row_id`` of a key."""
    keys = [key] if isinstance(key, str) else list(key)
    identity = F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys))
    return F.sha2(identity, 256)


def short_ids(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """``df`` with a sign in place of every ``row_id`` that its key gives; ``long_ids`` undoes it."""
    own = F.col("row_id")
    return df.withColumn("row_id", F.when(own.eqNullSafe(id_of(key)), F.lit("=")).otherwise(F.concat(F.lit("!"), own)))


def long_ids(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    short = F.col("row_id")
    return df.withColumn("row_id", F.when(short == "=", id_of(key)).otherwise(F.substr(short, F.lit(2))))


def track_merge(
    tracked: DataFrame,
    new: DataFrame,
    key: Sequence[str] | str,
    version: int,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Next tracked snapshot: unchanged rows keep their version, others get ``version``."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = new.columns
    known = aligned(tracked, new)[0]
    # Only what is compared travels; ids and the other row are made behind the join.
    compared = [c for c in columns if c not in ignore and c not in keys]
    there = F.lit(True).alias("_there")
    before = known.select(
        *keys, F.struct(there, *compared).alias("_before"), F.col("row_version").alias("_version")
    )
    joined = track_rows(new.join(before, keys, "left").select(*columns, "_before", "_version"), keys, version)
    joined = joined.withColumn("_after", F.struct(there, *compared))
    same = _same("_before", "_after", compared)
    kept = F.when(same, F.col("_version")).otherwise(F.col("row_version"))
    return joined.select(*columns, "row_id", kept.alias("row_version"))
