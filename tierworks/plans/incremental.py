"""Gold tables kept up to date from the change feed of their source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierworks.operators import retract
from tierworks.session import fresh_path
from tierworks.sources import directory as dr


class IncrementalView:
    """Measures by group, in buckets of groups below ``path``.

    A refresh reads the changes since the last one and the buckets of the groups they
    touch; it writes those buckets and a directory, whose number is the version of the
    source it stands at. Rows of the source are read again only for groups whose minimum
    or maximum went. A refresh that dies is repeated from the same changes.
    """

    def __init__(
        self, spark: SparkSession, path: str, by: Sequence[str], measures: Sequence[retract.Measure],
        bucket_rows: int = dr.BUCKET_ROWS, buckets: int = 1, keep: int = 2,
    ) -> None:
        retract.check(measures)
        self.spark, self.path = spark, path.rstrip("/")
        self.by, self.measures = list(by), list(measures)
        self.bucket_rows, self.buckets, self.keep = bucket_rows, buckets, keep

    def version(self) -> int:
        """The source version the view stands at, 0 before the first refresh."""
        return max(dr.versions(self.spark, self.path), default=0)

    def refresh(self, feed: DataFrame, source: DataFrame, number: int) -> dict[str, int]:
        """Bring the view to version ``number``.

        ``feed`` has the changes after ``version()`` up to ``number``, ``source`` the rows as
        of ``number``. Returns how many groups changed, were read again, and how many
        buckets of all were written.
        """
        at = self.version()
        if number <= at:
            return {"groups": 0, "again": 0, "buckets_written": 0, "buckets": len(self._directory(at).entries) if at else 0}
        delta = self._written(retract.state_of(feed, self.by, self.measures, retract.weight()), "delta")
        if not at:
            # The columns of the state, for a version that has no group.
            delta.limit(0).write.mode("overwrite").parquet(f"{self.path}/empty")
        before = self._directory(at) if at else dr.Directory.of_size(delta.count(), self.bucket_rows, self.buckets)
        changed = dr.touched(delta, before, self.by)
        state = dr.rows_of(self.spark, self.path, delta.schema, before, list(changed))
        rows = self._written(retract.merged(state, delta, self.by, self.measures), "merged")
        again = rows.filter("_again").count()
        if again:
            rows = retract.read_again(rows, source, self.by, self.measures)
        rewritten = list(changed) if at else list(before.entries)
        planned = {b: before.entries[b].rows + n for b, n in changed.items()}
        after = before.split(planned, self.bucket_rows)
        written = dr.write(rows.drop("_again"), self.path, number, before, after, rewritten, self.by,
                           sum(planned.values()))
        dr.forget(self.spark, self.path, number, self.keep)
        return {
            "groups": delta.count(), "again": again,
            "buckets_written": sum(e.version == number for e in written.entries.values()),
            "buckets": len(written.entries),
        }

    def read(self) -> DataFrame:
        """The measures of every group as of ``version()``."""
        at = self.version()
        if not at:
            raise ValueError(f"{self.path} was never refreshed")
        return retract.values(self._state(at), self.by, self.measures)

    def sql(self) -> str:
        """A query of the files of ``version()``, for a catalog view.

        One statement names all folders, so replacing the view swaps them at once.
        """
        found = dr.held(self.path, self._directory(self.version()))
        shown = ", ".join([*[f"`{c}`" for c in self.by], *retract.value_sql(self.measures)])
        if not found:
            return f"SELECT {shown} FROM parquet.`{self.path}/empty`"
        return " UNION ALL ".join(
            f"SELECT {shown} FROM parquet.`{f}` WHERE {dr.named(names)}" for f, names in sorted(found.items()))

    def _directory(self, number: int) -> dr.Directory:
        return dr.read(self.spark, self.path, number)

    def _state(self, number: int) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/empty").schema
        return dr.rows_of(self.spark, self.path, schema, self._directory(number))

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
