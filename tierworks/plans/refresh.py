"""An ordered set of tables that refresh from each other."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.operators import changes, personal_data, quality, retract, shape
from tierworks.plans.incremental import IncrementalView
from tierworks.plans.publish import Governance, attach, publish_view, read_location, stage
from tierworks.session import delete_folder, fresh_path, shared_folder, subfolders
from tierworks.sources.sinks import write
from tierworks.streaming import bronze


@dataclass(frozen=True)
class Dataset:
    """A table, how it is computed and what is promised about it."""

    name: str
    build: Callable[[Medallion], DataFrame]
    governance: Governance
    expectations: Sequence[quality.Expectation] = ()
    key: Sequence[str] = ()
    cluster_by: Sequence[str] | str = ()  # columns, or sinks.AUTO
    feed: bool | None = None
    track: bool = False
    retain_on: str | None = None
    run_date: str | None = None
    view: IncrementalView | None = None
    source: str | None = None


def folder_version(location: str) -> int:
    """Version number in the name of a staged folder, 0 for any other folder."""
    match = re.search(r"/v([0-9]+)-[0-9a-f]{32}$", location)
    return int(match.group(1)) if match else 0


class Medallion:
    """Tables of one database below one shared folder, refreshed in the order declared.

    ``build`` functions read earlier tables with ``ref``; everything else is ordinary
    Spark. Tables are materialised once per refresh and never recomputed by readers.
    """

    def __init__(self, spark: SparkSession, database: str, root: str | None = None) -> None:
        self.spark = spark
        self.database = database
        self.root = (root or f"{shared_folder(spark)}/{database}").rstrip("/")
        self.datasets: dict[str, Dataset] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_database'")

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ref(self, name: str) -> DataFrame:
        """A table of this set, as its last refresh left it."""
        if name not in self.datasets:
            raise KeyError(f"{name} is not declared in {self.database}")
        return self.spark.table(self.table(name))

    def _declare(self, dataset: Dataset) -> None:
        layer = dataset.governance.layer
        if dataset.expectations and layer != "silver":
            raise ValueError(f"{layer} table {dataset.name}: expectations belong to silver")
        if (dataset.feed or dataset.track) and not dataset.key:
            raise ValueError(f"{dataset.name}: change feed and row tracking need a key")
        if dataset.feed is None:
            # Silver and gold tables owe a feed; without a key there can be none, and the
            # audit says so.
            dataset = replace(dataset, feed=bool(dataset.key) and layer != "bronze")
        self.datasets[dataset.name] = dataset

    def materialized(
        self,
        name: str,
        build: Callable[[Medallion], DataFrame],
        governance: Governance,
        **options,
    ) -> None:
        """Declare a table that every refresh computes anew and swaps in as a whole."""
        self._declare(Dataset(name, build, governance, **options))

    def streaming(
        self, name: str, build: Callable[[Medallion], DataFrame], governance: Governance
    ) -> None:
        """Declare an append-only table; ``build`` returns a streaming DataFrame."""
        if not governance.streaming:
            raise ValueError(f"{name}: governance must be marked as streaming")
        if governance.retention_days is not None:
            raise ValueError(f"{name}: an append-only table keeps its rows; retain downstream")
        self._declare(Dataset(name, build, governance))

    def incremental(
        self, name: str, source: str, by: Sequence[str], measures: Sequence[retract.Measure],
        governance: Governance, **settings,
    ) -> None:
        """Declare measures of ``source``, a table with a change feed, that every refresh
        brings up to date from the changes alone; readers see a catalog view."""
        if source not in self.datasets or not self.datasets[source].feed:
            raise ValueError(f"{name}: {source} has no change feed")
        if governance.layer == "gold":
            personal_data.check_gold([*by, *(m.name for m in measures)])
        view = IncrementalView(self.spark, f"{self.root}/{name}", by, measures, **settings)
        self._declare(Dataset(name, lambda t: view.read(), governance, view=view, source=source))

    def run(self, *names: str) -> list[dict]:
        """Refresh the named tables, or all, in declared order; one report per table."""
        wanted = [d for n, d in self.datasets.items() if not names or n in names]
        kinds = {True: self._stream, False: self._refresh}
        return [self._increment(d) if d.view else kinds[d.governance.streaming](d) for d in wanted]

    def _increment(self, dataset: Dataset) -> dict:
        view, source = dataset.view, dataset.source
        number = folder_version(read_location(self.spark, self.table(source)))
        feed = self.changes(source, since=view.version()) if number > view.version() else None
        counts = view.refresh(feed, self.ref(source), number) if feed is not None else {}
        publish_view(self.spark, self.table(dataset.name), view.sql(), view.read().columns, dataset.governance)
        return {"table": dataset.name, "path": view.path, "version": number, **counts}

    def _stream(self, dataset: Dataset) -> dict:
        df = dataset.build(self)
        dataset.governance.check(dataset.name, df.columns)
        path = f"{self.root}/{dataset.name}/data"
        bronze.append(df, path, f"{self.root}/{dataset.name}/checkpoint")
        attach(self.spark, self.table(dataset.name), path, df.schema, dataset.governance)
        return {"table": dataset.name, "path": path}

    def _refresh(self, dataset: Dataset) -> dict:
        table = self.table(dataset.name)
        exists = self.spark.catalog.tableExists(table)
        # The folder's name carries the version, so both change in one step.
        version = folder_version(read_location(self.spark, table)) + 1 if exists else 1
        df = dataset.build(self)
        governance = dataset.governance
        tail = shape.AUDIT_COLUMNS
        if dataset.track:
            # Tracking columns stay before the audit columns.
            df = self._tracked(dataset, df, version, exists)
            df = df.select(*[c for c in df.columns if c not in tail], *tail)
        governance.check(dataset.name, df.columns)
        if dataset.retain_on and governance.retention_days is not None:
            day = dataset.run_date or F.current_date()
            df = shape.retain(df, dataset.retain_on, governance.retention_days, day)
        path = f"{self.root}/{dataset.name}/v{version}-{uuid.uuid4().hex}"
        gold = governance.layer == "gold"
        if dataset.cluster_by:
            # Range partitioning samples its input, so it reads staged files, not the plan.
            raw = f"{self.root}/{dataset.name}/raw-{uuid.uuid4().hex}"
            counts = stage(df, raw, dataset.expectations, gold)
            staged = self.spark.read.schema(df.schema).parquet(raw)
            write(staged, path, dataset.cluster_by)
            delete_folder(self.spark, raw)
        else:
            counts = stage(df, path, dataset.expectations, gold)
        if dataset.feed:
            self._write_feed(dataset, path, df, version, exists)
        attach(self.spark, table, path, df.schema, governance, {"version": str(version)},
               bool(dataset.feed), dataset.track)
        return {"table": dataset.name, "path": path, "version": version, **counts}

    def _tracked(self, dataset: Dataset, df: DataFrame, version: int, exists: bool) -> DataFrame:
        known = exists and "row_id" in self.spark.table(self.table(dataset.name)).columns
        if not known:
            return changes.track_rows(df, dataset.key, version)
        before = self.spark.table(self.table(dataset.name))
        return changes.track_merge(before, df, dataset.key, version, shape.AUDIT_COLUMNS)

    def feed_path(self, name: str) -> str:
        return f"{self.root}/{name}/feed"

    def _write_feed(
        self, dataset: Dataset, path: str, df: DataFrame, version: int, exists: bool
    ) -> None:
        """Every row of the first version is an insert; a new layout is compared over the
        columns of both, so no change is ever left out of the feed.

        Digests of key buckets are kept with every version. Where both versions have the
        same columns, only rows of buckets whose digests differ are joined, and a refresh
        that changed nothing compares no row.
        """
        after = self.spark.read.schema(df.schema).parquet(path)
        before = self.spark.table(self.table(dataset.name)) if exists else after.limit(0)
        ignored = [*shape.AUDIT_COLUMNS, "row_version"]
        target = f"{self.feed_path(dataset.name)}/version={version}"
        buckets, known = self._digests(dataset.name, version - 1) if exists else (0, None)
        columns = lambda frame: [(f.name, f.dataType) for f in frame.schema.fields]
        rows = after.count()
        if known is None or columns(before) != columns(after) or not rows <= 4 * buckets * changes.DIGEST_ROWS:
            buckets, known = changes.buckets_for(rows), None
        folder = f"{self.root}/{dataset.name}/digests/version={version}"
        made = changes.digests(after, dataset.key, buckets, ignored)
        made.withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(folder)
        if known is None:
            before, after = changes.aligned(before, after)
        # Ids are as long as the rest of a row; those the key gives are made again behind the join.
        short = dataset.track and "row_id" not in dataset.key
        if short:
            before, after = (changes.short_ids(side, dataset.key) for side in (before, after))
        if known is None:
            feed = changes.diff(before, after, dataset.key, ignore=ignored)
        else:
            now = self.spark.read.parquet(folder).drop("buckets")
            changed = self._kept(changes.changed_buckets(known, now), "changed-buckets")
            feed = changes.diff_changed(before, after, dataset.key, changed, buckets, ignored)
        feed = changes.long_ids(feed, dataset.key) if short else feed
        # One folder per version: a refresh that died before it published is repeated
        # under the same number and replaces its part of the feed. The feed comes before
        # the table, so consumers may see a change twice after such a death, never miss one.
        feed.write.mode("overwrite").parquet(target)

    def _digests(self, name: str, version: int) -> tuple[int, DataFrame | None]:
        """The number of key buckets of a version and their digests, None where there are none."""
        folder = f"{self.root}/{name}/digests"
        if f"version={version}" not in subfolders(self.spark, folder):
            return 0, None
        found = self.spark.read.parquet(f"{folder}/version={version}")
        first = found.select("buckets").first()
        return (first["buckets"], found.drop("buckets")) if first else (0, None)

    def _kept(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def changes(self, name: str, since: int = 0) -> DataFrame:
        """All published changes of a table after version ``since``, with the columns of
        every layout it had.

        ``version`` tells refreshes apart; changes of a refresh that has not been
        published yet are left out. A column whose type changed has its last type.
        """
        path, published = self.feed_path(name), folder_version(
            read_location(self.spark, self.table(name)))
        numbers = sorted(int(n.partition("=")[2]) for n in subfolders(self.spark, path))
        found = None
        for number in (n for n in numbers if since < n <= published):
            part = self.spark.read.parquet(f"{path}/version={number}").withColumn(
                "version", F.lit(number))
            found = part if found is None else DataFrame.unionByName(*changes.aligned(found, part))
        if found is None:
            raise ValueError(f"{name} has no change feed")
        return found

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` versions of every table; returns what went.

        The folder the catalog names is never touched, however old it is.
        """
        gone = []
        for name, dataset in self.datasets.items():
            if dataset.governance.streaming or dataset.view or not self.spark.catalog.tableExists(self.table(name)):
                continue
            folder = f"{self.root}/{name}"
            live = read_location(self.spark, self.table(name)).rsplit("/", 1)[1]
            versions = sorted(
                (n for n in subfolders(self.spark, folder) if folder_version(f"/{n}")),
                key=lambda n: folder_version(f"/{n}"),
            )
            for old in versions[: max(0, len(versions) - keep)]:
                if old != live:
                    delete_folder(self.spark, f"{folder}/{old}")
                    gone.append(f"{folder}/{old}")
        return gone
