"""Publishing a staged table together with everything that documents it.

A refresh writes to a new folder and only then points the catalog at it. A refresh
that fails on the way, or breaks a ``fail`` expectation, leaves the last good table
as it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierworks.functions.naming import check_table_name
from tierworks.operators import personal_data, quality
from tierworks.operators.shape import AUDIT_COLUMNS, QUALITY_COLUMN
from tierworks.sources.sinks import quoted, same_columns

# Descriptions of the standard columns.
STANDARD_DOCS = {
    "audit_timestamp": "Pipeline execution timestamp",
    "source_system": "Upstream source system identifier",
    "data_quality_flag": "Row-level data quality status",
}
PII_SUFFIX = " - CONTAINS PII: "  # fixed value
REQUIRED_PROPERTIES = ("quality", "data_owner", "domain")  # fixed values
FORBIDDEN_PROPERTIES = ("owner",)
# Tags every table has, and how closed a table is by its highest risk.
REQUIRED_TAGS = ("quality", "domain", "pii", "data_classification")
CLASSIFICATIONS = [("CRITICAL", "restricted"), ("HIGH", "confidential"), ("MEDIUM", "confidential")]
OPEN_CLASSIFICATION = "internal"
PERSONAL_SHARE = 0.01
# Names of the properties a table's owner added, so that removed ones can be unset.
DECLARED = "declared_properties"


@dataclass(frozen=True)
class Governance:
    """What a table must say about itself."""

    layer: str
    comment: str
    data_owner: str
    domain: str
    docs: Mapping[str, str] = field(default_factory=dict)
    properties: Mapping[str, str] = field(default_factory=dict)
    tags: Mapping[str, str] = field(default_factory=dict)
    retention_days: int | None = None
    streaming: bool = False

    def check(self, table: str, columns: Sequence[str]) -> None:
        """Refuse a table that breaks a naming, column or metadata rule."""
        check_table_name(table, self.layer)
        if not self.comment.strip() or not self.data_owner or not self.domain:
            raise ValueError(f"{table} needs a comment, a data owner and a domain")
        bad = [p for p in FORBIDDEN_PROPERTIES if p in self.properties]
        if bad:
            raise ValueError(f"{table}: properties {bad} are reserved")
        if tuple(columns[-2:]) != AUDIT_COLUMNS:
            raise ValueError(f"{table} must end with {AUDIT_COLUMNS}")
        if self.layer == "silver" and QUALITY_COLUMN not in columns:
            raise ValueError(f"silver table {table} needs {QUALITY_COLUMN}")
        unknown = [c for c in self.docs if c not in columns]
        if unknown:
            raise ValueError(f"{table}: descriptions for unknown columns {unknown}")
        if self.layer == "gold":
            personal_data.check_gold(columns)

    def table_comment(self, columns: Sequence[str]) -> str:
        personal = list(personal_data.personal_columns(columns))
        return self.comment + (PII_SUFFIX + ", ".join(personal) if personal else "")

    def table_properties(
        self, columns: Sequence[str], feed: bool = False, tracked: bool = False
    ) -> dict[str, str]:
        """``feed`` and ``tracked`` say what the refresh really did, not what was wished."""
        personal = list(personal_data.personal_columns(columns))
        result = {"quality": self.layer, "data_owner": self.data_owner, "domain": self.domain}
        if personal:
            result |= {"contains_pii": "true", "pii_columns": ",".join(personal)}
        if feed:
            result["change_feed"] = "true"
        if tracked:
            result["row_tracking"] = "true"
        if self.retention_days is not None:
            result["retention_days"] = str(self.retention_days)
        result |= {f"tag.{k}": v for k, v in self.table_tags(columns).items()}
        return result | dict(self.properties)

    def table_tags(self, columns: Sequence[str]) -> dict[str, str]:
        """The required tags, made from layer, domain and columns, and the declared ones."""
        risks = {risk for _, risk in personal_data.personal_columns(columns).values()}
        closed = [label for risk, label in CLASSIFICATIONS if risk in risks]
        derived = {
            "quality": self.layer,
            "domain": self.domain,
            "pii": str(bool(risks)).lower(),
            "data_classification": [*closed, OPEN_CLASSIFICATION][0],
        }
        return derived | dict(self.tags)

    def column_docs(self, columns: Sequence[str]) -> dict[str, str]:
        """Descriptions, with the class and risk of personal columns appended."""
        result = {}
        for c in columns:
            parts = [self.docs.get(c, STANDARD_DOCS.get(c)), personal_data.annotation(c)]
            text = " ".join(p for p in parts if p)
            if text:
                result[c] = text
        return result


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())


def stage(
    df: DataFrame,
    path: str,
    expectations: Sequence[quality.Expectation] = (),
    refuse_personal: bool = False,
) -> dict[str, int]:
    """Write ``df`` to the new ``path`` and count violations in the same pass.

    With ``refuse_personal``, text that looks like personal data is counted as well and
    a column with a share of ``PERSONAL_SHARE`` or more of it stops the publication.

    Raises before anything is published if a ``fail`` expectation was broken. Counts
    come from task metrics, so a stage that runs twice may report more dropped rows
    than there are; it can not hide a violation.
    """
    seen = Observation()
    counters = [F.count("*").alias("input_rows"), *quality.violation_counts(expectations)]
    guards = personal_data.value_counters(df) if refuse_personal else {}
    counters += guards.values()
    watched = df.observe(seen, *counters)
    quality.dropped(watched, expectations).write.parquet(path)
    counts = {k: int(v) for k, v in seen.get.items()}
    hits = {g: counts.pop(g) for g in guards}
    shown = sorted(g for g, n in hits.items() if n and n >= PERSONAL_SHARE * counts["input_rows"])
    if shown:
        raise quality.ExpectationFailed(f"nothing published, personal data in {shown}")
    broken = [e.name for e in expectations if e.action == "fail" and counts[e.name]]
    if broken:
        raise quality.ExpectationFailed(f"nothing published, expectations failed: {broken}")
    return counts


def attach(
    spark: SparkSession,
    table: str,
    path: str,
    schema: StructType,
    governance: Governance,
    extra: Mapping[str, str] | None = None,
    feed: bool = False,
    tracked: bool = False,
) -> None:
    """Point ``table`` at ``path`` and write comment, properties and descriptions.

    What an earlier refresh declared and this one does not is taken off the table.
    """
    columns = schema.names
    comment = governance.table_comment(columns)
    properties = governance.table_properties(columns, feed, tracked) | dict(extra or {})
    if governance.properties:
        properties[DECLARED] = ",".join(governance.properties)
    docs = governance.column_docs(columns)
    if spark.catalog.tableExists(table) and same_columns(spark.table(table).schema, schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(path)}")
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_pairs(properties)})")
        now = {f.name: f.metadata.get("comment", "") for f in spark.table(table).schema.fields}
        ours = ("quality", "data_owner", "domain", "contains_pii", "pii_columns", "change_feed",
                "row_tracking", "retention_days")
        declared = {k for k in read_properties(spark, table) if k in ours or k.startswith("tag.")}
        declared |= set(read_properties(spark, table).get(DECLARED, "").split(",")) - {""}
        stale = ", ".join(quoted(k) for k in sorted(declared - set(properties)))
        if stale:
            spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({stale})")
        for column in now:
            text = docs.get(column, "")
            if now[column] != text:
                spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {quoted(text)}")
    else:
        # The files belong to the folder, not to the catalog entry: nothing is lost.
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        listed = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + (f" COMMENT {quoted(docs[f.name])}" if f.name in docs else "")
            for f in schema.fields
        )
        spark.sql(
            f"CREATE TABLE {table} ({listed}) USING parquet LOCATION {quoted(path)} "
            f"COMMENT {quoted(comment)} TBLPROPERTIES ({_pairs(properties)})"
        )
    spark.catalog.refreshTable(table)


def publish_view(
    spark: SparkSession, view: str, query: str, columns: Sequence[str], governance: Governance
) -> None:
    """Replace the catalog view ``view`` in one statement, with its comment and descriptions."""
    docs = governance.column_docs(columns)
    listed = ", ".join(f"`{c}`" + (f" COMMENT {quoted(docs[c])}" if c in docs else "") for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} ({listed}) COMMENT {quoted(governance.table_comment(columns))} "
        f"TBLPROPERTIES ({_pairs(governance.table_properties(columns))}) AS {query}"
    )


def read_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def read_location(spark: SparkSession, table: str) -> str:
    """The folder ``table`` points at."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")
