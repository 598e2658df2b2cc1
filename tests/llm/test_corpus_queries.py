"""The registered corpus queries over the small tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from tierworks.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are missing")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=key) == sorted(
        cursor.fetchall(), key=key)


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark):
    """Each stage against what it has to keep, over what its predecessor kept."""
    from tierworks.llm.common import staged

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = staged(stage(spark, docs, SF_DIR), f"test-{name}")
        after = docs.collect()
        seen.append(name)
        if name == "quality_classifier":
            ids = {r["doc_id"] for r in after}
            wrong = [i for i, q in labels.items() if (i in ids) != bool(q)]
            assert len(wrong) <= 0.03 * len(labels)
        elif name == "exact_dedup":
            strip = lambda t: "".join((t or "").split())
            assert len({strip(r["text"]) for r in after}) == len(after)
            assert {strip(r["text"]) for r in after} == {strip(r["text"]) for r in before}
        elif name == "simhash_near_dedup":
            from test_corpus_operators import brute_components, brute_print
            groups = brute_components({r["doc_id"]: brute_print(r["text"]) for r in before})
            assert {r["doc_id"] for r in after} == set(groups.values())
        elif name == "source_mix":
            kept = {tuple(r) for r in before}
            assert all(tuple(r) in kept for r in after)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
        else:
            words = sum(len((r["text"] or "").split()) for r in before)
            assert sum(r["length"] for r in after) == words
    assert seen == [n for n, _ in corpus_pipeline.STAGES]
