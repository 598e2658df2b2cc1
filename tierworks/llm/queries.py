"""The corpus operators over the shared test tables, with the SQL that proves them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.llm import (
    ann, exact_dedup, langid, licenses, merkle, mixing, negatives, packing, pii, quality, simhash,
    toxicity, urls,
)
from tierworks.llm.common import word_count


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_read(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.rule_table(spark, urls.production_rules())
    return urls.judged(_read(spark, sf_dir, "pages"), rules)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_read(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of one text are a duplicate cluster."""
    items = _read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"), word_count().alias("size"), "source",
        exact_dedup.digest().alias("cluster"),
    )
    return packing.pack(items)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.clean(_read(spark, sf_dir, "embeddings"))
    return ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"))


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(simhash.fingerprints(_read(spark, sf_dir, "documents")))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"), pii.fit(pii.labelled_rows()))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, _read(spark, sf_dir, "labels")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is wrong by one, every fiftieth row is an anchor."""
    label = F.col("label").cast("long")
    wrong = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = negatives.prepared(_read(spark, sf_dir, "embeddings"), wrong)
    return negatives.mine(vectors, vectors.filter("vec_id % 50 = 0"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_license_scan, op3_url_filter, op4_source_mix, op5_best_fit_packing,
        op6_quality_classifier, op7_language_id, op8_nearest_vectors, op9_simhash_components,
        op10_personal_data, op11_toxicity, op12_merkle_manifest, op13_hard_negatives,
    )
}

_SPACE = r"[\x20\x09-\x0D]"

_BASE_RULES = ", ".join(
    f"('{n}', '{n.partition('/')[0]}', '/{n.partition('/')[2]}', '{v}')" for n, v in urls.BASE_RULES
)
_PATTERNS = ", ".join(
    [rf"('site:{w}', '^([^/]*[.-])?{w}([.-]|/|\z)')" for w in urls.BLOCKED_WORDS + urls.BLOCKED_PHRASES]
    + [rf"('page:{w}', '/{w}(/|[.]|\z)')" for w in urls.BLOCKED_PAGES]
    + [rf"('file:{w}', '[.]{w}\z')" for w in urls.BLOCKED_FILES]
    + [f"('folder:{w}', '/{w}/')" for w in urls.BLOCKED_FOLDERS]
    + [f"('listing:{w}', '/{w}/[^/]*/page/')" for w in urls.BLOCKED_LISTINGS]
)


def _merkle_field(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _merkle_levels(prefix: str, key: str, levels: int) -> str:
    """Nodes ``{prefix}0`` (key, idx, node, n) up to one a key, and the siblings of each level."""
    steps = []
    for k in range(levels):
        run = f"PARTITION BY {key}, idx // 16 ORDER BY idx ROWS BETWEEN"
        steps.append(f"""{prefix}s{k} AS (SELECT {key}, idx, n,
            CASE WHEN n > 1 THEN coalesce(string_agg(node, '') OVER (
                {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
            CASE WHEN n > 1 THEN coalesce(string_agg(node, '') OVER (
                {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r FROM {prefix}{k})""")
        steps.append(f"""{prefix}{k + 1} AS (SELECT {key}, idx // 16 AS idx, (n + 15) // 16 AS n,
            CASE WHEN n > 1 THEN sha256(string_agg(node, '' ORDER BY idx)) ELSE any_value(node) END AS node
            FROM {prefix}{k} GROUP BY {key}, idx // 16, n)""")
    return ",\n".join(steps)


#: Enough for 16 ** 6 rows a source and 16 ** 3 sources.
_LEAF_LEVELS, _SOURCE_LEVELS = 6, 3


def _merkle_folds() -> str:
    """One step a level: the siblings join the proof, and the node is folded with them."""
    steps, last = [], "f"
    for prefix, key, levels in (("t", "tree", _LEAF_LEVELS), ("u", "one", _SOURCE_LEVELS)):
        place = "idx" if prefix == "t" else "source_idx"
        for k in range(levels):
            name = f"f{prefix}{k}"
            steps.append(f"""{name} AS (SELECT p.* REPLACE (p.proof || s.l || s.r AS proof,
                CASE WHEN s.n > 1 THEN sha256(s.l || p.node || s.r) ELSE p.node END AS node)
                FROM {last} p JOIN {prefix}s{k} s ON p.{key} = s.{key} AND p.{place} // {16**k} = s.idx)""")
            last = name
    return ",\n".join(steps)


_MERKLE = f"""
    WITH d AS (
        SELECT doc_id, coalesce(':' || source, '-') AS tree,
               {_merkle_field('doc_id')} || {_merkle_field('source')} || {_merkle_field('lang')}
               || {_merkle_field('n_chars')} AS ahead, {_merkle_field('text')} AS whole,
               {_merkle_field('text', f"translate(text, '{urls.UPPER}', '{urls.LOWER}')")} AS lower,
               list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)),
                   lambda crc, b: list_reduce([xor(crc, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
                       lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
        FROM documents),
    e AS (SELECT doc_id, tree, xor(crc, 4294967295) % 5 = 0 AS tampered, sha256(ahead || whole) AS leaf,
                 CASE WHEN tampered THEN sha256(ahead || lower) ELSE leaf END AS folded FROM d),
    g AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                 count(*) OVER (PARTITION BY tree) AS n FROM e),
    t0 AS (SELECT tree, idx, leaf AS node, n FROM g),
    {_merkle_levels('t', 'tree', _LEAF_LEVELS)},
    v AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS source_idx,
                 count(*) OVER () AS n FROM t{_LEAF_LEVELS}),
    u0 AS (SELECT 1 AS one, source_idx AS idx, subroot AS node, n FROM v),
    {_merkle_levels('u', 'one', _SOURCE_LEVELS)},
    f AS (SELECT doc_id, g.tree, g.idx, source_idx, 1 AS one, leaf, subroot, tampered, folded AS node, '' AS proof
          FROM g JOIN v USING (tree)),
    {_merkle_folds()}
    SELECT doc_id, leaf, subroot, top.node AS root, sha256(proof) AS proof_sha256,
           last.node AS folded_root, last.node = top.node AS verified, tampered
    FROM fu{_SOURCE_LEVELS - 1} last JOIN u{_SOURCE_LEVELS} top ON true"""


#: Operators that learn, search approximately or hash with XXH64 have no SQL twin; they
#: are tested against plain Python.
ORACLE: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               first_value(doc_id) OVER best = doc_id AS kept, text_sha256
        FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""",
    "op3_url_filter": f"""
        WITH r(name, host, path, verdict) AS (VALUES {_BASE_RULES}),
        m(name, pattern) AS (VALUES {_PATTERNS}),
        u AS (SELECT page_id, CASE WHEN contains(url, '://')
                     THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        p AS (SELECT page_id,
                     translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        b AS (SELECT page_id, arg_max(name, length(name)) AS rule,
                     arg_max(verdict, length(name)) AS verdict
              FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
                           AND starts_with(p.path, r.path) GROUP BY page_id),
        q AS (SELECT page_id, first(name ORDER BY length(name) DESC, name) AS name
              FROM p JOIN m ON regexp_matches(host || path, pattern) GROUP BY page_id)
        SELECT p.page_id, host, path, rule,
               coalesce(verdict, CASE WHEN q.name IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
               CASE WHEN rule IS NULL THEN q.name END AS pattern_rule
        FROM p LEFT JOIN b USING (page_id) LEFT JOIN q USING (page_id)""",
    "op12_merkle_manifest": _MERKLE,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                     CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3""",
    "op4_source_mix": f"""
        WITH d AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   CAST('0x' || substr(md5('mix' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS key
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                     [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]
                     AS weight FROM d GROUP BY source),
        l AS (SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(3 * source_size) OVER full_ones AS BIGINT), 0))
                     / (CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER full_ones AS BIGINT), 0)) AS level
              FROM s WINDOW full_ones AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT *, (SELECT level FROM l WHERE weight * level <= 3 * source_size
                         ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1) AS final FROM l),
        w AS (SELECT source, source_size, CASE WHEN weight * final > 3 * source_size
                     THEN CAST(3 * source_size AS DOUBLE) ELSE weight * final END AS target FROM t),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size
                     ELSE 0 END AS epochs FROM w),
        c AS (SELECT d.*, source_size, target, epochs,
                     CAST(floor(target) AS BIGINT) - epochs * source_size
                     - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
              FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, source, size, source_size, target,
               CAST(size * epochs + greatest(0, least(size, room)) AS BIGINT) AS taken FROM c""",
}
