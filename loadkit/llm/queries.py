"""One query for each operator over its whole table, with DuckDB SQL where SQL can state the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm import bpe, chunks, ledger, licenses, merkle, mixing, neighbours, pii, quality, resample, simhash, statements, topk, url_filter
from loadkit.llm.common import ascii_lower, prepare, table
from loadkit.session import scratch_dir, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


# Rules of the policy.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
# The list: canonical URLs of pages on hosts with one of these words.
LISTED_HOSTS = r"casino|pills|bets|ads-track"

_SQL_HOST = "coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"


@query("op1_url_filter", f"""
WITH parts AS (
    SELECT page_id, {_SQL_HOST} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
            lambda p: p <> '' AND NOT starts_with(p, 'utm_') AND string_split(p, '=')[1] NOT IN ('ref', 'fbclid', 'gclid'))), '&') AS named
    FROM pages
), named AS (
    SELECT page_id, host, path, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
        || CASE WHEN named <> '' THEN '?' || named ELSE '' END END AS canonical
    FROM parts
), listed AS (
    SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '{LISTED_HOSTS}') AND canonical IS NOT NULL
), rules(verdict, rule, name, rest) AS (
    VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
        ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), judged AS (
    SELECT n.*, n.canonical IN (SELECT canonical FROM listed) IS TRUE AS listed,
        (SELECT arg_max(r, length(r.rule)) FROM rules r WHERE (n.host = r.name OR ends_with(n.host, '.' || r.name)) AND starts_with(n.path, r.rest)) AS r
    FROM named n
)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM judged""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select(url_filter.canonical(F.col("url")))
    return url_filter.judge(pages, listed, RULES)


@query("op2_exact_topk", """
WITH good AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM good q JOIN good c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20""")
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    vectors = stage(given.select("vec_id", topk.integers(F.col("embedding"), 64).alias("vector")), "topk-vectors")
    return topk.search(vectors.filter(F.col("vec_id") % 20 == 0), vectors, 20)


@query("op10_mix_sources", """
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size, md5('mix:' || doc_id) AS ticket FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place,
        CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
        coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
        sum(weight) OVER (ORDER BY 2 * source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from
    FROM sources
), capped AS (
    SELECT *, CAST(cap * weight_from AS DOUBLE) < (budget - CAST(cap_before AS DOUBLE)) * weight AS is_full FROM ordered
), goals AS (
    SELECT source, source_size, place, budget, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE weight
        * (budget - CAST(coalesce(sum(cap) FILTER (is_full) OVER (), 0) AS DOUBLE)) / CAST(sum(weight) FILTER (NOT is_full) OVER () AS DOUBLE) END AS target
    FROM capped
), queued AS (
    SELECT d.*, g.source_size, g.place, g.budget, g.target,
        sum(size) OVER (PARTITION BY g.place ORDER BY ticket, doc_id, size ROWS UNBOUNDED PRECEDING) AS through, row_number() OVER () AS item
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
), copies AS (
    SELECT item, size, place, budget, CAST(source_size * turn + through AS DOUBLE) / target AS finish FROM queued, (VALUES (0), (1)) turns(turn) WHERE size > 0
), merged AS (
    SELECT *, sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS total FROM copies
), taken AS (
    SELECT item, count(*) AS n FROM merged WHERE total <= budget GROUP BY item
)
SELECT doc_id, source, size, source_size, target, CAST(coalesce(n, 0) AS INTEGER) AS copies, CAST(size * coalesce(n, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (item)""")
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.Mix()
    measured = stage(mixing.measure(table(spark, sf_dir, "documents"), mix), "mix-sizes")
    return mixing.mix_sources(measured, mix)


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return decoded.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels"))))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def _joined(spans: str):
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    counts = [F.size(F.filter("base", _is_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.passages(table(spark, sf_dir, "documents")).drop("mark")


@query("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(neighbours.build(given), given.filter(F.col("vec_id") % 20 == 0), 20)


@query("op11_secrets", statements.secrets())
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.scan(table(spark, sf_dir, "documents"), f"{scratch_dir(spark)}/ledger-{uuid.uuid4().hex}")
    kinds = [r.kind for r in ledger.BASE]
    base = F.filter("found", lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.filter("found", _is_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined("found").alias("spans"))


@query("op12_resample", statements.resampled())
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_manifest", statements.manifest())
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    given = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.digest_of([*given, F.col("text")])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    probe = F.when(tampered, merkle.digest_of([*given, ascii_lower(F.col("text"))])).otherwise(leaf)
    found = merkle.manifest(docs.select("doc_id", "source", leaf.alias("leaf"), probe.alias("probe")), "source", ["doc_id"], ["doc_id", "probe"])
    folded = found.withColumn("proof_sha256", F.sha2(merkle.siblings("proof"), 256)).withColumn("folded_root", merkle.fold(F.col("probe"), "proof"))
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
