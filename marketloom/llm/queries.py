"""Queries over the given tables, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.bpe import encode_digests
from marketloom.llm.chaining import repeated_passages
from marketloom.llm.concat import concatenate_and_cut
from marketloom.llm.exact_dedup import exact_dedup
from marketloom.llm.html_text import extract
from marketloom.llm.language import identify
from marketloom.llm.manifest import tamper_check
from marketloom.llm.packing import pack_documents
from marketloom.llm.simhash import near_duplicates
from marketloom.llm.topk import top_k
from marketloom.llm.urlfilter import judge_urls
from marketloom.llm.warc import archived_pages
from marketloom.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The public tokenizer files of the queries; every worker has it.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_warc_revisits")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


@query("op2_best_two_fit")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), PIECE_BPE)


@query(
    "op4_url_filter",
    """
    WITH split AS (
        SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS sep FROM pages
    ), parts AS (
        SELECT page_id,
               CASE WHEN sep > 0 THEN translate(regexp_extract(substr(url, sep + 3), '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
               CASE WHEN sep > 0 THEN regexp_extract(substr(url, sep + 3), '^[^/?#]*([^?#]*)', 1)
                   ELSE '' END AS path
        FROM split
    ), rules(verdict, rule_host, prefix) AS (
        VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
               ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
    ), fitting AS (
        SELECT p.page_id, p.host, p.path, rule_host || prefix AS rule, verdict,
               row_number() OVER (PARTITION BY p.page_id ORDER BY length(rule_host || prefix) DESC) AS place
        FROM parts p LEFT JOIN rules
          ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, prefix)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM fitting WHERE place = 1
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query(
    "op5_top_k",
    """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
               vec_id, score
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query(
    "op7_exact_dedup",
    r"""
    WITH normal AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
        FROM documents
    )
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM normal WINDOW same AS (PARTITION BY norm)
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op8_repeated_passages")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), WORD_BPE)


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_concatenate_and_cut")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = concatenate_and_cut(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


#: Unsigned crc32 of a decimal id: a step per byte and eight shifts after each.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))"""


def _leaf_sql(text: str) -> str:
    """SQL of a row's digest with ``text`` in the place of its text."""
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"coalesce(octet_length(encode({f}))::VARCHAR || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


@query(
    "op13_merkle_manifest",
    f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
               CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE leaf END AS given,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx,
               count(*) OVER (PARTITION BY source) AS n
        FROM documents
    ), nodes AS (
        SELECT source, 0 AS lvl, idx, leaf AS digest, n FROM leaves
        UNION ALL
        SELECT source, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), max((n + 2) // 3)
        FROM nodes WHERE n > 1 GROUP BY source, lvl, idx // 3
    ), subroots AS (
        SELECT source, digest AS subroot, lvl AS depth,
               row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
        FROM nodes WHERE n = 1
    ), tops AS (
        SELECT 0 AS lvl, place AS idx, subroot AS digest, n FROM subroots
        UNION ALL
        SELECT lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), max((n + 2) // 3)
        FROM tops WHERE n > 1 GROUP BY lvl, idx // 3
    ), steps AS (
        SELECT l.doc_id, x.lvl AS step, x.idx, l.idx // (3 ** x.lvl)::BIGINT AS own, x.digest
        FROM leaves l JOIN nodes x
          ON l.source IS NOT DISTINCT FROM x.source AND x.n > 1
         AND l.idx // (3 ** (x.lvl + 1))::BIGINT = x.idx // 3
        UNION ALL
        SELECT l.doc_id, r.depth + x.lvl, x.idx, r.place // (3 ** x.lvl)::BIGINT, x.digest
        FROM leaves l JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source
        JOIN tops x ON x.n > 1 AND r.place // (3 ** (x.lvl + 1))::BIGINT = x.idx // 3
    ), sides AS (
        SELECT doc_id, step, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS before,
               coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS after
        FROM steps GROUP BY doc_id, step
    ), proofs AS (
        SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256, count(*) AS n_steps
        FROM sides GROUP BY doc_id
    ), folded AS (
        SELECT doc_id, 0 AS step, given AS digest FROM leaves
        UNION ALL
        SELECT f.doc_id, f.step + 1, sha256(s.before || f.digest || s.after)
        FROM folded f JOIN sides s ON f.doc_id = s.doc_id AND f.step = s.step
    )
    SELECT l.doc_id, l.leaf, r.subroot, t.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
           f.digest AS folded_root, f.digest = t.digest AS verified
    FROM leaves l JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source
    CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
    LEFT JOIN proofs p ON l.doc_id = p.doc_id
    JOIN folded f ON l.doc_id = f.doc_id AND f.step = coalesce(p.n_steps, 0)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tamper_check(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0)
