"""The registered queries of the corpus operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starweave.llm import language, licences, secrets, toxicity
from starweave.llm.exact import exact_duplicates
from starweave.llm.mixing import mix_counts
from starweave.llm.near import near_duplicates
from starweave.llm.packing import pack
from starweave.llm.pages import main_text
from starweave.llm.prefixes import prefix_trie
from starweave.llm.quality import quality
from starweave.llm.scratch import Scratch
from starweave.llm.warc import archive
from starweave.llm.whitening import whitened_components

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts by radix partitioning; the largest ``doc_id`` stays."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
    rows = exact_duplicates(docs, carry=["text_sha256"])
    return rows.select(
        "_carry.doc_id", "keep_id", "group_size", "kept", "_carry.text_sha256"
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a classifier fitted on four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("_row.doc_id", "score").select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from normalised archives."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return archive(pages).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of equal texts and its group of near duplicates.

    ``class_id`` is the lowest ``doc_id`` with that text, ``keep_id`` the document of the group
    of near duplicates that stays: it names the group.
    """
    scratch = Scratch(spark, "op3")
    rows = near_duplicates(table(spark, sf_dir, "documents"), scratch=scratch)
    rows = scratch.keep(
        rows.select("_carry.doc_id", "class", "keep_id", "group_size", "kept"), "result"
    )
    names = scratch.keep(rows.groupBy("class").agg(F.min("doc_id").alias("class_id")), "names")
    return rows.join(names, "class").select(
        "doc_id", "class_id", "keep_id", "group_size", "kept"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 1.5 times the corpus takes of every document."""
    return mix_counts(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's word counts, tokeniser fertility and verdict."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality(docs, path).select(
        "_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_entropy",
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    found = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("_row.page_id", "_row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, and weak parts that complete a credential."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "_row.doc_id",
        *(secrets.span_count(F.col("base"), k).alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, each in the mixture of the corpus."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), path)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and covered licence templates of every document."""
    scanned = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return licences.labelled(scanned).select(
        "_row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations, a row for each node."""
    nodes = prefix_trie(table(spark, sf_dir, "conversations"))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, by profiles of three fourths of the documents."""
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn(docs.filter(~language.held_out()).select("lang", "text"))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("_row.doc_id", "lang_pred", "score").select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first eight whitened components of all."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitened_components(vectors).select(
        "_row.vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened", "explained", "identity_error",
    )


LLM_QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality": op4_quality,
    "op5_main_text": op5_main_text,
    "op6_secrets": op6_secrets,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_licences": op10_licences,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_language": op12_language,
    "op13_whitening": op13_whitening,
}

# crc32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT],
            list_transform(range(1, length({0}) + 1), lambda i: ascii(substring({0}, i, 1))::BIGINT)),
        lambda crc, byte: list_reduce(
            [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))))"""

LLM_ORACLES: dict[str, str] = {
    # Every prefix is spelled out as the digests of its turns, every node's ancestors listed.
    "op11_prefix_trie": f"""
        WITH told AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT c, c - c % 5 AS base, {_CRC32.format("c::VARCHAR")} % 9 AS h
            FROM (SELECT DISTINCT c FROM told)),
        turns AS (
            SELECT v.c, 0 AS own, pos, role, text FROM convs v JOIN told t ON t.c = base WHERE pos < h
            UNION ALL
            SELECT v.c, 1 AS own, pos, role, text FROM convs v JOIN told t ON t.c = v.c WHERE pos >= h),
        placed AS (
            SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth,
                   md5(length(role) || ':' || role || text) AS turn, octet_length(encode(text)) AS bytes
            FROM turns),
        prefixes AS (
            SELECT c, 0 AS depth, '' AS path, 0 AS bytes FROM convs
            UNION ALL
            SELECT c, depth, string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth) AS path, bytes
            FROM placed),
        ends AS (
            SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
            FROM (SELECT c, max_by(path, depth) AS path FROM prefixes GROUP BY c) GROUP BY path),
        nodes AS (
            SELECT path, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes
            FROM prefixes GROUP BY path),
        children AS (
            SELECT substring(path, 1, 32 * (depth - 1)::INTEGER) AS path, count(*) AS n_children
            FROM nodes WHERE depth > 0 GROUP BY 1),
        below AS (
            SELECT substring(path, 1, 32 * k::INTEGER) AS path,
                   count(*) FILTER (n_children IS NULL) AS n_leaves,
                   sum((n_convs - 1) * bytes) AS saved_tokens
            FROM (SELECT n.*, n_children, unnest(range(0, depth + 1)) AS k
                  FROM nodes n LEFT JOIN children USING (path))
            GROUP BY 1)
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
               coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
               saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
        FROM nodes n
        JOIN below USING (path)
        LEFT JOIN children USING (path)
        LEFT JOIN ends USING (path)
        LEFT JOIN nodes p ON n.depth > 0 AND p.path = substring(n.path, 1, 32 * (n.depth - 1)::INTEGER)
    """,
    "op2_warc": """
        SELECT page_id,
               octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               refers_to
        FROM (
            SELECT page_id, html,
                   CASE WHEN octet_length(encode(coalesce(html, ''))) >= 100
                         AND page_id <> min(page_id) OVER (PARTITION BY coalesce(html, ''))
                        THEN min(page_id) OVER (PARTITION BY coalesce(html, ''))
                   END AS refers_to
            FROM pages
        )
    """,
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (
                   PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST
               ) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
