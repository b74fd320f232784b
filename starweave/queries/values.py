"""Row cleaning, conversions and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starweave.functions import has_fraction, parse_timestamp, prefix_key, trunc_int
from starweave.operators.clean import clean, distinct_rows, distinct_rows_late
from starweave.operators.surrogate import add_surrogate
from starweave.queries.roles import digest_sql, table


def distinct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return distinct_rows(events.unionAll(events))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, most of which are missing."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = labelled(spark, sf_dir)
    return clean(documents.unionAll(documents))


def trunc_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        trunc_int(price).alias("price"),
        trunc_int(-price).alias("below_zero"),
        trunc_int(price * 100000).alias("large"),
    )


def stamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+'SSSSSS")
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("text"))


def parse_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_text(spark, sf_dir).select(
        "event_id",
        parse_timestamp("text").alias("ts"),
        has_fraction("text").alias("fraction"),
        parse_timestamp(F.concat(F.col("text"), F.col("event_type"))).alias("unreadable"),
    )


def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of documents; a label is missing in most of them."""
    return labelled(spark, sf_dir).select(
        "doc_id",
        prefix_key("source", "quality", "doc_id", prefix_len=3).alias("joined"),
        prefix_key("source", "quality", "doc_id", prefix_len=3, sep="-").alias("separated"),
        prefix_key("source", "lang", prefix_len=None, sep="-").alias("whole"),
    )


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_surrogate(table(spark, sf_dir, "lineitem").select("l_orderkey"), "id")
    # Counts per id first, so that no set of ids is held in one task.
    sizes = rows.groupBy("id").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("rows"), F.count("*").alias("ids"))


def surrogate_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return add_surrogate(rows, "id", "dense")


def surrogate_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents by parts that hold separators, and nulls."""
    rows = labelled(spark, sf_dir).select("doc_id", "text", "quality", "lang")
    rows = rows.withColumn("lang", F.when(F.col("lang") != "en", F.concat("lang", F.lit("|"))))
    return add_surrogate(rows, "id", "digest", ["text", "quality", "lang", "doc_id"])


def distinct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows, some of them repeated."""
    docs = table(spark, sf_dir, "documents")
    return distinct_rows_late(docs.unionAll(docs.filter("lang = 'fr'")))


QUERIES = {
    "distinct_rows": distinct_events,
    "distinct_rows_late": distinct_documents,
    "clean_rows": clean_rows,
    "trunc_cast": trunc_cast,
    "parse_timestamp": parse_stamps,
    "composite_keys": composite_keys,
    "surrogate_key": surrogate_key,
    "surrogate_dense": surrogate_dense,
    "surrogate_digest": surrogate_digest,
}

ORACLES = {
    "distinct_rows": "SELECT * FROM events UNION SELECT * FROM events",
    "distinct_rows_late": "SELECT * FROM documents UNION SELECT * FROM documents WHERE lang = 'fr'",
    "clean_rows": """SELECT DISTINCT doc_id, text, lang, source, n_chars, quality, toxic
FROM documents JOIN labels USING (doc_id)
WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
  AND quality IS NOT NULL AND toxic IS NOT NULL""",
    "trunc_cast": """SELECT l_orderkey, l_linenumber,
  CAST(trunc(l_extendedprice) AS INTEGER) AS price,
  CAST(trunc(-l_extendedprice) AS INTEGER) AS below_zero,
  CASE WHEN trunc(l_extendedprice * 100000) <= 2147483647
    THEN CAST(trunc(l_extendedprice * 100000) AS INTEGER) END AS large
FROM lineitem""",
    "parse_timestamp": """SELECT event_id, ts, microsecond(ts) % 1000000 <> 0 AS fraction,
  CAST(NULL AS TIMESTAMP) AS unreadable FROM events""",
    "composite_keys": """SELECT doc_id,
  substring(source, 1, 3) || CAST(quality AS VARCHAR) || CAST(doc_id AS VARCHAR) AS joined,
  concat_ws('-', substring(source, 1, 3), CAST(quality AS VARCHAR), CAST(doc_id AS VARCHAR))
    AS separated,
  concat_ws('-', source, lang) AS whole
FROM documents LEFT JOIN labels USING (doc_id)""",
    "surrogate_key": "SELECT count(*) AS rows, count(*) AS ids FROM lineitem",
    "surrogate_dense": """SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber,
    l_partkey, l_suppkey) - 1 AS id,
  l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem""",
    "surrogate_digest": f"""SELECT {digest_sql('text', 'quality', 'lang', 'doc_id')} AS id,
  doc_id, text, quality, lang
FROM (SELECT doc_id, text, quality, CASE WHEN lang <> 'en' THEN lang || '|' END AS lang
  FROM documents LEFT JOIN labels USING (doc_id))""",
}
