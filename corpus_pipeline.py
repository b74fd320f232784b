"""A corpus pipeline: toxic documents out, copies out, then mixed and packed.

Write what a stage returns before calling the next one: each deletes the intermediate
tables of the stage before.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starweave.llm import toxicity
from starweave.llm.exact import exact_duplicates
from starweave.llm.mixing import mix_documents
from starweave.llm.near import near_duplicates
from starweave.llm.packing import pack
from starweave.llm.scratch import Scratch

TOKENIZER = "word_bpe_49k.json"


_LAST: list[Scratch] = []


def _scratch(spark: SparkSession, label: str, last: bool = False) -> Scratch:
    """The scratch folder of a stage. That of the stage before is deleted: its result has
    been written by now, as a stage reads what the one before has stored. The tables of the
    last stage stay behind its lazy result, also when another run starts."""
    while _LAST:
        _LAST.pop().close()
    scratch = Scratch(spark, label)
    if not last:
        _LAST.append(scratch)
    return scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not find toxic. Null and empty texts stay, repeated rows each
    have their own verdict; an empty table stays empty."""
    _scratch(spark, "toxicity")
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id; null counts as empty, so one such row stays.
    Repeated rows are equal texts; an empty table stays empty."""
    rest = [c for c in docs.columns if c != "text"]
    scratch = _scratch(spark, "exact")
    rows = exact_duplicates(docs, carry=rest, keep_text=True, scratch=scratch).filter("kept")
    return rows.select(*_columns(docs, "_text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the row with the lowest id. Texts without words are similar
    to equal ones only; an empty table stays empty."""
    rest = tuple(c for c in docs.columns if c != "text")
    rows = near_duplicates(docs, carry=rest, scratch=_scratch(spark, "near")).filter("kept")
    return rows.select(*_columns(docs, "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of the sources in their target weights, documents repeated or cut for it."""
    return mix_documents(docs, scratch=_scratch(spark, "mix"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences that keep to the mixture."""
    return pack(docs, public_tokenizers.path(TOKENIZER), scratch=_scratch(spark, "pack", last=True))


def _columns(docs: DataFrame, text: str) -> list[Column]:
    """Columns of the documents again, from the struct that carried them."""
    return [
        F.col(text).alias(c) if c == "text" else F.col(f"_carry.`{c}`").alias(c) for c in docs.columns
    ]


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The classifier, the samples of shingles and the draws of blocks are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
