"""A corpus through five stages: quality, near duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its result is written as
Parquet and read again. All but the last return the columns of their input, extra ones included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import bpe, decontam, quality, repeats, simhash
from jobmart.llm.common import stored, table


def _packed(docs: DataFrame) -> DataFrame:
    """id and text beside a struct of all other columns, so no column's name can clash with an operator's."""
    rest = F.struct(*[f"`{c}`" for c in docs.columns if c != "text"]).alias("row")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest)


def _unpacked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*["text" if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _changed(docs: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with another text, and its length where they have n_chars."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects short, repetitive, low-quality and toxic texts; a null text is short. The models learn from the
    labelled ones among ``docs``."""
    rows = _packed(docs)
    model = quality.fit(rows.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return _unpacked(docs, quality.judge(rows, model).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts one row stays: that of the least doc_id (null ids last), then of the least
    hash of its text. Ids need not be unique: rows are told apart by id and text, and equal rows are one."""
    own = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit("+"), "text"), F.lit("-")))
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), own.alias("key"),
                       F.col("text").cast("string").alias("text"))
    named = stored(simhash.similar(rows, doc_id="key"), "near")
    ids = rows.select("id", F.col("key").alias("doc_id")).distinct()
    first = F.min(F.struct(F.col("id").isNull(), "id", "doc_id"))["doc_id"]
    kept = named.distinct().join(ids, "doc_id").groupBy("component_id").agg(first.alias("key"))
    one = rows.select("row", "key").join(kept.select("key"), "key").dropDuplicates(["key"])
    return one.select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out all words in 35-word sequences that stand more than once; every row stays."""
    return _changed(docs, repeats.remove(_packed(docs), more_text=False), "kept")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts with a benchmark passage."""
    found = decontam.matches(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(docs, found.where(F.size("matches") == 0))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding them gives the text's bytes."""
    vocabulary = bpe.broadcast(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.encode(docs.select("doc_id", "text"), vocabulary, memory=100_000, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: SQL expresses neither the trained models nor the fingerprints; tests compare stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
