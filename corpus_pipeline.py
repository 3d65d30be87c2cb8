"""Corpus pipeline: the documents table through five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``. The result of a stage is written and read
again before the next one. A stage works on everything its predecessor kept.

1. toxicity: rows that the classifier rejects go.
2. near_dedup: one row of each group of near copies stays (5-word shingles,
   similarity 0.8 or more), the one with the smallest id. Rows that share an id
   go only if all of them are copies, so a copy stays where its id also has another text.
3. pii: entities and disclosing terms are replaced in the text.
4. mix: rows the mix does not take go; a row taken twice appears twice.
5. encode: ids and decoded text, as counts and digests.

Nulls, empty texts and repeated rows pass through each stage as its operator
defines; extra columns stay as they are up to the last stage, also those named like a result of an operator
(columns that start with an underscore are left out); an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.llm import bpe, mixing, neardup, pii, queries, toxicity
from linetally.llm.common import carried, table
from linetally.session import materialize


def _columns(docs: DataFrame) -> list[str]:
    """Columns that stages pass on; those that start with an underscore are the operators' own."""
    return carried(docs, ())


#: Columns that stages work on; all others pass through untouched, whatever their names.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _passing_others(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with columns other than OWN under names of their own, so that results of an operator cannot replace them."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in OWN else f"extra column {i}" for i, c in enumerate(_columns(docs))}
        inner = stage(spark, docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), sf_dir)
        return inner.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])

    return run


@_passing_others
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"))
    return scored.where(~F.col("rejected")).select(_columns(docs))


@_passing_others
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = neardup.near_duplicates(docs, neardup.Method(shingle=5, percent=80))
    # rows with different texts may share an id: it goes only with all of them, so that no text is lost
    gone = judged.groupBy("doc_id").agg(F.max("kept").alias("any_kept")).where(~F.col("any_kept")).select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti").select(_columns(docs))
    # rows repeated under one id are copies too; ids are meant to be unique, so there are few
    again = judged.where(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    # of rows that differ in other columns only, the least one stays
    others = [c for c in _columns(docs) if c not in ("doc_id", "text")]
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_row") if others else F.lit(None).alias("_row")
    repeated = kept.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(least)
    repeated = repeated.select(*[F.col(f"_row.`{c}`").alias(c) if c in others else F.col(c) for c in _columns(docs)])
    return kept.join(again, "doc_id", "left_anti").select(_columns(docs)).unionByName(repeated)


@_passing_others
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitise_texts(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(_columns(docs))


@_passing_others
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs)
    times = F.when(F.col("taken") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    each = mixed.withColumn("_times", times).where(F.col("_times") > 0)
    return each.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(_columns(docs))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(docs, queries.bpe_path(), ids=False, digests=True, columns=["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

#: A trained classifier and an encoder are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
