"""From raw documents to packed sequences: the stages of the training-data pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import decontaminate, exact_dedup, jaccard, language, packing
from gleanspark.llm.tables import materialize, pick
from gleanspark.session import checkpoint_dir, configure, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepare(spark: SparkSession) -> None:
    ship_package(configure(spark))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but those of ``ids``; rows without id stay."""
    gone = materialize(ids.where("doc_id is not null").distinct())
    return pick(docs, gone, how="left_anti")


def identify_language(
    spark: SparkSession, docs: DataFrame, sf_dir: str, languages: Collection[str] | None = None, min_score: float = 0.0
) -> DataFrame:
    """Documents stay whose text can be in a language, and get the predicted one as ``lang`` where theirs is null.

    Without a letter or a text a document goes, whatever was learned. With
    ``languages`` those go that are predicted to be in another one, and with
    ``min_score`` those whose language is less sure; by default none does. No rows
    give no rows.
    """
    _prepare(spark)
    found = language.identify(docs, carry=True).where("not no_letters")
    if languages is not None:
        found = found.where(F.col("lang_pred").isin(*languages))
    found = found.where(F.col("score") >= min_score)
    lang = F.coalesce("row.lang", F.nullif("lang_pred", F.lit(language.UNDETERMINED))).cast(docs.schema["lang"].dataType)
    return found.select(*[lang.alias("lang") if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays, and of rows that repeat it one; rows without id stay."""
    _prepare(spark)
    dropped = exact_dedup.exact_groups(docs).where("not kept")
    kept = _without(docs, dropped.select("doc_id"))
    # Only rows of repeated ids are moved to be told apart.
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    repeated = materialize(repeated.select("doc_id"))
    return pick(kept, repeated, how="left_anti").unionByName(pick(kept, repeated).dropDuplicates(["doc_id"]))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    _prepare(spark)
    return _without(docs, jaccard.similar_sets(docs).where("doc_id <> component_id").select("doc_id"))


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    _prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.benchmark_hits(docs, benchmark).where("contaminated").select("doc_id"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    _prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", remove_exact_copies),
    ("ngram_jaccard_join", remove_near_copies),
    ("benchmark_decontamination", remove_benchmark_text),
    ("best_fit_packing", pack_sequences),
]

#: Token ids and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    _prepare(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
