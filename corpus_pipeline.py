"""A corpus pipeline: language, near duplicates, benchmark passages, mixture, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on all documents that the
stage before kept. ``run`` writes every stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkloom.llm.decontaminate import contamination
from sparkloom.llm.jaccard_join import jaccard_components
from sparkloom.llm.language import UNKNOWN, fit_language, predict_language
from sparkloom.llm.mixing import mix_sources, token_count
from sparkloom.llm.queries import MIX_WEIGHTS, held_out, mix_tree
from sparkloom.llm.sharding import uniform_shards
from sparkloom.llm.workspace import Workspace, text_session
from sparkloom.tables import read_table

LEAST_SCORE = 0.3     # just above chance with four languages: below it, the model can't tell


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter (null and empty ones too) and those whose language the model can't tell.

    Without a text of known language to learn from nothing can be told, and nothing stays. Repeated rows are
    judged alike; columns named like the prediction's are kept as they were.
    """
    text_session(spark)
    model = fit_language(docs, ~held_out("id"))
    return predict_language(docs, model).where(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of linked documents.

    Rows without an id come behind all ids; of rows that repeat id and text one stays. Different texts that
    share an id are different documents. Null, empty and blank texts are in no group and stay.
    """
    text_session(spark)
    order = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~"))
    named = docs.withColumn("__name", F.concat(order, F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    leaders = jaccard_components(named, id_col="__name").where("__name = component_id").select("__name").distinct()
    return named.join(leaders, "__name", "left_semi").dropDuplicates(["__name"]).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents. Null and empty texts are clean; repeated rows are judged alike."""
    found = contamination(docs, read_table(text_session(spark), sf_dir, "benchmark"))
    bad = found.where("contaminated").select("row_key").distinct()
    return (docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
            .join(bad, "row_key", "left_anti").select(docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep four fifths of all tokens, by the weights of the tree, each document once at most.

    A null language or source is a value of its own; documents without words are no tokens and go.
    """
    text_session(spark)
    return mix_sources(docs, mix_tree(), MIX_WEIGHTS, token_count(), share=(4, 5)).select(docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the documents over eight shards, with their place in it: all of them, null texts and repeats too."""
    return uniform_shards(docs, shards=8)


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("benchmark_passages", benchmark_passages), ("mixture", mixture), ("shards", shards)]

ORACLE_SQL = None     # models, random draws and iterations: tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(text_session(spark), sf_dir, "documents")
    work = Workspace(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.keep(f"{k}-{name}", stage(spark, docs, sf_dir))
        if k:
            work.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
