"""The corpus pipeline: documents through five of the operators of varve.llm, each stage written and read again.

Every stage works on what the stage before kept. The first four return the columns of their input; the last one the
tokens. Texts that a stage changes get their ``n_chars`` anew where the table has that column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.llm import bpe, secret_scan
from varve.llm.decontamination import contained_items
from varve.llm.minhash import near_duplicates
from varve.llm.quality_gam import remainder, score_quality
from varve.llm.store import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids``; rows without an id stay."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Labels that held-out scores are judged by teach nothing."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = score_quality(docs, labels, remainder("doc_id", 3) != 1)
    return without(docs, scores.where("score < 0.5"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; rows that repeat an id all stay or go."""
    return without(docs, near_duplicates(docs).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without(docs, contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced in the text."""
    spans = "_spans"
    while spans in docs.columns:
        spans += "_"
    found = secret_scan.scan(docs, secret_scan.train(docs), spans_column=spans)
    text = secret_scan.masked(F.col("text"), F.col(spans))
    changed = F.size(spans) > 0
    values = {"text": text} | ({"n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return found.select(*(values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: the packed ids of every text, and the text that they decode to."""
    out = bpe.round_trip(docs.select("doc_id", "text"), TOKENIZER)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("tokens", tokens),
]
# Learned models and a tokenizer are no SQL; tests hold run() against a version by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
