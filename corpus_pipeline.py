"""The corpus pipeline: five stages, each over everything its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each result as Parquet below the shared folder and reads it again for the next stage.
All stages but the last return the columns of ``documents``, and any others that ``docs``
has, whatever their names. An empty table stays empty in every stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.session import write_table
from llm import decontaminate as bench
from llm._spark import held
from llm.jaccard_join import keep_one
from llm.language_id import UNKNOWN, fit, has_letter, held_out, predict
from llm.mixing import mix
from llm.sharding import document_dims, shard


#: the languages that the corpus is made of; a document that reads as another one goes
LANGUAGES = ("de", "en", "es", "fr")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: Sequence[str] = LANGUAGES) -> DataFrame:
    """Keeps the documents whose whole text reads as one of the languages ``keep``; the others,
    null texts and texts without a letter go. The classifier learns every label value of the
    rows that are not held out, so a language that only a few labels name is told apart,
    too. How sure it is decides nothing, since a short or noisy text of a known language
    scores low. Where no language of ``keep`` could be learned, there is nothing to tell the
    others from, and all texts with a letter stay. Repeated rows are judged alike."""
    model = fit(docs.where(~held_out(docs["doc_id"])), "text", "lang", "doc_id")
    if model is None or not set(keep) & set(model.langs):
        return docs.where(has_letter(docs["text"]))
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than every name
    found = predict(docs, model, names=(f"{free}lang", f"{free}score"))
    return found.where(F.col(f"{free}lang").isin(*keep) & (F.col(f"{free}lang") != UNKNOWN)).drop(f"{free}lang", f"{free}score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id:
    five-word shingles, similarity 0.8 or more. Documents without words stay."""
    return keep_one(docs, width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % of the five-word shingles of a benchmark item go. Null and empty
    texts hold nothing and stay; repeated rows go or stay together."""
    return bench.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: once for every epoch of its source
    that takes all or part of it (the one document cut by a source's budget stays
    whole); documents that the mix does not take go, and so do those without words (null and
    empty texts), which count nothing. Rows with one id and one text are one document, for
    which one of them stands."""
    rows = held(docs, id=docs["doc_id"], mark=F.coalesce(F.xxhash64(docs["text"]), F.lit(0)), text=docs["text"], source=docs["source"])
    plan = mix(rows.select("id", "mark", "text", "source"), id_col="id", extra=["mark"]).groupBy("id", "mark").agg(
        F.sum(F.ceil(F.try_divide("taken", "size"))).cast("int").alias("copies")).where("copies > 0")
    plan = write_table(plan.select(F.col("id").alias("plan_id"), F.col("mark").alias("plan_mark"), "copies"), "mix-plan")
    same = F.col("id").eqNullSafe(F.col("plan_id")) & (F.col("mark") == F.col("plan_mark"))
    taken = rows.select("row", "id", "mark").dropDuplicates(["id", "mark"]).join(plan, same)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's place: 24 shards along the Hilbert curve, counts at most one apart. A null
    text counts as empty; repeated rows take one slot each."""
    return shard(docs, document_dims(docs)).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot")


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: language identification has no SQL form; tests/llm/test_pipeline.py follows every stage by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
