"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies one operator, with production parameters, to the whole of its
table and returns the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.conversation_repair import damage, repair_report
from llm.decontaminate import OP10_SQL, contained_items
from llm.jaccard_join import near_duplicates
from llm.language_id import language_id
from llm.merkle import merkle_proofs, tampered
from llm.mixing import OP9_SQL, mix
from llm.oracle import OP1_SQL, OP2_SQL, OP3_SQL, OP4_SQL, OP7_SQL, OP8_SQL, OP11_SQL, OP12_SQL
from llm.pii import OP13_SQL, base_spans, count_of, find_pii, labels
from llm.pii import BASE_KINDS as PII_KINDS
from llm.secret_scan import BASE_KINDS, KINDS, secret_scan
from llm.sharding import document_dims, shard
from llm.substring_dedup import substring_dedup
from llm.suffix_dedup import suffix_dedup
from llm.topk_search import OP6_SQL, top_k
from llm.warc import warc_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    label = lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.sha2(F.array_join(F.transform(base, label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", label), ",").alias("spans"),
        F.size(F.filter("spans", lambda s: s["looks_live"])).cast("long").alias("n_live"))


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = warc_round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op6_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors["vec_id"] % 100 == 0).select("query_id", "rank", "vec_id", "score")


def op7_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    placed = shard(docs, document_dims(docs))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return merkle_proofs(docs, claims=tampered(docs))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damage(_table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


def op13_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[count_of(found["spans"], kind).alias(f"n_{kind}") for kind in PII_KINDS],
        F.sha2(labels(base_spans(found["spans"])), 256).alias("base_sha256"), labels(found["spans"]).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_warc_archives": op4_warc_archives,
    "op5_language_id": op5_language_id,
    "op6_pivot_topk": op6_pivot_topk,
    "op7_signature_tree_join": op7_signature_tree_join,
    "op8_hilbert_sharding": op8_hilbert_sharding,
    "op9_source_mixing": op9_source_mixing,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_pii_anchors": op13_pii_anchors,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_suffix_array_dedup": OP2_SQL,
    "op3_secret_scan": OP3_SQL,
    "op4_warc_archives": OP4_SQL,
    "op6_pivot_topk": OP6_SQL,
    "op7_signature_tree_join": OP7_SQL,
    "op8_hilbert_sharding": OP8_SQL,
    "op9_source_mixing": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_pii_anchors": OP13_SQL,
}
