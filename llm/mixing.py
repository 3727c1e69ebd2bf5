"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key. Within each source, documents are ranged
by key into ``2^(4 * KEY_DIGITS)`` buckets; bucket totals give each bucket's offset
and a running sum inside a bucket finishes the distributed prefix sum of token
counts. Each source is cut at its exact budget, after as many whole epochs as the
budget holds. No task ever holds a source: the largest window group is one bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinship.session import write_table

# Fixed values of the contract.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"

SEED = "mix-1"
KEY_DIGITS = 3  # hex digits of the key that name a bucket: 4096 buckets a source


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes``: (_none, _src, source_size), one row per source. Adds ``target``:
    ``share`` of all sizes split by weight (weights repeat over the sources in code
    point order, null last), where no target exceeds ``max_epochs`` times its source
    and the excess goes to the others by weight. The table has a row per source, so
    its global windows stay small."""
    cap, w = max_epochs * F.col("source_size"), F.col("w")
    by_name = Window.orderBy("_none", "_src")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                                 (F.col("rank") % len(weights) + 1).cast("int")))
    # water filling: sources fill up in the order of cap / weight
    order = Window.orderBy(cap / w, "rank")
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(w).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    ranked = ranked.withColumn("level", (share * F.sum("source_size").over(everything) - before) / rest)
    ranked = ranked.withColumn("full", F.col("level") * w >= cap)
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return ranked.select("_none", "_src", "source_size",
                         F.when(F.col("full"), cap.cast("double")).otherwise(level * w).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
        extra: list[str] | None = None) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per input row: ``(<id_col>, <source_col>, size, source_size,
    target, taken)``, and the ``extra`` columns. ``size`` counts words (null text: 0). A document is taken whole
    in every full epoch of its source; the last, partial epoch runs in key order and
    stops at the exact word, so one document per source may be taken in part. The
    taken words of a source differ from its target by less than one. A null source
    is a source of its own; documents without words take none. Rows with one id share
    a key and order by size and text. Deterministic: reruns agree. An empty table
    gives an empty result.
    """
    src = docs[source_col].cast("string")
    kept = F.struct(*[docs[c] for c in extra or ()]).alias("_extra") if extra else F.lit(0).alias("_extra")
    text = docs[text_col].cast("string")
    rows = docs.select(
        kept, docs[id_col].alias("_id"), src.isNull().alias("_none"), F.coalesce(src, F.lit("")).alias("_src"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(-1)).alias("_crc"),
        F.md5(F.concat_ws(":", F.lit(seed), docs[id_col].cast("string"))).alias("_key"))
    rows = write_table(rows.withColumn("_bucket", F.substring("_key", 1, KEY_DIGITS)), "mix-sizes")

    buckets = rows.groupBy("_none", "_src", "_bucket").agg(F.sum("size").alias("_in"))
    sources = buckets.groupBy("_none", "_src").agg(F.sum("_in").alias("source_size"))
    targets = source_targets(sources, weights, share, max_epochs)
    earlier = Window.partitionBy("_none", "_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (buckets.select("_none", "_src", "_bucket", F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_off"))
               .join(targets, ["_none", "_src"]))
    inside = (Window.partitionBy("_none", "_src", "_bucket").orderBy("_key", "size", "_crc")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("_upto", F.sum("size").over(inside)).join(offsets, ["_none", "_src", "_bucket"])
              .withColumn("_before", F.col("_off") + F.col("_upto") - F.col("size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.floor(F.col("target") - epochs * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("_before")))
    return placed.select(
        F.col("_id").alias(id_col), F.when(~F.col("_none"), F.col("_src")).alias(source_col), "size", "source_size",
        "target", (epochs * F.col("size") + part).cast("long").alias("taken"),
        *[F.col("_extra")[c].alias(c) for c in extra or ()])


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || doc_id::VARCHAR) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             row_number() OVER (ORDER BY source NULLS LAST) AS rk
      FROM d GROUP BY source),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (
                   ORDER BY 2 * source_size / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY 2 * source_size / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM s),
t AS (SELECT source, source_size, CASE WHEN level * w >= 2 * source_size THEN (2 * source_size)::DOUBLE
        ELSE w * max(CASE WHEN level * w < 2 * source_size THEN level END) OVER () END AS target FROM f),
c AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS e,
             sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (e * size + greatest(0, least(size, floor(target - e * source_size) - before)))::BIGINT AS taken
FROM c
"""
