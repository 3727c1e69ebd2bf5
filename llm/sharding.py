"""Sharding along a Hilbert curve, in DataFrame functions only.

Several metadata dimensions are quantised to ``bits`` bits each; the Hilbert index
of the cell orders the rows, so that a cut run of the curve spans a small box in
every dimension and readers can skip whole shards by any of them. Positions come
from three levels of counts (cells, hash buckets inside a cell, rows inside a
bucket). The order inside a cell is that of a hash of id and text, and a bucket is a
prefix of that hash, as long as the size of the table asks for: a cell with a third of
all rows, or a third of all rows without an id, is spread over buckets of some
``BUCKET_ROWS`` rows, and the order does not depend on their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinship.session import write_table

SHARDS = 24  # fixed value of the contract
BITS = 4
BUCKET_ROWS = 100_000  # rows of one cell that a window sorts together, about
ROW_BYTES = 8  # fixed value: added to the text bytes of every row


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of the cell with these coordinates (each below
    ``2^bits``), by the transpose form: undo the rotations from the top bit down,
    Gray-encode, interleave."""
    n = len(axes)
    point = F.array(*[a.cast("int") for a in axes])

    def undo(x: Column, step: Column) -> Column:
        q = F.call_function("shiftleft", F.lit(1), (F.lit(bits - 1) - F.floor(step / n)).cast("int"))
        i = (step % n).cast("int")
        low = q - 1
        swap = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
        return F.when(x[i].bitwiseAND(q) != 0, F.transform(x, lambda v, k: F.when(k == 0, v.bitwiseXOR(low)).otherwise(v))) \
            .otherwise(F.transform(x, lambda v, k: F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v)))

    point = F.aggregate(F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1)), point, undo)

    def interleave(x: Column) -> Column:
        gray = [x[0]]
        for k in range(1, n):
            gray.append(gray[-1].bitwiseXOR(x[k]))
        flip = F.lit(0)
        for b in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(gray[-1].bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        out = F.lit(0).cast("long")
        for b in range(bits):
            for k in range(n):
                bit = F.shiftright(gray[k].bitwiseXOR(flip), b).bitwiseAND(F.lit(1)).cast("long")
                out = out + bit * F.lit(1 << (b * n + n - 1 - k))
        return out

    # one-element transform: the rotated point is computed once, not once per bit
    return F.element_at(F.transform(F.array(point), interleave), 1)


def shard(docs: DataFrame, dims: dict[str, Column], id_col: str = "doc_id", text_col: str = "text",
          shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Cut the Hilbert order of the rows into ``shards`` runs whose counts differ by
    at most one.

    ``dims``: name -> integer column of ``docs`` below ``2^bits``; their product has
    ``2^(bits * len(dims))`` cells, which bounds the one global window. Returns one
    row per input row: ``(<id_col>, size, text_crc32, curve, shard, slot)``; ``size``
    is the text's UTF-8 bytes plus 8, ``slot`` counts from 0 without gaps in a shard.

    A null text counts as empty, a null dimension as 0. Ties on the curve order by the MD5 of
    ``id:checksum of the text`` (a null id: nothing before the colon), then id (null first),
    checksum and size. Repeated rows take one slot each. Fewer rows than shards leave shards empty; an empty table gives an
    empty result. Other columns are ignored.
    """
    if bits * len(dims) > 14:
        raise ValueError("at most 2^14 cells: use fewer dimensions or bits")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    axes = [F.least(F.greatest(F.coalesce(c.cast("int"), F.lit(0)), F.lit(0)), F.lit((1 << bits) - 1)) for c in dims.values()]
    rows = docs.select(docs[id_col].alias("_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.array(*axes).alias("_axes"))
    rows = rows.select("_id", "size", "text_crc32",
                       hilbert_index([F.col("_axes")[k] for k in range(len(axes))], bits).alias("curve"),
                       F.md5(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string"))).alias("_key"))
    rows = write_table(rows, "shard-rows")
    total, digits = rows.count(), 2
    while 16 ** digits * BUCKET_ROWS < total and digits < 6:
        digits += 1
    rows = rows.withColumn("_bucket", F.substring("_key", 1, digits))
    buckets = rows.groupBy("curve", "_bucket").agg(F.count("*").alias("n"))
    cells = buckets.groupBy("curve").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("curve", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_cell"),
                         F.sum("n").over(Window.partitionBy()).alias("_all"))
    in_cell = Window.partitionBy("curve").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (buckets.select("curve", "_bucket", F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("_off"))
               .join(cells, "curve").select("curve", "_bucket", (F.col("_off") + F.col("_cell")).alias("_off"), "_all"))
    in_bucket = Window.partitionBy("curve", "_bucket").orderBy("_key", "_id", "text_crc32", "size")
    placed = (rows.withColumn("_nth", F.row_number().over(in_bucket) - 1).join(offsets, ["curve", "_bucket"])
              .withColumn("_pos", F.col("_off") + F.col("_nth"))
              .withColumn("shard", F.expr(f"_pos * {shards} div _all")))
    first = F.expr(f"(shard * _all + {shards - 1}) div {shards}")
    return placed.select(F.col("_id").alias(id_col), "size", "text_crc32", "curve", F.col("shard").cast("int").alias("shard"),
                         (F.col("_pos") - first).alias("slot"))


def document_dims(docs: DataFrame, bits: int = BITS) -> dict[str, Column]:
    """Source, language and length of ``documents``, quantised: names by a hash
    (equal names share a bin), lengths by powers of two of their UTF-8 bytes."""
    bins = F.lit(1 << bits)
    name = lambda c: F.pmod(F.crc32(docs[c].cast("string")), bins)
    size = F.octet_length(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return {"source": name("source"), "lang": name("lang"), "length": F.floor(F.log2(size + 1) * (1 << bits) / 24)}


def write_shards(placed: DataFrame, path: str, files: int) -> None:
    """Write placed rows as one folder per shard, in slot order; a shard may take several tasks."""
    (placed.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
