"""Small Spark helpers of the training-data operators."""

from __future__ import annotations

import os

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the largest long: a null id ranks with it inside an operator
NO_ID = (1 << 63) - 1


def ship(spark: SparkSession) -> None:
    """Let Python workers started from now on import this repository where its
    folder is visible (on a cluster without it: ``spark-submit --py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _v, _text)``: the id, with null as NO_ID, and a checksum of the text that tells
    rows with one id and different texts apart: 32 bits, -1 for a null text. Where there
    is no id, ``_v`` holds 62 bits of a hash beyond that range (-2 for a null text), so
    that such a row is never taken for one with the largest id. Other columns,
    whatever their names, play no part."""
    text = docs[text_col].cast("string")
    given = docs[id_col].cast("long")
    nameless = F.xxhash64(text).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(1 << 33))
    version = F.when(given.isNull(), F.when(text.isNull(), F.lit(-2)).otherwise(nameless)).otherwise(F.coalesce(F.crc32(text), F.lit(-1)))
    return docs.select(F.coalesce(given, F.lit(NO_ID)).alias("_id"), version.cast("long").alias("_v"), text.alias("_text"))


def public_id(key: Column, version: Column) -> Column:
    """The id of a ``keyed`` row."""
    return F.when((key != F.lit(NO_ID)) | version.between(-1, (1 << 32) - 1), key)


def held(docs: DataFrame, **extra: Column) -> DataFrame:
    """``docs`` with every row as one struct ``row`` beside the ``extra`` columns, so that names
    used inside an operator meet no column of the same name; ``row.*`` gives it back."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in extra.items()])


def pack(keyed_docs: DataFrame) -> DataFrame:
    """``(_id, _v, _z)``: texts compressed one by one, so that a shuffle of whole
    texts moves and stores a third of the bytes. A null text stays null."""

    def work(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = b.column(2)
            z = [squeeze.compress(t.as_buffer()) if t.is_valid else None for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary())], ["_id", "_v", "_z"])

    return keyed_docs.mapInArrow(work, "_id long, _v long, _z binary")


def unpack(column: pa.Array) -> list[bytes | None]:
    expand = zstandard.ZstdDecompressor()
    return [expand.decompress(z.as_buffer()) if z.is_valid else None for z in column]


def small_batches(batch: pa.RecordBatch, rows: int = 256):
    """Slices of a batch: bounds what is unpacked at once."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)
