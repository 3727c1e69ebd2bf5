"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is the set of its word shingles (``WIDTH`` words; a shorter item is one
shingle of its own width). Items are partitioned by set size (powers of two). The
MinHash sketch of an item is its ``n - ceil(t * n) + 1`` smallest shingle hashes:
a document that holds a share of at least ``t`` of the item holds at least one of
them, so no match is lost. Each document looks its shingles up in the sketch index
of every size partition that its own size allows, and each candidate is verified by
exact containment of the whole item in the same pass, with no shuffle of documents.

The index of a benchmark of at most ``BLOCK_SHINGLES`` shingles goes to the workers as
one broadcast. A larger one stays in tables: the documents' shingles that pass a filter
of ``FILTER_WORDS`` words (a bit for every sketch hash, the same size for every benchmark)
meet the sketches of the size partitions that the document's size allows in a join, and
only the candidate documents are read again, to be counted exactly in a second join.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.session import write_table
from llm._spark import held, ship
from llm._symbols import U64, Words, blocks

WIDTH = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 4_000_000  # 32 MB of hashes
FILTER_WORDS = 1 << 20  # 8 MB


def _row_shingles(words: Words, width: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words inside a row, rows in order."""
    counts = np.diff(words.offsets)
    hashes = words.windows(width) ^ U64(salt)
    row = np.repeat(np.arange(len(counts)), counts)[:len(hashes)]
    ok = np.arange(len(hashes)) + width <= words.offsets[1:][row]
    return row[ok], hashes[ok]


def _distinct(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash): the distinct shingles of every row, ascending."""
    row, h = _row_shingles(words, width, width)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[fresh], h[fresh]


def _item_sets(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def work(batches):
        for b in batches:
            ids, out = b.column(0).to_numpy(zero_copy_only=False), []
            for block in blocks(b.column(1)):
                words = Words(block, lower=True)
                counts = np.diff(words.offsets)
                for w in np.unique(np.minimum(counts, width)):
                    if w:
                        row, h = _row_shingles(words, int(w), int(w))
                        for i in np.flatnonzero(np.minimum(counts, width) == w):
                            lo, hi = np.searchsorted(row, [i, i + 1])
                            out.append((ids[block.rows][i], int(w), np.unique(h[lo:hi]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.list_(pa.int64()))], ["item", "width", "shingles"])

    rows = items.select(items[id_col].cast("long"), items[text_col].cast("string")).where(items[id_col].isNotNull())
    return rows.mapInArrow(work, "item long, width int, shingles array<long>")


class _Index:
    """The items: per size partition, the sorted sketch hashes and their items."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]], threshold: float):
        self.items = [r[0] for r in rows]
        self.widths = sorted({r[1] for r in rows})
        self.sets = [np.sort(np.array(r[2], np.int64).view(U64)) for r in rows]
        self.need = np.array([max(1, math.ceil(threshold * len(s) - 1e-9)) for s in self.sets])
        parts: dict[tuple[int, int], list[int]] = {}
        for k, s in enumerate(self.sets):
            parts.setdefault((rows[k][1], len(s).bit_length()), []).append(k)
        self.parts = []
        for (width, bits), own in sorted(parts.items()):
            sketch = [self.sets[k][:len(self.sets[k]) - self.need[k] + 1] for k in own]
            hashes = np.concatenate(sketch)
            who = np.repeat(own, [len(s) for s in sketch])
            order = np.argsort(hashes, kind="stable")
            self.parts.append((width, int(self.need[own].min()), hashes[order], who[order]))

    def search(self, words: Words):
        """(row, item, size, shared) of every contained item of a block of documents."""
        for width in self.widths:
            row, h = _distinct(words, width)
            begin = np.searchsorted(row, np.arange(len(words.offsets)))
            size = np.diff(begin)
            for own, least, hashes, who in self.parts:
                if own != width:
                    continue
                lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
                hit = np.flatnonzero((hi > lo) & (size[row] >= least))
                pairs = {(int(row[x]), int(k)) for x in hit for k in who[lo[x]:hi[x]]}
                for r, k in sorted(pairs):
                    doc, item = h[begin[r]:begin[r + 1]], self.sets[k]
                    at = np.minimum(np.searchsorted(doc, item), len(doc) - 1)
                    shared = int((doc[at] == item).sum())
                    if shared >= self.need[k]:
                        yield r, self.items[k], len(item), shared


def _doc_shingles(texts: DataFrame, widths: list[int], bits: np.ndarray | None) -> DataFrame:
    """(_id, doc, width, hash, n): the distinct shingles of every document that pass the
    filter (None: all), and the number of all of them. ``texts``: (_id, doc, _text)."""
    shared = texts.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def work(batches):
        for b in batches:
            ids, doc = b.column(0), b.column(1).to_numpy()
            for block in blocks(b.column(2)):
                words = Words(block, lower=True)
                for width in widths:
                    row, h = _distinct(words, width)
                    n = np.bincount(row, minlength=block.n)[row]
                    if shared is not None:
                        known = shared.value
                        word = known[((h >> U64(6)) % U64(len(known))).astype(np.int64)]
                        pass_ = (word >> (h & U64(63))) & U64(1) == 1
                        row, h, n = row[pass_], h[pass_], n[pass_]
                    at = block.rows.start + row
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), pa.array(doc[at]), pa.array(np.full(len(row), width, np.int32)), pa.array(h.view(np.int64)),
                         pa.array(n)], ["_id", "doc", "width", "hash", "n"])

    return texts.mapInArrow(work, "_id long, doc long, width int, hash long, n long")


def _filter_bits(sketch: DataFrame) -> np.ndarray:
    """A bit for every sketch hash, in FILTER_WORDS words: all that reaches the driver."""
    word = F.pmod(F.shiftrightunsigned("hash", 6), F.lit(FILTER_WORDS)).cast("int").alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hash").bitwiseAND(F.lit(63)).cast("int"))
    out = np.zeros(FILTER_WORDS, dtype=np.int64)
    for r in sketch.groupBy(word).agg(F.bit_or(bit).alias("bits")).toLocalIterator():
        out[r.word] = r.bits
    return out.view(U64)


def _join_tables(texts: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(_id, item, size, shared) by joins alone; a row of ``sets`` is an item."""
    need = F.greatest(F.lit(1), F.ceil(F.lit(threshold) * F.size("shingles") - F.lit(1e-9)))
    items = write_table(sets.select(F.monotonically_increasing_id().alias("nth"), "item", "width", "shingles",
                                    F.size("shingles").cast("long").alias("size"), need.cast("long").alias("need"))
                        .withColumn("part", F.floor(F.log2("size")).cast("int")), "items")
    # a few numbers: at most as many widths as a shingle has words, and 63 size partitions of each
    parts = [(r.width, r.part, r.least) for r in items.groupBy("width", "part").agg(F.min("need").alias("least")).collect()]
    if not parts:
        return texts.sparkSession.createDataFrame([], "_id long, item long, size long, shared long")
    # any size - need + 1 shingles will do as a sketch: a match lacks size - need of them at most
    sketch = write_table(items.select("nth", "width", "part", "need", F.explode(F.expr(
        "slice(array_sort(shingles), 1, cast(size - need + 1 AS int))")).alias("hash")), "sketches")
    widths = sorted({w for w, _, _ in parts})
    # numbered by id and text, so that a second reading gives the same number
    numbered = texts.select("_id", F.xxhash64(F.coalesce(F.col("_id"), F.lit(-1)), F.col("_id").isNull(), "_text").alias("doc"), "_text")
    found = _doc_shingles(numbered, widths, _filter_bits(sketch))
    allowed = F.filter(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(p).alias("part"), F.lit(least).cast("long").alias("least")) for w, p, least in parts]),
                       lambda s: (s["w"] == F.col("width")) & (s["least"] <= F.col("n")))
    wide = write_table(found.select("doc", "width", "hash", "n", F.explode(allowed).alias("s")).select("doc", "width", "hash", "n", "s.part"), "doc-shingles")
    pairs = write_table(wide.join(sketch, ["width", "part", "hash"]).where("n >= need").select("doc", "nth").distinct(), "candidates")
    wanted = pairs.join(items, "nth").select("doc", "nth", "item", "width", "size", "need", F.explode("shingles").alias("hash"))
    # a repeated row is counted once and given back as often as it stands
    again = numbered.join(write_table(pairs.select("doc").distinct(), "candidate-docs"), "doc", "left_semi")
    exact = _doc_shingles(again.dropDuplicates(["doc"]).select("_id", "doc", "_text"), widths, None).select("doc", "width", "hash")
    counted = (wanted.join(exact, ["doc", "width", "hash"]).groupBy("doc", "nth", "item", "size", "need").agg(F.count("*").alias("shared"))
               .where("shared >= need"))
    return again.select("_id", "doc").join(counted, "doc").select("_id", "item", "size", "shared")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", width: int = WIDTH, threshold: float = THRESHOLD,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Pairs ``(<id_col>, <item_col>, n_item_shingles, n_shared, containment)`` where the
    document's whole text holds at least ``threshold`` of the item's distinct shingles.

    Words are lower-cased (A-Z) and separated by white space. Items with a null id or
    without words never match; documents with null or empty text match nothing; a null
    document id is returned as null. Repeated rows, of documents or items, repeat their
    pairs. Empty tables give an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text"))
    schema = f"`{id_col}` long, `{item_col}` long, n_item_shingles long, n_shared long, containment double"

    sets = write_table(_item_sets(items, item_col, item_text_col, width), "item-sets")
    if (sets.agg(F.sum(F.size("shingles"))).first()[0] or 0) > block_shingles:
        found = _join_tables(texts, sets, threshold)
        return found.select(F.col("_id").alias(id_col), F.col("item").alias(item_col), F.col("size").alias("n_item_shingles"),
                            F.col("shared").alias("n_shared"), (F.col("shared") / F.col("size")).alias("containment"))
    part = [(r.item, r.width, r.shingles) for r in sets.toLocalIterator()]
    if not part:
        return spark.createDataFrame([], schema)
    index = spark.sparkContext.broadcast(_Index(part, threshold))

    def work(batches):
        for b in batches:
            ids = b.column(0)
            for block in blocks(b.column(1)):
                out = [(ids[block.rows.start + r].as_py(), i, n, s, s / n) for r, i, n, s in index.value.search(Words(block, lower=True))]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.float64()])],
                        [id_col, item_col, "n_item_shingles", "n_shared", "containment"])

    return texts.mapInArrow(work, schema)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no item, with all their columns, whatever their names. A row goes
    by its id and text, so repeated rows go or stay together. Items need no id: ``item_col``
    plays no part. Null and empty texts hold nothing and stay; without items every row
    stays; an empty table stays empty."""
    rows = held(docs, mark=F.xxhash64(docs[id_col], docs[text_col].cast("string")), body=docs[text_col].cast("string"))
    texts = items.select(F.xxhash64(items[item_text_col].cast("string")).alias("item"), items[item_text_col].cast("string").alias("item_text"))
    hits = contained_items(rows.select("mark", "body"), texts, "mark", "body", "item", "item_text", **options)
    return rows.join(hits.select("mark").distinct(), "mark", "left_anti").select("row.*")


OP10_SQL = r"""
WITH fold AS (SELECT doc_id AS id, TRUE AS doc, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
              UNION ALL
              SELECT item_id, FALSE, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT id, doc, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM fold),
i AS (SELECT DISTINCT item_id, width, array_to_string(ws[p:p + width - 1], ' ') AS g
      FROM (SELECT id AS item_id, least(5, len(ws)) AS width, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS p
            FROM w WHERE NOT doc AND len(ws) > 0)),
s AS (SELECT DISTINCT doc_id, width, array_to_string(ws[p:p + width - 1], ' ') AS g
      FROM (SELECT id AS doc_id, width, ws, unnest(range(1, len(ws) - width + 2)) AS p
            FROM w, (SELECT DISTINCT width FROM i) WHERE doc AND len(ws) >= width)),
n AS (SELECT item_id, count(*) AS n_item_shingles FROM i GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM s JOIN i USING (width, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared::DOUBLE / n_item_shingles AS containment
FROM m JOIN n USING (item_id) WHERE 10 * n_shared >= 8 * n_item_shingles
"""
