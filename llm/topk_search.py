"""Exact top-k search by inner product with pivot-table elimination.

A table holds the distance of every vector to a fixed number of pivots. For a query
the largest ``|d(q, p) - d(x, p)|`` over the pivots is a lower bound of ``d(q, x)``,
hence ``(|q|^2 + |x|^2 - bound^2) / 2`` an upper bound of the inner product.
Candidates are evaluated in the order of that bound until the bound falls below the
k-th best score found, so the answer is exact.

Queries and candidates meet in cells of a grid (blocks of queries times blocks of
candidates), dealt out over the cluster; a cell returns its k best per query and
one partial top-k merges the cells. Blocks are cut by row number hashes, so many
copies of one vector spread evenly. Every block of one side is copied to every block of
the other, so blocks grow with the tables, up to a size that a task holds easily.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinship.session import write_table
from llm._spark import ship

PIVOTS = 32
QUERY_BLOCK = 16_384  # largest blocks: some 8 and 32 MB of 64 components
CANDIDATE_BLOCK = 65_536
SMALL_BLOCK = 4096  # a smaller table is still cut into blocks of this size, to occupy the cluster
AT_ONCE = 1 << 19  # bounds held at once
STEP = 256  # candidates evaluated before the first look at the bound; four times as many before each next
_LONG = (-(1 << 63), (1 << 63) - 1)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if not len(pivots):
        return np.zeros((len(x), 0))
    with np.errstate(over="ignore", invalid="ignore"):
        return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of one query with rows of x, all of integral doubles: as int64
    where doubles hold every sum exactly, else as Python integers."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, len(q)) < 2.0 ** 53:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q.tolist()]
    return np.array([sum(a * int(b) for a, b in zip(whole, row) if a and b) for row in x.tolist()], dtype=object)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda r: (-scores[r], ids[r]))[:k], dtype=np.int64)
    return np.lexsort((ids, -scores))[:k]


def cell_top_k(q: np.ndarray, q_id: np.ndarray, q_dist: np.ndarray, x: np.ndarray, x_id: np.ndarray, x_dist: np.ndarray, k: int):
    """(query row, candidate row, score) of the k best candidates of every query in
    this cell, ties to the smaller id; a query's own id is no candidate."""
    with np.errstate(over="ignore", invalid="ignore"):
        q_norm, x_norm = (q ** 2).sum(1), (x ** 2).sum(1)
    at_once = max(1, AT_ONCE // max(1, len(x)))
    for start in range(0, len(q), at_once):
        part = slice(start, start + at_once)
        low = np.zeros((len(q_norm[part]), len(x)))
        with np.errstate(over="ignore", invalid="ignore"):
            for p in range(x_dist.shape[1]):
                np.fmax(low, np.abs(q_dist[part, p, None] - x_dist[None, :, p]), out=low)
            both = q_norm[part, None] + x_norm[None, :]
            bound = (both - low ** 2) / 2 + 1e-9 * both + 1e-6  # rounding never hides a candidate
        bound[~np.isfinite(both)] = np.inf  # beyond doubles: no bound
        bound[np.isnan(bound)] = np.inf
        order = np.argsort(-bound, axis=1)
        for r in range(len(bound)):
            best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
            at, step = 0, STEP
            while at < len(x):
                rows = order[r, at:at + step]
                if len(best_s) >= k and bound[r, rows[0]] < float(best_s[-1]):
                    break
                at, step = at + step, step * 4
                rows = rows[x_id[rows] != q_id[start + r]]
                s, i = np.concatenate([best_s, _scores(q[start + r], x[rows])]), np.concatenate([best_i, rows])
                top = _best(s, x_id[i], k)
                best_s, best_i = s[top], i[top]
            yield start + r, best_i, best_s


def _floor(x: Column) -> Column:
    """The floor as a double; doubles beyond 2^53 are whole numbers already."""
    return F.when(F.abs(x) < F.lit(2.0 ** 53), F.floor(x).cast("double")).otherwise(x)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
          scale: int = 1024, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK, small_block: int = SMALL_BLOCK) -> DataFrame:
    """The ``k`` rows with the largest inner product for every query row.

    Components become ``floor(scale * x)``. Returns ``(query_id, rank, <id_col>,
    score)``, ranks from 1, ties to the smaller id; fewer rows where there are fewer
    candidates. Rows with a null id, a null vector or a null or non-finite component
    take no part; vectors of different lengths do not meet. Rows that carry the
    query's id are its own. A repeated query row gets its answer once per row. An
    empty table gives an empty result. Other columns are ignored.

    Sums are exact for components of every size; ``score`` is a long, so a sum outside
    its range is ranked by its true value within a cell and between cells as the nearest
    long, and comes back as that. A component whose ``scale`` multiple is beyond the largest
    double takes its row out, as a non-finite one does.
    """
    spark = vectors.sparkSession
    ship(spark)
    vec = vectors[vec_col]
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(float("inf"))))
    rows = vectors.where(vectors[id_col].isNotNull() & vec.isNotNull() & fine).select(
        vectors[id_col].cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(vec, lambda x: _floor(x.cast("double") * scale)).alias("v"))
    rows = rows.withColumn("dim", F.size("v")).where("dim > 0")
    # pivots: the rows with the smallest hash, a fixed number for each length
    nth = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id"))
    chosen: dict[int, np.ndarray] = {}
    for r in rows.select("dim", "v", nth.alias("nth")).where(F.col("nth") <= pivots).collect():
        chosen.setdefault(r.dim, []).append(r.v)
    chosen = {d: np.unique(np.array(p), axis=0) for d, p in chosen.items()}

    def table(batches):
        for b in batches:
            dims = b.column(3).to_numpy()
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                dist = _distances(_matrix(part.column(2)), chosen[d])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(dist), pa.list_(pa.float64()))],
                                                 ["id", "asks", "v", "dim", "dist"])

    rows = write_table(rows.mapInArrow(table, "id long, asks boolean, v array<double>, dim int, dist array<double>"), "pivot-table")
    counts = rows.agg(F.count("*"), F.count_if("asks")).first()
    n_blocks, q_blocks = (max(1, -(-n // size)) for n, size in zip(counts, (candidate_block, query_block)))
    enough = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(n_blocks, min(-(-counts[0] // small_block), enough))
    # copies of one row share an id, so the position in the table decides the block too
    numbered = rows.withColumn("nr", F.monotonically_increasing_id())
    spread = lambda n, seed: F.pmod(F.xxhash64("nr", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cand = numbered.select("id", "v", "dist", "dim", "nr", spread(n_blocks, 1).alias("cb"), every(q_blocks).alias("qb"))
    asks = numbered.where("asks").select("id", "v", "dist", "dim", "nr", spread(q_blocks, 2).alias("qb"), every(n_blocks).alias("cb"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            read = lambda t: (_matrix(t["v"]), t["id"].to_numpy(), _matrix(t["dist"]))
            q, q_id, q_dist = read(left)
            x, x_id, x_dist = read(right)
            nr = left["nr"].to_numpy()
            for r, i, s in cell_top_k(q, q_id, q_dist, x, x_id, x_dist, k):
                s = np.array([min(max(int(v), _LONG[0]), _LONG[1]) for v in s], np.int64) if s.dtype == object else s
                for c, v in zip(out, (np.full(len(i), nr[r]), np.full(len(i), q_id[r]), x_id[i], s)):
                    c.append(v)
        return pa.table([pa.array(np.concatenate(c) if c else np.empty(0), pa.int64()) for c in out], ["nr", "query_id", "id", "score"])

    keys = ["dim", "cb", "qb"]
    best = (asks.groupBy(*keys).cogroup(cand.groupBy(*keys))
            .applyInArrow(cell, "nr long, query_id long, id long, score long"))
    rank = F.row_number().over(Window.partitionBy("nr").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
