"""DuckDB SQL oracles for the named queries (tables registered as views).

Independent of the Spark code: plain SQL over the same parquet tables. Where
the Spark side skips zero-similarity pairs (ranking, statistics), the oracle
uses the dense form over all user pairs, so it checks the sparse shortcuts
rather than repeating them.
"""

from __future__ import annotations

# Fixed values shared with the queries.
KS = (10, 30, 50, 100, 200, 300, 400, 800, 943)
SMALL_KS = (1, 3, 5, 10)
BASELINE = 0.7669
D = "::DOUBLE"

RATINGS = f"""r_all AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         CAST(max(1 + CAST(floor((l_quantity - 1) / 10) AS INTEGER)) AS DOUBLE) AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_custkey, l_partkey)"""

SPLIT_TRAIN = """train AS (SELECT "user", item, rating FROM r_all WHERE ("user" * 7 + item * 13) % 5 <> 0)"""
SPLIT_TARGETS = """targets AS (SELECT "user", item, rating FROM r_all WHERE ("user" * 7 + item * 13) % 5 = 0)"""
PERSONAL = """personal AS (
  SELECT p_partkey AS item, p_name AS title,
         CASE WHEN p_partkey % 7 = 3 THEN CAST(1 + p_partkey % 5 AS DOUBLE) END AS rating
  FROM part)"""
HELD_OUT_TRAIN = """train AS (
  SELECT "user", item, rating FROM r_all WHERE ("user" * 7 + item * 13) % 5 <> 0 AND item % 37 <> 0)"""
HELD_OUT_TARGETS = """targets AS (
  SELECT "user", item, rating FROM r_all WHERE ("user" * 7 + item * 13) % 5 = 0 OR item % 37 = 0)"""
COLD_TARGETS = """targets AS (
  SELECT "user", item, rating FROM base_targets
  UNION ALL SELECT -("user" + 2), item, rating FROM base_targets
  UNION ALL SELECT "user", -(item + 2), rating FROM base_targets
  UNION ALL SELECT -("user" + 2), -(item + 2), rating FROM base_targets)"""
RECO_TRAIN = """train AS (
  SELECT "user", item, rating FROM r_all
  UNION ALL SELECT CAST(-1 AS BIGINT), item, rating FROM personal WHERE rating IS NOT NULL)"""
RECO_TARGETS = """targets AS (
  SELECT CAST(-1 AS BIGINT) AS "user", item, rating FROM personal WHERE rating IS NULL)"""


def scale_sql(x: str, a: str) -> str:
    return f"(CASE WHEN {x} > {a} THEN 5.0{D} - {a} WHEN {x} < {a} THEN {a} - 1.0{D} ELSE 1.0{D} END)"


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0{D}"


MODEL = [
    """ua AS (SELECT "user", avg(rating) AS avg_rating, count(*) AS n_ratings FROM train GROUP BY "user")""",
    f"""dev AS (
  SELECT t."user", t.item, t.rating, ua.avg_rating, ua.n_ratings,
         (t.rating - ua.avg_rating) / {scale_sql('t.rating', 'ua.avg_rating')} AS dev
  FROM train t JOIN ua ON t."user" = ua."user")""",
    """nrm AS (SELECT "user", sqrt(sum(dev * dev)) AS norm FROM dev GROUP BY "user")""",
    f"""pre AS (
  SELECT d."user", d.item, d.rating, d.avg_rating, d.n_ratings, d.dev,
         CASE WHEN n.norm = 0 THEN 0.0{D} ELSE d.dev / n.norm END AS ndev
  FROM dev d JOIN nrm n ON d."user" = n."user")""",
    """co AS (
  SELECT a."user", b."user" AS neighbour, count(*) AS overlap, sum(a.ndev * b.ndev) AS dot,
         max(a.n_ratings) AS n_user, max(b.n_ratings) AS n_neighbour
  FROM pre a JOIN pre b ON a.item = b.item AND a."user" > b."user"
  GROUP BY a."user", b."user")""",
    f"""sim_cosine AS (
  SELECT "user", neighbour, round(dot, 12) + 0.0{D} AS sim FROM co
  WHERE round(dot, 12) + 0.0{D} <> 0)""",
    f"""sim_jaccard AS (
  SELECT "user", neighbour,
         round(CAST(overlap AS DOUBLE) / CAST(n_user + n_neighbour - overlap AS DOUBLE), 12) + 0.0{D} AS sim
  FROM co)""",
    """simf_cosine AS (SELECT "user", neighbour, sim FROM sim_cosine
                    UNION ALL SELECT neighbour, "user", sim FROM sim_cosine)""",
    """simf_jaccard AS (SELECT "user", neighbour, sim FROM sim_jaccard
                     UNION ALL SELECT neighbour, "user", sim FROM sim_jaccard)""",
    """users AS (SELECT DISTINCT "user" FROM train)""",
    """tri AS (SELECT a."user", b."user" AS neighbour FROM users a JOIN users b ON a."user" > b."user")""",
    """cand AS (
  SELECT t."user", t.item, p."user" AS neighbour, p.dev
  FROM targets t JOIN pre p ON p.item = t.item AND p."user" <> t."user")""",
]


def dense_rank_cte(metric: str, only_targets: bool = False) -> str:
    """All ordered user pairs with similarity (0 when absent), ranked per user."""
    restrict = ' WHERE a."user" IN (SELECT "user" FROM targets)' if only_targets else ""
    return f"""rk_{metric} AS (
  SELECT a."user", b."user" AS neighbour, coalesce(s.sim, 0.0{D}) AS sim,
         row_number() OVER (PARTITION BY a."user" ORDER BY coalesce(s.sim, 0.0{D}) DESC, b."user" ASC) AS rank
  FROM users a JOIN users b ON a."user" <> b."user"
  LEFT JOIN simf_{metric} s ON s."user" = a."user" AND s.neighbour = b."user"{restrict})"""


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def split_ctes() -> list[str]:
    return [RATINGS, SPLIT_TRAIN, SPLIT_TARGETS] + MODEL


def weights_cte(metric: str, k: int, suffix: str = "") -> str:
    """``w<suffix>``: weighted deviation per target with candidates."""
    if k <= 0:
        pairs = f"simf_{metric}"
        extra = ""
    else:
        pairs = f"rk_{metric}"
        extra = f" AND s.rank <= {k}"
    return f"""w{suffix} AS (
  SELECT c."user", c.item, sum(c.dev * s.sim) AS num, sum(abs(s.sim)) AS den
  FROM cand c JOIN {pairs} s ON s."user" = c."user" AND s.neighbour = c.neighbour{extra}
  GROUP BY c."user", c.item)"""


def prediction_ctes(metric: str, k: int, only_targets: bool = False, suffix: str = "") -> list[str]:
    """``pred<suffix>``: one prediction per target row (plus helper CTEs)."""
    ctes = []
    if k > 0:
        ctes.append(dense_rank_cte(metric, only_targets))
    ctes.append(weights_cte(metric, k, suffix))
    ctes.append(f"""pw{suffix} AS (
  SELECT t."user", t.item, t.rating, ua.avg_rating,
         CASE WHEN w.den IS NULL OR w.den = 0 THEN 0.0{D} ELSE w.num / w.den END AS w
  FROM targets t LEFT JOIN w{suffix} w ON w."user" = t."user" AND w.item = t.item
  LEFT JOIN ua ON ua."user" = t."user")""")
    ctes.append(f"""pred{suffix} AS (
  SELECT "user", item, rating,
         CASE WHEN avg_rating IS NULL THEN (SELECT avg(rating) FROM train)
              ELSE avg_rating + w * {scale_sql('avg_rating + w', 'avg_rating')} END AS prediction
  FROM pw{suffix})""")
    return ctes


def predict_sql(metric: str, k: int) -> str:
    return with_(split_ctes() + prediction_ctes(metric, k),
                 f"""SELECT "user", item, rating, {r6('prediction')} AS prediction FROM pred""")


def mae_sql(metric: str) -> str:
    return with_(split_ctes() + prediction_ctes(metric, 0),
                 f"SELECT {r6('avg(abs(rating - prediction))')} AS mae FROM pred")


def summary_select(values: str, col: str) -> str:
    """Dense statistics over every unordered user pair (absent pairs count 0)."""
    return f"""SELECT count(*) AS n_total, count(*) FILTER (WHERE v <> 0) AS n_nonzero,
       {r6('CAST(min(v) AS DOUBLE)')} AS min_value, {r6('CAST(max(v) AS DOUBLE)')} AS max_value,
       {r6('avg(CAST(v AS DOUBLE))')} AS mean_value, {r6('stddev_pop(CAST(v AS DOUBLE))')} AS stddev_value
FROM (SELECT coalesce(x.{col}, 0) AS v FROM tri LEFT JOIN {values} x
      ON x."user" = tri."user" AND x.neighbour = tri.neighbour) z"""


def sweep_ctes(ks=KS) -> list[str]:
    kl = ", ".join(str(k) for k in ks)
    return [
        dense_rank_cte("cosine"),
        f"ks AS (SELECT unnest([{kl}]) AS k)",
        """cw AS (SELECT c."user", c.item, c.dev, r.sim, r.rank
  FROM cand c JOIN rk_cosine r ON r."user" = c."user" AND r.neighbour = c.neighbour)""",
        f"""pk AS (
  SELECT t."user", t.item, t.rating, ks.k, ua.avg_rating,
         CASE WHEN sum(abs(cw.sim)) IS NULL OR sum(abs(cw.sim)) = 0 THEN 0.0{D}
              ELSE sum(cw.dev * cw.sim) / sum(abs(cw.sim)) END AS w
  FROM targets t CROSS JOIN ks
  LEFT JOIN cw ON cw."user" = t."user" AND cw.item = t.item AND cw.rank <= ks.k
  LEFT JOIN ua ON ua."user" = t."user"
  GROUP BY t."user", t.item, t.rating, ks.k, ua.avg_rating)""",
        f"""sweep AS (
  SELECT k, avg(abs(rating - CASE WHEN avg_rating IS NULL THEN (SELECT avg(rating) FROM train)
                 ELSE avg_rating + w * {scale_sql('avg_rating + w', 'avg_rating')} END)) AS mae
  FROM pk GROUP BY k)""",
    ]


def baseline_ctes() -> list[str]:
    """``base``: the all-users cosine MAE (predictions with k = 0)."""
    return prediction_ctes("cosine", 0, suffix="0") + [
        "base AS (SELECT avg(abs(rating - prediction)) AS mae FROM pred0)"]


def lowest_k_select() -> str:
    return f"""SELECT CAST(min(s.k) AS INTEGER) AS k, {r6('arg_min(s.mae, s.k)')} AS mae,
       {r6('arg_min(s.mae, s.k) - (SELECT mae FROM base)')} AS mae_minus_baseline
FROM sweep s WHERE round(s.mae, 12) < round((SELECT mae FROM base), 12)"""


def recommend_sql(k: int, n: int | None = 5) -> str:
    ctes = [RATINGS, PERSONAL, RECO_TRAIN, RECO_TARGETS] + MODEL + prediction_ctes("cosine", k, only_targets=True)
    return with_(ctes, f"""SELECT p.item, pe.title, {r6('p.prediction')} AS prediction
FROM pred p JOIN personal pe ON pe.item = p.item
{'' if n is None else f'ORDER BY prediction DESC, p.item ASC LIMIT {n}'}""")


def _recommend_per_k() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT {k} AS k, CAST(row_number() OVER (ORDER BY prediction DESC, item) AS INTEGER) AS position, item, title, prediction
FROM ({recommend_sql(k)}) r{k}""" for k in (30, 300))
    return f"SELECT k, position, item, title, prediction FROM ({parts}) r"


def _sim_stats(metric: str) -> str:
    return with_(split_ctes(), summary_select(f"sim_{metric}", "sim"))


def _report_similarity() -> str:
    ctes = split_ctes()
    cos = prediction_ctes("cosine", 0)
    jac = prediction_ctes("jaccard", 0, suffix="j")
    stats = f"""ov AS ({summary_select('co', 'overlap')})"""
    select = f"""SELECT metric, {r6('value')} AS value FROM (
  SELECT 'cosine.mae' AS metric, (SELECT avg(abs(rating - prediction)) FROM pred) AS value
  UNION ALL SELECT 'cosine.minus_baseline', (SELECT avg(abs(rating - prediction)) FROM pred) - {BASELINE}{D}
  UNION ALL SELECT 'jaccard.mae', (SELECT avg(abs(rating - prediction)) FROM predj)
  UNION ALL SELECT 'jaccard.minus_cosine', (SELECT avg(abs(rating - prediction)) FROM predj) - (SELECT avg(abs(rating - prediction)) FROM pred)
  UNION ALL SELECT 'pairs.users', CAST((SELECT count(*) FROM users) AS DOUBLE)
  UNION ALL SELECT 'pairs.similarity_computations', CAST((SELECT count(*) FROM tri) AS DOUBLE)
  UNION ALL SELECT 'overlap.min', (SELECT min_value FROM ov)
  UNION ALL SELECT 'overlap.max', (SELECT max_value FROM ov)
  UNION ALL SELECT 'overlap.mean', (SELECT mean_value FROM ov)
  UNION ALL SELECT 'overlap.stddev', (SELECT stddev_value FROM ov)
  UNION ALL SELECT 'bytes.nonzero_cosine', CAST((SELECT count(*) * 8 FROM sim_cosine) AS DOUBLE)
  UNION ALL SELECT 'bytes.nonzero_jaccard', CAST((SELECT count(*) * 8 FROM sim_jaccard) AS DOUBLE)) r"""
    return with_(ctes + cos + jac + [stats], select)


def _report_knn() -> str:
    kl = ", ".join(str(k) for k in KS)
    ctes = split_ctes() + sweep_ctes() + baseline_ctes() + [
        f"lk AS ({lowest_k_select()})",
        f"""kb AS (SELECT k, CAST(n * least(k, n - 1) * 8 AS BIGINT) AS bytes
  FROM (SELECT unnest([{kl}]) AS k) CROSS JOIN (SELECT count(*) AS n FROM users))""",
    ]
    select = f"""SELECT metric, {r6('value')} AS value FROM (
  SELECT 'sweep.mae_k' || CAST(k AS VARCHAR) AS metric, mae AS value FROM sweep
  UNION ALL SELECT 'lowest.k', CAST(k AS DOUBLE) FROM lk
  UNION ALL SELECT 'lowest.mae', mae FROM lk
  UNION ALL SELECT 'lowest.mae_minus_baseline', mae_minus_baseline FROM lk
  UNION ALL SELECT 'bytes.k' || CAST(k AS VARCHAR), CAST(bytes AS DOUBLE) FROM kb) r"""
    return with_(ctes, select)


def _neighbors(metric: str, k: int) -> str:
    return with_(split_ctes() + [dense_rank_cte(metric)],
                 f"""SELECT "user", neighbour, {r6('sim')} AS sim, rank FROM rk_{metric}
WHERE rank <= {k} AND sim <> 0""")


def oracle_sql() -> dict[str, str]:
    base = [RATINGS]
    split = split_ctes()
    kl = ", ".join(str(k) for k in KS)
    cold = [RATINGS, SPLIT_TRAIN, SPLIT_TARGETS.replace("targets AS", "base_targets AS"), COLD_TARGETS] + MODEL
    held = [RATINGS, HELD_OUT_TRAIN, HELD_OUT_TARGETS] + MODEL
    return {
        "ratings": with_(base, 'SELECT "user", item, rating FROM r_all'),
        "ratings_profile": with_(base, """SELECT count(*) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT "user", item FROM r_all)) AS n_pairs,
       count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
       min(rating) AS min_rating, max(rating) AS max_rating,
       CAST(count(*) FILTER (WHERE "user" IS NULL OR item IS NULL OR rating IS NULL) AS BIGINT) AS n_null,
       CAST(count(*) FILTER (WHERE isnan(rating)) AS BIGINT) AS n_nan
FROM r_all"""),
        "personal": with_([PERSONAL], "SELECT item, title, rating FROM personal"),
        "ratings_by_user": with_(split, 'SELECT "user", item, rating FROM train'),
        "ratings_by_item": with_(split, 'SELECT item, "user", rating FROM train'),
        "personal_train": with_([PERSONAL], 'SELECT CAST(-1 AS BIGINT) AS "user", item, rating FROM personal WHERE rating IS NOT NULL'),
        "personal_targets": with_([PERSONAL], 'SELECT CAST(-1 AS BIGINT) AS "user", item, rating FROM personal WHERE rating IS NULL'),
        "train_with_personal": with_([RATINGS, PERSONAL, RECO_TRAIN], 'SELECT "user", item, rating FROM train'),
        "user_avg": with_(split, f'SELECT "user", {r6("avg_rating")} AS avg_rating, n_ratings FROM ua'),
        "item_avg": with_(split, f'SELECT item, {r6("avg(rating)")} AS avg_rating, count(*) AS n_ratings FROM train GROUP BY item'),
        "global_avg": with_(split, f'SELECT {r6("avg(rating)")} AS global_avg FROM train'),
        "user_norm": with_(split, f'SELECT "user", {r6("norm")} AS norm FROM nrm'),
        "user_count": with_(split, 'SELECT count(*) AS n_users FROM users'),
        "pair_count": with_(split, 'SELECT count(*) AS n_users, CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS n_pairs FROM users'),
        "user_items": with_(split, 'SELECT t."user", t.item, ua.n_ratings AS n_items FROM train t JOIN ua ON ua."user" = t."user"'),
        "normalized_deviation": with_(split, f'SELECT "user", item, rating, {r6("avg_rating")} AS avg_rating, {r6("dev")} AS dev FROM dev'),
        "preprocessed": with_(split, f'SELECT "user", item, {r6("dev")} AS dev, {r6("ndev")} AS ndev FROM pre'),
        "co_ratings": with_(split, 'SELECT "user", neighbour, overlap FROM co'),
        "co_ratings_salted": with_(split, 'SELECT "user", neighbour, overlap FROM co'),
        "similarity_cosine": with_(split, f'SELECT "user", neighbour, {r6("sim")} AS sim FROM sim_cosine'),
        "similarity_jaccard": with_(split, f'SELECT "user", neighbour, {r6("sim")} AS sim FROM sim_jaccard'),
        "overlap_stats": with_(split, summary_select("co", "overlap")),
        "multiplications_total": with_(split, 'SELECT CAST(coalesce(sum(overlap), 0) AS BIGINT) AS multiplications FROM co'),
        "similarity_bytes_cosine": with_(split, 'SELECT count(*) AS nonzero, count(*) * 8 AS bytes FROM sim_cosine'),
        "similarity_bytes_jaccard": with_(split, 'SELECT count(*) AS nonzero, count(*) * 8 AS bytes FROM sim_jaccard'),
        "similarity_stats_cosine": _sim_stats("cosine"),
        "similarity_stats_jaccard": _sim_stats("jaccard"),
        "knn_bytes": with_(split, f"""SELECT k, CAST(n * least(k, n - 1) * 8 AS BIGINT) AS bytes
FROM (SELECT unnest([{kl}]) AS k) CROSS JOIN (SELECT count(*) AS n FROM users)"""),
        "neighbors_cosine_k10": _neighbors("cosine", 10),
        "neighbors_cosine_k1400": _neighbors("cosine", 1400),
        "neighbors_jaccard_k10": _neighbors("jaccard", 10),
        "weighted_deviation": with_(split + [weights_cte("cosine", 0)],
                                    f'SELECT "user", item, {r6("CASE WHEN den = 0 THEN 0.0::DOUBLE ELSE num / den END")} AS w FROM w'),
        "predict_cosine_all": predict_sql("cosine", 0),
        "predict_jaccard_all": predict_sql("jaccard", 0),
        "predict_cosine_k30": predict_sql("cosine", 30),
        "predict_jaccard_k30": predict_sql("jaccard", 30),
        "predict_cold_start": with_(cold + prediction_ctes("cosine", 0),
                                    f'SELECT "user", item, rating, {r6("prediction")} AS prediction FROM pred'),
        "cold_items": with_(cold, 'SELECT "user", item FROM targets t WHERE NOT EXISTS (SELECT 1 FROM train r WHERE r.item = t.item)'),
        "predict_held_out_items": with_(held + prediction_ctes("cosine", 0),
                                        f'SELECT "user", item, rating, {r6("prediction")} AS prediction FROM pred'),
        "cold_items_held_out": with_(held, 'SELECT "user", item FROM targets t WHERE NOT EXISTS (SELECT 1 FROM train r WHERE r.item = t.item)'),
        "mae_cosine": mae_sql("cosine"),
        "mae_jaccard": mae_sql("jaccard"),
        "mae_deltas": _mae_deltas(),
        "knn_sweep": with_(split + sweep_ctes(), f"SELECT k, {r6('mae')} AS mae FROM sweep"),
        "knn_sweep_neighbour_first": with_(split + sweep_ctes(SMALL_KS), f"SELECT k, {r6('mae')} AS mae FROM sweep"),
        "knn_lowest_k": with_(split + sweep_ctes() + baseline_ctes(), lowest_k_select()),
        "personal_predictions_k30": recommend_sql(30, None),
        "recommend_k30": recommend_sql(30),
        "recommend_k300": recommend_sql(300),
        "recommend_per_k": _recommend_per_k(),
        "report_similarity": _report_similarity(),
        "report_knn": _report_knn(),
    }


def _mae_deltas() -> str:
    ctes = split_ctes() + prediction_ctes("cosine", 0)
    jac = prediction_ctes("jaccard", 0, suffix="j")
    select = f"""SELECT {r6('c')} AS cosine_mae, {r6('j')} AS jaccard_mae,
       {r6(f'c - {BASELINE}{D}')} AS cosine_minus_baseline, {r6(f'j - {BASELINE}{D}')} AS jaccard_minus_baseline,
       {r6('j - c')} AS jaccard_minus_cosine
FROM (SELECT (SELECT avg(abs(rating - prediction)) FROM pred) AS c,
             (SELECT avg(abs(rating - prediction)) FROM predj) AS j) m"""
    return with_(ctes + jac, select)
