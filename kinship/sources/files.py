"""Text inputs: tab-separated rating files and the comma-separated personal list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.functions.columns import DEFAULT_SCALE, RatingScale
from kinship.session import dealt, write_bucketed

# A rating line is "user<TAB>item<TAB>rating[<TAB>timestamp]"; only the first
# three fields are used. The fourth is declared so that FAILFAST accepts it.
RATING_FILE_SCHEMA = T.StructType(
    [
        T.StructField("user", T.LongType(), True),
        T.StructField("item", T.LongType(), True),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("extra", T.StringType(), True),
    ]
)

# A personal line is "id,title" (unrated), "id,title," (unrated) or
# "id,title,rating". A title with commas stands in double quotes; without quotes the
# last of three or more fields must be empty or a number.
PERSONAL_LINE = r"^\s*(\d+)\s*,\s*(?:\"([^\"]*)\"|([^\",]*)|([^\"]*?))\s*(?:,\s*(|[0-9]+(?:\.[0-9]+)?)\s*)?$"


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Read tab-separated ratings; a malformed or missing field fails the job."""
    given = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a rating line has no {c}"))).alias(c)
    return (
        spark.read.schema(RATING_FILE_SCHEMA)
        .option("sep", "\t")
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .csv(path)
        .select(given("user"), given("item"), given("rating"))
    )


def read_personal(spark: SparkSession, path: str) -> DataFrame:
    """Read the personal list as ``(item LONG, title STRING, rating DOUBLE NULL)``.
    A line of another form fails the job: a rating that is no number, or a title with
    commas that is neither quoted nor followed by a rating field. Ratings are checked
    against the scale by ``expect_personal``."""
    line = F.col("value")
    part = lambda k: F.regexp_extract(line, PERSONAL_LINE, k)
    # a bare title with commas needs the rating field after it, empty or not
    open_title = (part(4) != "") & ~line.rlike(r",\s*([0-9]+(\.[0-9]+)?)?\s*$")
    bad = ~line.rlike(PERSONAL_LINE) | open_title
    rating = F.nullif(F.trim(part(5)), F.lit(""))
    return (
        spark.read.text(path)
        .where(F.trim(line) != "")
        .select(
            F.when(bad, F.raise_error(F.concat(F.lit("bad line in the personal list: "), line)))
            .otherwise(part(1).cast("long")).alias("item"),
            F.trim(F.concat(part(2), part(3), part(4))).alias("title"),
            rating.cast("double").alias("rating"),
        )
    )


def ratings_profile(ratings: DataFrame) -> DataFrame:
    """One row describing a ratings table: sizes, bounds and defects."""
    r = F.col("rating")
    known = F.col("user").isNotNull() & F.col("item").isNotNull()
    count_if = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    # one shuffle of the ratings; pairs, users and items are counted from its groups
    pairs = ratings.groupBy("user", "item").agg(
        F.count(F.lit(1)).alias("n"), F.min(r).alias("lo"), F.max(r).alias("hi"),
        count_if(~known | r.isNull()).alias("null"), count_if(F.isnan(r)).alias("nan"))
    users = pairs.groupBy("user").agg(
        F.sum("n").alias("n"), count_if(known).alias("pairs"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum("null").alias("null"), F.sum("nan").alias("nan"))
    items = pairs.where("item is not null").groupBy("item").agg(F.lit(1).alias("one")).agg(F.count("*")).scalar()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return users.agg(
        total("n").alias("n_rows"), total("pairs").alias("n_pairs"), F.count("user").alias("n_users"),
        items.alias("n_items"), F.min("lo").alias("min_rating"), F.max("hi").alias("max_rating"),
        total("null").alias("n_null"), total("nan").alias("n_nan"))


def expect_ratings(ratings: DataFrame, rows: int | None = None, bounds: RatingScale = DEFAULT_SCALE) -> DataFrame:
    """Fail unless ``ratings`` has ``rows`` rows (when given), unique (user, item),
    no NULL or NaN and every rating within the scale. Returns ``ratings``.

    Runs one aggregate job; only its single summary row reaches the driver.
    """
    p = ratings_profile(ratings).first()
    problems = _rating_problems(p.asDict(), rows, bounds)
    if p["n_pairs"] != p["n_rows"] - (p["n_null"] or 0):
        problems.append(DUPLICATES)
    _fail_on("ratings", problems)
    return ratings


DUPLICATES = "duplicate (user, item) pairs"


def _rating_problems(p: dict, rows: int | None, bounds: RatingScale) -> list[str]:
    problems = []
    if rows is not None and (p["n_rows"] or 0) != rows:
        problems.append(f"expected {rows} rows, found {p['n_rows'] or 0}")
    if p["n_null"]:
        problems.append(f"{p['n_null']} rows with NULL fields")
    if p["n_nan"]:
        problems.append(f"{p['n_nan']} NaN ratings")
    if p["min_rating"] is not None and (p["min_rating"] < bounds.lo or p["max_rating"] > bounds.hi):
        problems.append(f"ratings outside [{bounds.lo}, {bounds.hi}]")
    return problems


def _fail_on(what: str, problems: list[str]) -> None:
    if problems:
        raise ValueError(f"invalid {what}: " + "; ".join(problems))


def ingest_ratings(spark: SparkSession, path: str, rows: int | None = None, bounds: RatingScale = DEFAULT_SCALE) -> DataFrame:
    """Read tab-separated ratings once: parsed, checked and written to the shared folder
    bucketed by item, so that every later join or grouping by item reads them in place.

    Fails on what ``expect_ratings`` fails on. Rows, nulls, NaN and bounds are counted by
    the tasks that write; only uniqueness is asked of the written table, where the rows of
    an item stand together already."""
    seen, r = Observation(), F.col("rating")
    watched = dealt(read_ratings(spark, path), "item").observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.min(r).alias("min_rating"), F.max(r).alias("max_rating"),
        F.count_if(F.col("user").isNull() | F.col("item").isNull() | r.isNull()).alias("n_null"), F.count_if(F.isnan(r)).alias("n_nan"))
    table = write_bucketed(watched, "ratings", "item")
    problems = _rating_problems(seen.get, rows, bounds)
    if not problems and not table.groupBy("item", "user").count().where("count > 1").isEmpty():
        problems.append(DUPLICATES)
    _fail_on("ratings", problems)
    return table


def ingest_personal(spark: SparkSession, path: str, rows: int | None = None, bounds: RatingScale = DEFAULT_SCALE) -> DataFrame:
    """The personal list, read, checked (as ``expect_personal`` does) and written once, as
    ``ingest_ratings`` does it."""
    seen, r = Observation(), F.col("rating")
    watched = dealt(read_personal(spark, path), "item").observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("item").isNull()).alias("null"),
        F.count_if((r < bounds.lo) | (r > bounds.hi) | F.isnan(r)).alias("out"))
    table = write_bucketed(watched, "personal", "item")
    p = dict(seen.get, most=0)
    if not table.groupBy("item").count().where("count > 1").isEmpty():
        p["most"] = 2
    _fail_on("personal list", _personal_problems(p, rows, bounds))
    return table


def expect_personal(personal: DataFrame, rows: int | None = None, bounds: RatingScale = DEFAULT_SCALE) -> DataFrame:
    """Fail unless the personal list has ``rows`` rows (when given), unique non-null
    items and every rating within the scale. Returns ``personal``; one aggregate job."""
    r = F.col("rating")
    p = personal.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when((r < bounds.lo) | (r > bounds.hi) | F.isnan(r), 1).otherwise(0)).alias("out"),
    ).agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.sum(F.when(F.col("item").isNull(), 1).otherwise(0)).alias("null"),
          F.sum("out").alias("out")).first()
    _fail_on("personal list", _personal_problems(p.asDict(), rows, bounds))
    return personal


def _personal_problems(p: dict, rows: int | None, bounds: RatingScale) -> list[str]:
    problems = []
    if rows is not None and (p["rows"] or 0) != rows:
        problems.append(f"expected {rows} rows, found {p['rows'] or 0}")
    if p["null"]:
        problems.append("rows without an item")
    if (p["most"] or 0) > 1:
        problems.append("repeated items")
    if p["out"]:
        problems.append(f"ratings outside [{bounds.lo}, {bounds.hi}]")
    return problems
