"""Rating files, the personal list, input checks and the JSON sink."""

import json
import os
import tempfile

import pytest

from kinship.sources.files import expect_ratings, ratings_profile, read_personal, read_ratings
from kinship.sources.sinks import write_report


def _write(text: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="kinship-src-")
    path = os.path.join(d, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_ratings_tsv_four_fields(spark):
    path = _write("1\t10\t5\t881250949\n2\t20\t3\t891717742\n 3 \t 30 \t 4 \t0\n", "u.data")
    rows = sorted(tuple(r) for r in read_ratings(spark, path).collect())
    assert rows == [(1, 10, 5.0), (2, 20, 3.0), (3, 30, 4.0)]
    assert read_ratings(spark, path).columns == ["user", "item", "rating"]


def test_read_ratings_tsv_three_fields(spark):
    path = _write("1\t10\t5\n2\t20\t3.5\n", "three.tsv")
    assert sorted(tuple(r) for r in read_ratings(spark, path).collect()) == [(1, 10, 5.0), (2, 20, 3.5)]


def test_read_ratings_bad_field_fails(spark):
    path = _write("1\t10\t5\t0\n2\tx\t3\t0\n", "bad.tsv")
    with pytest.raises(Exception):
        read_ratings(spark, path).collect()


def test_read_personal_shapes(spark):
    lines = ("1,Toy Story (1995),5\n"
             "2,GoldenEye (1995),\n"
             "3,Four Rooms (1995)\n"
             "4,Usual Suspects, The (1995),4\n")
    rows = sorted(tuple(r) for r in read_personal(spark, _write(lines, "personal.csv")).collect())
    assert rows == [
        (1, "Toy Story (1995)", 5.0),
        (2, "GoldenEye (1995)", None),
        (3, "Four Rooms (1995)", None),
        (4, "Usual Suspects, The (1995)", 4.0),
    ]


def test_expect_ratings_accepts_and_rejects(spark):
    good = spark.createDataFrame([(1, 1, 4.0), (1, 2, 5.0), (2, 1, 1.0)], "user long, item long, rating double")
    assert expect_ratings(good, rows=3) is good
    with pytest.raises(ValueError, match="expected 4 rows"):
        expect_ratings(good, rows=4)
    dup = good.unionByName(good.limit(1))
    with pytest.raises(ValueError, match="duplicate"):
        expect_ratings(dup)
    nan = spark.createDataFrame([(1, 1, float("nan"))], "user long, item long, rating double")
    with pytest.raises(ValueError, match="NaN"):
        expect_ratings(nan)
    out = spark.createDataFrame([(1, 1, 6.0)], "user long, item long, rating double")
    with pytest.raises(ValueError, match="outside"):
        expect_ratings(out)


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, 1, 4.0), (2, 1, 2.0)], "user long, item long, rating double")
    p = ratings_profile(df).first()
    assert (p.n_rows, p.n_pairs, p.n_users, p.n_items, p.min_rating, p.max_rating, p.n_null, p.n_nan) == (
        2, 2, 2, 1, 2.0, 4.0, 0, 0)


def test_write_report_nests_sections(spark):
    report = spark.createDataFrame(
        [("cosine.mae", 0.5), ("cosine.minus_baseline", -0.2), ("pairs.users", 6.0)], "metric string, value double")
    out = tempfile.mkdtemp(prefix="kinship-report-")
    write_report(report, out)
    parts = [f for f in os.listdir(out) if f.startswith("part-") and f.endswith(".json")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0])) as f:
        doc = json.loads(f.readline())
    assert doc["answers"] == {"cosine": {"mae": 0.5, "minus_baseline": -0.2}, "pairs": {"users": 6.0}}


@pytest.mark.parametrize("line", ["1,Toy Story (1995),5*", "2,GoldenEye (1995),five", "6,Heat,-3", "no id,Title", "3,Catch, as catch can"])
def test_bad_personal_lines_fail(spark, line):
    with pytest.raises(Exception, match="bad line in the personal list"):
        read_personal(spark, _write(f"9,Fine,3\n{line}\n", "personal.csv")).collect()


def test_commas_in_titles_are_quoted_and_the_scale_is_checked(spark):
    from kinship.sources.files import expect_personal

    lines = '3,"Catch-22, 1970",\n4,"Good, Bad, Ugly",5\n5,Plain,2.5\n6,"Just, quoted"\n'
    df = read_personal(spark, _write(lines, "personal.csv"))
    assert sorted(tuple(r) for r in df.collect()) == [
        (3, "Catch-22, 1970", None), (4, "Good, Bad, Ugly", 5.0), (5, "Plain", 2.5), (6, "Just, quoted", None)]
    assert expect_personal(df, 4) is df
    for bad, why in (("3,Catch-22, 1970\n", "outside"), ("4,Se7en (1995),9\n", "outside"), ("1,A,2\n1,B\n", "repeated")):
        with pytest.raises(ValueError, match=why):
            expect_personal(read_personal(spark, _write(bad, "personal.csv")))
    with pytest.raises(ValueError, match="expected 3 rows"):
        expect_personal(df, 3)


def test_short_rating_line_fails(spark):
    with pytest.raises(Exception, match="no rating|malformed|Malformed"):
        read_ratings(spark, _write("1\t10\t3\n1\t11\n", "u.data")).collect()


def test_rewritten_input_is_read_again(spark, tmp_path):
    from tiny_data import SF_SMALL
    from kinship.plans.catalog import _ratings

    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    before = _ratings(spark, str(tmp_path)).count()
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0").write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert 0 < _ratings(spark, str(tmp_path)).count() < before
