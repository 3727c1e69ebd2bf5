"""End-to-end jobs on files built from the tiny fixture."""

import json
import os
import tempfile

import pytest

from tiny_data import TINY_TARGETS, TINY_TRAIN
from kinship.plans.jobs import knn_job, recommend_job, similarity_job


def _tsv(rows, name, d):
    path = os.path.join(d, name)
    with open(path, "w") as f:
        for u, i, r in rows:
            f.write(f"{u}\t{i}\t{int(r)}\t874965758\n")
    return path


def _json(folder):
    part = [f for f in os.listdir(folder) if f.startswith("part-") and f.endswith(".json")][0]
    with open(os.path.join(folder, part)) as f:
        return json.loads(f.readline())["answers"]


@pytest.fixture(scope="module")
def files():
    d = tempfile.mkdtemp(prefix="kinship-jobs-")
    return d, _tsv(TINY_TRAIN, "u1.base", d), _tsv(TINY_TARGETS, "u1.test", d)


def test_similarity_job(spark, files):
    d, train, test = files
    out = os.path.join(d, "similarity.json")
    rows = {r.metric: r.value for r in similarity_job(spark, train, test, out, train_rows=16, test_rows=10).collect()}
    assert rows["cosine.mae"] == pytest.approx(0.506657, abs=5e-7)
    assert rows["jaccard.mae"] == pytest.approx(1.160653, abs=5e-7)
    assert rows["pairs.similarity_computations"] == 15
    assert rows["bytes.nonzero_cosine"] == 56 and rows["bytes.nonzero_jaccard"] == 88
    doc = _json(out)
    assert doc["overlap"]["mean"] == pytest.approx(1.133333, abs=5e-7)


def test_row_count_check(spark, files):
    _, train, test = files
    with pytest.raises(ValueError, match="expected 80000"):
        similarity_job(spark, train, test, train_rows=80000)


def test_knn_job(spark, files):
    d, train, test = files
    out = os.path.join(d, "knn.json")
    rows = {r.metric: r.value for r in knn_job(spark, train, test, out, ks=(1, 3, 5)).collect()}
    assert rows["sweep.mae_k1"] == pytest.approx(0.925, abs=5e-7)
    assert rows["sweep.mae_k3"] == pytest.approx(0.887159, abs=5e-7)
    assert rows["sweep.mae_k5"] == pytest.approx(0.506657, abs=5e-7)
    assert rows["bytes.k5"] == 6 * 5 * 8
    assert rows["lowest.k"] is None  # nothing beats the all-users MAE here
    assert _json(out)["sweep"]["mae_k1"] == pytest.approx(0.925, abs=5e-7)


def test_recommend_job(spark, files):
    d, train, _ = files
    personal = os.path.join(d, "personal.csv")
    with open(personal, "w") as f:
        f.write("10,A,5\n20,B\n30,C,1\n40,D,\n50,E\n60,F\n")
    out = os.path.join(d, "reco.json")
    rows = recommend_job(spark, train, personal, out, ks=(2, 6), user=7, personal_rows=6).collect()
    got = {(r.k, r.position): (r.item, round(r.prediction, 6)) for r in rows}
    assert [got[(2, p)] for p in range(1, 5)] == [(40, 5.0), (50, 3.0), (60, 3.0), (20, 2.840135)]
    assert [got[(6, p)] for p in range(1, 5)] == [(40, 5.0), (50, 3.8), (60, 3.0), (20, 2.575678)]
    doc = _json(out)
    assert [e["item"] for e in doc["top5_k2"]] == [40, 50, 60, 20]
