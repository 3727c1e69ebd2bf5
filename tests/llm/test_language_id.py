import math
import random
import unicodedata
import zlib

import pytest

from llm.catalog import QUERIES
from llm.language_id import family_of, fit, language_id, predict

SCHEMA = "doc_id long, text string, lang string, _text string"


def test_families():
    assert family_of("es") == family_of("FR-ca") == "romance" and family_of("de") == "germanic" and family_of("xx") == "xx"


def test_defined_answers(spark):
    words = {"en": "the quick and of that with", "de": "der schnelle und nicht eine über", "es": "el rápido y los niños años", "xx": "zqx kvv wjj"}
    rows = [(i, " ".join([words[k]] * (1 + i % 7)), k, "clash") for i in range(60) for k in words]
    rows += [(500, None, "en", ""), (501, "", "en", ""), (502, "12 -- !!", "de", ""), (None, words["de"], "de", ""), (503, words["es"], None, "")]
    rows += [(503, words["es"], None, "")] * 2
    out = language_id(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    answers = {r.doc_id: r.lang_pred for r in out if r.doc_id is None or r.doc_id >= 500}
    assert answers == {500: "und", 501: "und", 502: "und", None: "de", 503: "es"}
    truth = {" ".join([words[k]] * n): k for k in words for n in range(1, 8)}
    want = {(i, truth[t]) for i, t, k, _ in rows if t in truth and i is not None and i < 500}
    assert {(r.doc_id, r.lang_pred) for r in out if r.doc_id is not None and r.doc_id < 500} == want
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "abc", None, "")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language_id(df).collect()] == [("und", 0.0)]
    assert language_id(df.limit(0)).collect() == []
    one = spark.createDataFrame([(1, "abc", "en", ""), (2, "abd", "en", "")], SCHEMA)
    assert predict(one, fit(one, "text", "lang", "doc_id")).first().lang_pred == "en"


def test_every_label_value_is_learned(spark):
    rnd = random.Random(7)
    labels = ["en", "en-US", "EN", *(f"q{i:02d}" for i in range(70))]
    texts = {k: " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(8)) for k in labels}
    rows = [(100 * n + i, " ".join([t] * (1 + i)), k, "") for n, (k, t) in enumerate(texts.items()) for i in range(2 + (n < 40))]
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit(df, "text", "lang", "doc_id")
    assert model.langs == sorted(labels)
    assert all(r.lang_pred == r.lang for r in predict(df, model).collect())


def test_no_prediction_sees_label_or_id(spark):
    rows = [(i, ("the and of " if i % 2 else "der und die ") * 5, "en" if i % 2 else "de", "") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit(df, "text", "lang", "doc_id")
    flipped = predict(spark.createDataFrame([(i + 7, t, "zz", "") for i, t, *_ in rows], SCHEMA), model)
    assert all((r.lang_pred == "en") == r.text.startswith("the") for r in flipped.collect())


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out_accuracy_on_the_whole_table(spark, sf):
    d = f"/root/testdata/sf{sf}"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    out = QUERIES["op5_language_id"](spark, d).collect()
    assert len(out) == len(lang)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.97


def plain_prediction(model, text):
    """The model's answer, one n-gram after the other."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text or "")
    if not any(unicodedata.category(c).startswith("L") for c in low):
        return "und"
    data = [b if b >= 128 or chr(b).isalpha() else 32 for b in low.encode()]
    mask, counts = (1 << 64) - 1, {}

    def mixed(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    for k in (1, 2, 3, 4):
        for at in range(len(data) - k + 1):
            gram = 0
            for b in data[at:at + k]:
                gram = (gram * 257 + b + 1) & mask
            cell = mixed(gram) >> 52
            counts[cell] = counts.get(cell, 0) + 1
    norm = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values()))
    x = {cell: math.log1p(c) / norm for cell, c in counts.items()}
    margin = lambda w: sum(float(w[cell]) * v for cell, v in x.items()) + float(w[-1])
    family = model.families[0]
    if len(model.families) > 1:
        family = max(zip(map(margin, model.family_w), range(len(model.families)), model.families), key=lambda t: (t[0], -t[1]))[2]
    votes = {i: [0, 0.0] for i, lang in enumerate(model.langs) if family_of(lang) == family}
    for (a, b), w in zip(model.pairs, model.pair_w):
        if a in votes:
            m = margin(w)
            for lang, own in ((a, m), (b, -m)):
                votes[lang][0] += own > 0
                votes[lang][1] += math.tanh(own)
    return model.langs[max(votes, key=lambda i: (votes[i][0] + votes[i][1] / (4 * len(model.langs)), -i))]


def test_every_prediction_of_the_small_table_by_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from llm.language_id import held_out

    model = fit(docs.where(~held_out(docs["doc_id"])), "text", "lang", "doc_id")
    got = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    assert all(r.lang_pred == plain_prediction(model, texts[r.doc_id]) for r in got)


def test_bounded_sample_with_very_many_label_values(spark):
    rows = [(i, f"word{i} text", f"dirty{i}", "") for i in range(300)] + [(1000 + i, "the cat and the dog", "en", "") for i in range(30)]
    model = fit(spark.createDataFrame(rows, SCHEMA), "text", "lang", "doc_id", sample_rows=200)
    assert len(model.langs) == 10 and "en" in model.langs
