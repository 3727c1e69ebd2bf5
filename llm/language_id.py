"""Language identification in two steps: family, then language within the family.

Features are hashed byte n-grams of the lower-cased text (letters only, other
characters read as one space), counted over the whole text. A linear support
vector machine per family (one against the rest) picks the family; inside it,
one-versus-one machines vote for the language. The machines are fitted, a task each, on
a bounded sample of labelled rows, the only rows that reach the driver, as vectors.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from llm._spark import held, ship
from llm._symbols import U64, Block, blocks, mix

# Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nl no sv",
    "romance": "ca es fr gl it pt ro",
    "slavic": "bg cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "indic": "bn gu hi mr ne pa ur",
    "turkic": "az kk tr uz",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

UNKNOWN = "und"
DIM = 4096
GRAMS = (1, 2, 3, 4)
SAMPLE_PER_LANG = 300  # bound of the training sample, rows a language ...
SAMPLE_ROWS = 19_200  # ... and in total (8 KB a row), which the languages share evenly ...
LEAST_PER_LANG = 20  # ... with at least this many rows each: so 960 label values can be learned
ROWS_AT_ONCE = 256
_KEEP = np.ones(256, dtype=bool)  # letters and all bytes beyond ASCII
_KEEP[:128] = [chr(c).isalpha() for c in range(128)]
_LETTER = r"\p{L}"


def family_of(lang: str) -> str:
    return _FAMILY.get(re.split("[-_]", lang.lower())[0], lang)


def _features(block: Block) -> np.ndarray:
    """(rows, DIM) unit vectors of log counts."""
    data = np.where(_KEEP[block.data], block.data, 32).astype(U64)
    n = len(data)
    row = np.repeat(np.arange(block.n), np.diff(block.offsets))
    out = np.zeros(block.n * DIM, dtype=np.int64)
    gram = np.zeros(n, dtype=U64)
    for k in GRAMS:
        m = n - k + 1
        if m <= 0:
            break
        gram = gram[:m] * U64(257) + data[k - 1:] + U64(1)
        inside = row[:m] == row[k - 1:]
        cell = (mix(gram) >> U64(52)).astype(np.int64) + row[:m] * DIM
        out += np.bincount(cell[inside], minlength=len(out))
    x = np.log1p(out.reshape(block.n, DIM).astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _vectors(texts: pa.Array):
    """(slice, has a letter, features) for parts of a column of texts."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    letter = pc.match_substring_regex(low, _LETTER).to_numpy(zero_copy_only=False)
    for start in range(0, len(low), ROWS_AT_ONCE):
        for b in blocks(low.slice(start, ROWS_AT_ONCE)):
            rows = slice(start + b.rows.start, start + b.rows.stop)
            yield rows, letter[rows], _features(b)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 20) -> np.ndarray:
    """Weights (last one: bias) of a linear machine with hinge loss, by dual coordinate descent; y is +-1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    alpha, w, q = np.zeros(len(x)), np.zeros(x.shape[1]), (x * x).sum(1)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (w @ x[i]) - 1) / q[i], 0.0), c)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved += abs(new - alpha[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class LanguageModel:
    langs: list[str]  # sorted
    families: list[str]
    family_w: np.ndarray  # (families, DIM + 1)
    pairs: list[tuple[int, int]]  # indexes of langs, within one family
    pair_w: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into langs, score from 0 to 1) for every row of features."""
        sigmoid = lambda m: 1 / (1 + np.exp(-np.clip(3 * m, -50, 50)))
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        if len(self.families) > 1:
            margin = x @ self.family_w.T
            fam = margin.argmax(1)
            rest = np.where(np.arange(margin.shape[1]) == fam[:, None], -np.inf, margin).max(1)
            score = sigmoid((margin.max(1) - rest) / 2)
        else:
            fam, score = np.zeros(len(x), int), np.ones(len(x))
        member = np.array([self.families.index(family_of(lang)) for lang in self.langs])
        votes = np.zeros((len(x), len(self.langs)))
        sums, beaten = np.zeros_like(votes), np.full(votes.shape, np.inf)
        for (a, b), m in zip(self.pairs, (x @ self.pair_w.T).T if self.pairs else ()):
            for lang, own in ((a, m), (b, -m)):
                votes[:, lang] += own > 0
                sums[:, lang] += np.tanh(own)
                beaten[:, lang] = np.minimum(beaten[:, lang], own)
        rank = np.where(member == fam[:, None], votes + sums / (4 * len(self.langs)), -np.inf)
        lang = rank.argmax(1)
        least = beaten[np.arange(len(x)), lang]
        return lang, score * np.where(np.isinf(least), 1.0, sigmoid(least))


def fit(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, per_lang: int = SAMPLE_PER_LANG,
        sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Fit on at most ``per_lang`` rows of each language (those with the smallest hash of the
    id; of equal ids one) and ``sample_rows`` in total, dealt out evenly. Every label value
    is a language, up to ``sample_rows / LEAST_PER_LANG`` of them: of a column with more, those
    with the most rows. None without labelled text. The sample is all that the driver
    holds; each machine is fitted by a task of its own."""
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.select(labelled[lang_col].cast("string").alias("l"),
                           F.md5(F.coalesce(labelled[id_col].cast("string"), F.lit(""))).alias("k"),
                           labelled[text_col].cast("string").alias("t")).where("l is not null and t is not null")
    most = max(1, sample_rows // LEAST_PER_LANG)
    labels = rows.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(most)
    learned = [r.l for r in labels.select("l").collect()]
    if not learned:
        return None
    per_lang = max(1, min(per_lang, sample_rows // len(learned)))
    # the cut is found on narrow rows: each task passes on at most per_lang rows a language
    nth = F.row_number().over(Window.partitionBy("l").orderBy("k"))
    cut = (rows.select("l", "k").join(F.broadcast(labels.select("l")), "l").withColumn("nth", nth).where(F.col("nth") <= per_lang)
           .groupBy("l").agg(F.max("k").alias("cut")))

    def work(batches):
        for b in batches:
            for rows, _, x in _vectors(b.column(1)):
                part = [v.astype(np.float16).tobytes() for v in x]
                yield pa.RecordBatch.from_arrays([b.column(0)[rows], pa.array(part, pa.binary())], ["l", "x"])

    # both broadcasts hold a narrow row for each of at most `most` languages
    sample = rows.join(F.broadcast(cut), "l").where("k <= cut").groupBy("l", "k").agg(F.min("t").alias("t"))
    got = sorted((r.l, bytes(r.x)) for r in sample.select("l", "t").mapInArrow(work, "l string, x binary").collect())
    x = np.stack([np.frombuffer(v, np.float16) for _, v in got])
    langs = sorted({lang for lang, _ in got})
    number = {lang: i for i, lang in enumerate(langs)}
    y = np.array([number[lang] for lang, _ in got])
    families = sorted({family_of(lang) for lang in langs})
    member = np.array([families.index(family_of(lang)) for lang in langs])
    # one family against the rest, or one language against another of its family
    machines = [(f, -1) for f in range(len(families))] if len(families) > 1 else []
    pairs = [(a, b) for a, b in itertools.combinations(range(len(langs)), 2) if member[a] == member[b]]
    data = spark.sparkContext.broadcast((x, y, member))

    def fitted(batches):
        x, y, member = data.value
        for b in batches:
            for nr, one, other in zip(*(c.to_pylist() for c in b.columns)):
                rows = np.ones(len(y), bool) if other < 0 else (y == one) | (y == other)
                own = member[y[rows]] if other < 0 else y[rows]
                w = fit_svm(x[rows].astype(np.float32), np.where(own == one, 1.0, -1.0)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([nr]), pa.array([w.tobytes()], pa.binary())], ["nr", "w"])

    jobs = [(nr, a, b) for nr, (a, b) in enumerate(machines + pairs)]
    weights = {}
    if jobs:
        table = spark.createDataFrame(jobs, "nr long, one int, other int").repartition(min(len(jobs), 10_000), "nr")
        weights = {r.nr: np.frombuffer(bytes(r.w), np.float32) for r in table.mapInArrow(fitted, "nr long, w binary").collect()}
    data.unpersist()
    as_matrix = lambda part: np.array([weights[k] for k in part], np.float32).reshape(-1, DIM + 1)
    return LanguageModel(langs, families, as_matrix(range(len(machines))), pairs, as_matrix(range(len(machines), len(jobs))))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(_LETTER), F.lit(False))


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    A null text or one without a letter, and every text without a model, is ``und``
    with score 0. Works row by row: repeated rows get equal answers, an empty table
    stays empty. ``docs`` must not have columns of these two names; ``names`` gives others.
    """
    ship(docs.sparkSession)
    taken = {n.lower() for n in names} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"columns in the way: {sorted(taken)}")
    at = docs.columns.index(text_col)
    rows = held(docs)  # column names play no part in a task

    def work(batches):
        for b in batches:
            lang, score = np.full(b.num_rows, -1), np.zeros(b.num_rows)
            if model is not None:
                for part, letter, x in _vectors(pc.struct_field(b.column(0), [at]).cast(pa.large_string())):
                    got, sure = model.predict(x)
                    lang[part] = np.where(letter, got, -1)
                    score[part] = np.where(letter, sure, 0.0)
            langs = np.array([*(model.langs if model else ()), UNKNOWN], dtype=object)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs[lang], pa.string()), pa.array(score, pa.float64())],
                                             ["row", "lang", "score"])

    schema = StructType([rows.schema["row"], StructField("lang", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(work, schema).select("row.*", F.col("lang").alias(names[0]), F.col("score").alias(names[1]))


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Rows that training must not see: crc32 of the id as text, modulo ``folds``, is 0. A null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(True))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """Learn from the rows that are not held out and predict every row:
    ``(<id_col>, held_out, lang_pred, score)``. Label and id are never inputs of a prediction."""
    out = held_out(docs[id_col])
    model = fit(docs.where(~out), text_col, lang_col, id_col, per_lang)
    texts = docs.select(docs[id_col].alias(id_col), out.alias("held_out"), docs[text_col].cast("string").alias("_text"))
    return predict(texts, model, "_text").select(id_col, "held_out", "lang_pred", "score")
