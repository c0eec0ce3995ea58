"""Toxicity (operator 6): a classifier chain of linear models.

Categories are predicted one after the other, and each model sees the probabilities of the
categories before it. While training, these come from out-of-fold predictions, so a later
model learns from probabilities as good as those it will meet. The last category, the
overall verdict, sees all others.

Features say whether a document holds a word, or a word with a prefix of 4 to 7 letters.
A fit takes the ``SAMPLE`` labelled documents with the smallest hashed ids (all, if
fewer), and keeps the ``FEATURES`` features with the largest G2 statistic; every document
is then scored on its whole text. The verdict's threshold has the best F1 on the
out-of-fold predictions.

Defined results: null and empty texts have no features and get the models' intercepts;
null labels count as none; a document labelled more than once takes its largest label;
rows with a null id are scored like others; repeated rows get equal results; without any
labelled document of both kinds nothing is judged toxic (score 0); other columns stay
untouched in :func:`keep_clean`; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Staged, ship

#: Labelled documents of a fit, and features kept.
SAMPLE = 8_000
FEATURES = 512
#: A feature needs so many labelled documents.
SUPPORT = 4
FOLDS = 5
RIDGE = 1.0
PREFIXES = (4, 5, 6, 7)
WORD_CACHE = 300_000

#: Columns of the judgement.
ADDED = ("tox_score", "tox_categories", "tox_reject")

_WORD = re.compile(r"[^\W\d_]+")

#: Category by category: toxic documents of a language; the verdict comes last.
CATEGORIES: tuple[tuple[str, str], ...] = (
    ("en", "toxic = 1 and lang = 'en'"),
    ("de", "toxic = 1 and lang = 'de'"),
    ("fr", "toxic = 1 and lang = 'fr'"),
    ("es", "toxic = 1 and lang = 'es'"),
    ("toxic", "toxic = 1"),
)


def words(text) -> set[str]:
    return set(_WORD.findall(text.lower())) if isinstance(text, str) else set()


def features_of(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Weights (the last is the intercept, not penalised) of a ridge logistic model, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-5)
        step = np.linalg.solve((x * v[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def apply_linear(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    """names: categories in order; features: name to column; weights: a row for each category."""

    names: list[str]
    features: dict[str, int]
    weights: list[np.ndarray]
    threshold: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities by category for rows of feature indicators."""
        got = np.zeros((len(x), 0))
        for w in self.weights:
            got = np.hstack([got, apply_linear(np.hstack([x, got]), w)[:, None]])
        return got


def fit_chain(x: np.ndarray, y: np.ndarray, names: list[str], features: dict[str, int], folds: np.ndarray) -> Chain:
    """Fit the chain: y has a column for each category, folds gives each row's fold."""
    oof = np.zeros((len(x), 0))
    weights = []
    for c in range(y.shape[1]):
        seen = np.hstack([x, oof])
        weights.append(fit_linear(seen, y[:, c]))
        p = np.zeros(len(x))
        for f in np.unique(folds):
            out = folds == f
            p[out] = apply_linear(seen[out], fit_linear(seen[~out], y[~out, c])) if (~out).any() else y[:, c].mean()
        oof = np.hstack([oof, p[:, None]])
    score, truth = oof[:, -1], y[:, -1]
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    at = int(np.argmax(f1))
    below = score[order[at + 1]] if at + 1 < len(order) else 0.0
    return Chain(names, features, weights, float((score[order[at]] + below) / 2))


def _indicators(texts: list, columns: dict[str, int], cache: dict[str, tuple[int, ...]]) -> np.ndarray:
    x = np.zeros((len(texts), len(columns)))
    if len(cache) > WORD_CACHE:
        cache.clear()
    for i, text in enumerate(texts):
        hit: set[int] = set()
        for w in words(text):
            got = cache.get(w)
            if got is None:
                got = cache[w] = tuple(columns[f] for f in features_of(w) if f in columns)
            if got:
                hit.update(got)
        x[i, list(hit)] = 1
    return x


def train(
    docs: DataFrame, labels: DataFrame, categories: tuple[tuple[str, str], ...] = CATEGORIES, sample: int = SAMPLE, features: int = FEATURES
) -> Chain | None:
    """Fit the chain on a bounded sample of labelled documents; None if there is nothing to learn."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    label = [F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"y{i}") for i, (_, c) in enumerate(categories)]
    # The sample is bounded by `sample` ids, so it may be broadcast; of rows that repeat an id the smallest serves.
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(marks), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "lang", "toxic")).alias("r")).select("doc_id", "r.*").select(
        F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS)).alias("fold"), "doc_id", "text", *label
    )
    rows = Staged(docs.sparkSession).write(rows)
    last = f"y{len(categories) - 1}"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n: dict[str, list[int]] = {}
            for text, y in zip(pdf["text"], pdf[last], strict=True):
                for f in {f for w in words(text) for f in features_of(w)}:
                    n.setdefault(f, [0, 0])[y] += 1
            yield pd.DataFrame({"feature": list(n), "n0": [v[0] for v in n.values()], "n1": [v[1] for v in n.values()]})

    totals = rows.agg(F.count("*").alias("n"), F.sum(last).alias("pos")).first()
    n, pos = totals["n"], totals["pos"] or 0
    if not 0 < pos < n:
        return None
    counts = rows.mapInPandas(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    has = F.col("n0") + F.col("n1")
    g2 = F.lit(0.0)
    for column, total in (("n0", n - pos), ("n1", pos)):
        g2 = g2 + part(F.col(column), has * total / n) + part(F.lit(total) - F.col(column), (F.lit(n) - has) * total / n)
    kept = counts.where(has >= SUPPORT).withColumn("g2", F.round(g2, 9)).orderBy(F.desc("g2"), "feature").limit(features).collect()
    columns = {r["feature"]: i for i, r in enumerate(kept)}

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        for pdf in batches:
            x = _indicators(pdf["text"].tolist(), columns, cache)
            yield pdf.drop(columns="text").assign(x=[np.packbits(r.astype(bool)).tobytes() for r in x])

    fields = ", ".join(f"y{i} int" for i in range(len(categories)))
    got = rows.mapInPandas(mark, f"fold long, doc_id long, {fields}, x binary").toPandas().sort_values("doc_id", kind="stable")
    x = np.array([np.unpackbits(np.frombuffer(b, np.uint8))[: len(columns)] for b in got["x"]], dtype=float)
    y = got[[f"y{i}" for i in range(len(categories))]].to_numpy(dtype=float)
    return fit_chain(x.reshape(len(got), len(columns)), y, [c for c, _ in categories], columns, got["fold"].to_numpy())


def _scores(model: Chain, texts: pa.Array, cache: dict[str, tuple[int, ...]]) -> np.ndarray:
    return model.predict(_indicators(texts.to_pylist(), model.features, cache))


def judge(docs: DataFrame, model: Chain | None) -> DataFrame:
    """All columns of ``docs`` with tox_score (double), tox_categories (names over 0.5,
    comma-joined) and tox_reject, which replace columns of these names."""
    docs = docs.drop(*ADDED)
    if model is None:
        return docs.withColumns(dict(zip(ADDED, (F.lit(0.0), F.lit(""), F.lit(False)), strict=True)))
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            p = _scores(model, batch.column(at), cache)
            names = [",".join(n for n, q in zip(model.names[:-1], row[:-1], strict=True) if q >= 0.5) for row in p]
            more = [pa.array(p[:, -1]), pa.array(names, pa.string()), pa.array(p[:, -1] >= model.threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *ADDED])

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("tox_score double, tox_categories string, tox_reject boolean").fields])
    return docs.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, with their columns as they are."""
    model = train(docs, labels)
    if model is None:
        return docs
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(at), cache)[:, -1] < model.threshold))

    return docs.mapInArrow(run, docs.schema)
