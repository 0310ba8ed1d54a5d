"""Toxicity: cumulative-link ordinal regression over sparse word and word-prefix features.

The model is P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector for all thresholds;
a document's output is its expected severity, the sum over k of P(grade > k), and it is toxic when
a grade of one or more is likelier than not.

Labels are ordered grades, 0 for clean. Where they hold two grades or more above it, those are what
is fitted; labels that say yes or no alone give the first threshold, and the toxic rows are then graded
by the number of their toxic features.

Cases, by definition: a null or empty text has no features and gets the base severity; labels that
are null, negative or no numbers, or of documents that are absent, are left out of training; with no
toxic label nothing is toxic; repeated documents and labels count as often as they occur within the sample; whole texts are
read, whatever their length; extra columns stay.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import fresh, materialize

#: The bound of the labelled sample, of each class, taken in the order of seeded hashes of the ids.
SAMPLE = 6000
FEATURES = 600
LEAST = 5
#: How many times as frequent a feature has to be among toxic rows.
RATIO = 8
GRADES = 3
PREFIXES = (3, 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """The words of a text, lower-cased, and their prefixes, marked by a leading ``^``."""
    words = set(_WORD.findall((text or "").lower()))
    out = set(words)
    for n in PREFIXES:
        out.update("^" + w[:n] for w in words if len(w) > n)
    return out


@dataclass(frozen=True)
class OrdinalModel:
    names: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, hits: np.ndarray) -> np.ndarray:
        """Expected severity of rows of 0/1 features."""
        return self.above(hits).sum(axis=1)

    def above(self, hits: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        z = hits @ self.weights
        return 1 / (1 + np.exp(-(z[:, None] - self.thresholds[None, :])))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, l2: float = 1e-5, steps: int = 600, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds by full-batch Adam on the ordinal log-likelihood."""
    n, k = x.shape
    w, first, gaps = np.zeros(k), 2.0, np.zeros(max(grades - 1, 0))
    mean = [np.zeros(k), np.zeros(1), np.zeros_like(gaps)]
    square = [np.zeros(k), np.zeros(1), np.zeros_like(gaps)]
    for step in range(1, steps + 1):
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        z = x @ w
        upto = 1 / (1 + np.exp(-np.clip(cuts[None, :] - z[:, None], -30, 30)))
        bounds = np.concatenate([np.zeros((n, 1)), upto, np.ones((n, 1))], axis=1)
        slope = np.concatenate([np.zeros((n, 1)), upto * (1 - upto), np.zeros((n, 1))], axis=1)
        rows = np.arange(n)
        p = np.maximum(bounds[rows, grade + 1] - bounds[rows, grade], 1e-12)
        dz = (slope[rows, grade + 1] - slope[rows, grade]) / p / n
        d_cut = np.zeros(grades)
        for g in range(grades):
            d_cut[g] = (-(slope[rows, g + 1] / p)[grade == g].sum() + (slope[rows, g + 1] / p)[grade == g + 1].sum()) / n
        tails = np.cumsum(d_cut[::-1])[::-1]
        for i, (grad, at) in enumerate(((x.T @ dz + l2 * w, 0), (tails[:1], 1), (tails[1:] * np.exp(gaps), 2))):
            mean[i] = 0.9 * mean[i] + 0.1 * grad
            square[i] = 0.999 * square[i] + 0.001 * grad**2
            move = rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-9)
            if at == 0:
                w = w - move
            elif at == 1:
                first -= float(move[0])
            else:
                gaps = gaps - move
    return w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def severity_grades(toxic: np.ndarray, hits: np.ndarray, grades: int) -> np.ndarray:
    """Ordered grades from yes/no labels: 0 for clean, else 1 to ``grades`` by equal parts of the number of toxic features."""
    out = np.zeros(len(toxic), int)
    bad = toxic == 1
    if bad.any():
        count = hits[bad].sum(axis=1)
        cuts = np.quantile(count[count > 0], np.arange(1, grades) / grades) if (count > 0).any() else np.zeros(grades - 1)
        out[bad] = 1 + (count[:, None] > cuts[None, :]).sum(axis=1)
    return out


def ordered_grades(label: np.ndarray, hits: np.ndarray, grades: int) -> np.ndarray:
    """Grades 0, 1, 2 and on: the ranks of the labels where they tell toxic rows apart, more than ``grades`` of them merged in order."""
    levels = np.unique(label[label > 0])
    if len(levels) < 2:
        return severity_grades((label > 0).astype(int), hits, grades)
    rank = np.searchsorted(levels, label)
    return np.where(label > 0, 1 + (rank * grades // len(levels) if len(levels) > grades else rank), 0)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            seen[1 if toxic else 0].update(features(text))
    names = [f for f in seen[1]]
    rest = [f for f in seen[0] if f not in seen[1]]
    yield pa.RecordBatch.from_pydict({"feature": names + rest, "toxic": [seen[1][f] for f in names] + [0] * len(rest), "clean": [seen[0][f] for f in names + rest]}, schema=pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, top: int = FEATURES, least: int = LEAST, grades: int = GRADES) -> OrdinalModel:
    """Fit on a bounded sample of labelled rows: ``sample`` of the clean and of the toxic at most, in hash order.

    The sampled ids are bounded by that parameter, so they are broadcast; feature counts are gathered
    with a distributed aggregation and only the ``top`` features by chi-square reach the driver.
    """
    known = labels.select(F.col(id).alias("_lid"), F.col(label).try_cast("int").alias("_grade")).where("_lid is not null and _grade >= 0")
    order = F.xxhash64(F.lit(17), F.col("_lid"))
    toxic_first = [known.where(c).orderBy(order, "_lid", "_grade").limit(sample) for c in ("_grade > 0", "_grade = 0")]
    picked = materialize(toxic_first[0].unionByName(toxic_first[1]), "toxicity-sample-ids")
    rows = docs.select(F.col(id).alias("_did"), F.col(text).alias("text")).join(F.broadcast(picked), F.col("_did") == F.col("_lid")).select("_did", "text", "_grade", (F.col("_grade") > 0).cast("int").alias("toxic"))
    rows = materialize(rows, "toxicity-sample")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad:
        return OrdinalModel((), np.zeros(0), np.full(grades, 30.0))
    counts = rows.select("text", "toxic").mapInArrow(_count_batches, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    n = bad + good
    miss_a, miss_b = F.lit(bad) - F.col("a"), F.lit(good) - F.col("b")
    chi = n * F.pow(F.col("a") * miss_b - F.col("b") * miss_a, 2) / F.greatest(F.lit(1.0), F.lit(float(bad) * max(good, 1)) * (F.col("a") + F.col("b")) * (miss_a + miss_b))
    chosen = counts.where((F.col("a") >= least) & (F.col("a") * good > RATIO * F.col("b") * bad)).orderBy(F.desc(chi), "feature").limit(top)
    names = tuple(r["feature"] for r in chosen.select("feature").collect())
    if not names:
        return OrdinalModel((), np.zeros(0), np.full(grades, 30.0))
    encoded = rows.select("_grade", _hits_udf(names)("text").alias("hits")).collect()
    x = np.zeros((len(encoded), len(names)), np.float64)
    for i, r in enumerate(encoded):
        x[i, r["hits"]] = 1
    label = np.array([r["_grade"] for r in encoded])
    order = np.lexsort([x @ np.arange(1, len(names) + 1), label])
    x, label = x[order], label[order]
    grade = ordered_grades(label, x, grades)
    w, cuts = fit_ordinal(x, grade, max(int(grade.max()), 1))
    return OrdinalModel(names, w, cuts)


def _index(names: tuple[str, ...]) -> dict[str, int]:
    return {f: i for i, f in enumerate(names)}


def _hits_udf(names: tuple[str, ...]):
    import pandas as pd

    @F.pandas_udf("array<int>")
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at = _index(names)
        for batch in texts:
            yield pd.Series([sorted(at[f] for f in features(t) & at.keys()) for t in batch])

    return hits


def score_udf(model: OrdinalModel):
    """A column function from text to ``struct<severity, grade, toxic>``."""
    import pandas as pd

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        at = _index(model.names)
        for batch in texts:
            x = np.zeros((len(batch), len(at)))
            for i, t in enumerate(batch):
                found = [at[f] for f in features(t) & at.keys()] if at else []
                x[i, found] = 1
            above = model.above(x)
            yield pd.DataFrame({"severity": above.sum(axis=1).round(6), "grade": (above > 0.5).sum(axis=1).astype("int32"), "toxic": above[:, 0] > 0.5})

    return score


def score(df: DataFrame, model: OrdinalModel, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with ``severity``, ``grade`` and ``toxic`` in a struct column, named ``out`` or that and underscores where a column is so named; no shuffle."""
    return df.withColumn(fresh(df, out), score_udf(model)(F.col(text)))
