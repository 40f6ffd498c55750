"""Quality scores: kernel ridge regression on random Fourier features, calibrated by isotonic regression.

Document statistics are SQL expressions.  Random Fourier features of the
standardised statistics approximate a Gaussian kernel, so that the ridge
problem has fixed-size normal equations; every partition sums its share of
them and Spark adds the shares.  A part of the labelled rows that the ridge
fit doesn't see gives a histogram of raw scores (fixed bins), on which
pool-adjacent-violators fits a monotone map to probabilities.  What reaches
the driver has a fixed size: one matrix, one histogram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
_BINS = 2000
#: Number of statistics of a text.
N_STATISTICS = 13
_LOW, _HIGH = -0.5, 1.5


@dataclass(frozen=True)
class QualityParams:
    """Number of Fourier features, kernel width (in standard deviations, over all statistics), ridge, seed."""

    features: int = 256
    width: float = 1.0
    ridge: float = 1.0
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.omega + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Probability of label 1; within a level of the isotonic fit the raw score still orders."""
        raw = self.raw(stats)
        slope = (np.clip(raw, _LOW, _HIGH) - _LOW) / (_HIGH - _LOW)
        return 0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * slope


def statistics(text: Column) -> Column:
    """The statistics of a text as an array of doubles; a null text counts as empty, of any length all of it is read."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x) != "")

    def of(words: Column, lines: Column) -> Column:
        chars, n, n_lines = (F.greatest(c, F.lit(1)).cast("double") for c in (F.length(text), F.size(words), F.size(lines)))

        def share(pattern: str) -> Column:
            return F.sqrt((F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / chars)

        return F.array(
            F.log1p(F.size(words).cast("double")),
            F.length(F.regexp_replace(text, SPACE, "")) / n,
            share(r"[#*$%&|<>]+"),
            share(r"\p{Lu}+"),
            share(r"[0-9]+"),
            share(r"[!?]+"),
            share(r"[.,;:]+"),
            share(r"[^\p{L}\p{N}\s]+"),
            F.size(F.array_distinct(words)) / n,
            F.size(F.array_distinct(lines)) / n_lines,
            F.log1p(n / n_lines),
            F.size(F.filter(words, lambda w: F.length(w) == 1)) / n,
            F.when(F.size(words) == 0, 1.0).otherwise(0.0),
        )

    # The arrays are bound once; each statistic then reads them.
    return F.transform(F.array(F.struct(words.alias("w"), lines.alias("l"))), lambda s: of(s["w"], s["l"]))[0]


def _shares(model: QualityModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            z = model.fourier(np.stack(pdf["stats"].to_numpy()).astype(float)) if len(pdf) else np.empty((0, len(model.phase) + 1))
            part = z.T @ np.hstack([z, pdf["label"].to_numpy(float)[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "part": list(total)})

    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"i": pdf["i"].iloc[:1], "part": [np.sum(np.stack(pdf["part"].to_numpy()), axis=0)]})


def _isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in order of x: the blocks' mean x and y."""
    blocks: list[list[float]] = []
    for xs, ys, ns in zip(x, y, n, strict=True):
        blocks.append([xs, ys, ns])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def fit(labelled: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Fit on ``labelled (stats, label, calibrate)``; rows without label are left out.

    Rows with ``calibrate`` fit the calibration, the others the ridge scores;
    where one of the two is empty, all rows serve for both.  Without any
    labelled row every score is 0.5.
    """
    labelled = labelled.filter("label is not null and stats is not null")
    rng = np.random.default_rng(params.seed)
    width = labelled.selectExpr("max(size(stats)) n", "min(int(calibrate)) a", "max(int(calibrate)) b").first()
    n, mixed = width["n"] or N_STATISTICS, width["a"] != width["b"]
    moments = labelled.agg(*[f(F.col("stats")[k]).alias(f"{f.__name__}{k}") for k in range(n) for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([moments[f"avg{k}"] or 0.0 for k in range(n)])
    scale = np.array([moments[f"stddev_pop{k}"] or 1.0 for k in range(n)])
    model = QualityModel(
        mean, scale, rng.normal(size=(n, params.features)) / (params.width * np.sqrt(n)), rng.uniform(0, 2 * np.pi, params.features), np.r_[np.zeros(params.features), 0.5], np.array([0.0]), np.array([0.5])
    )
    if width["n"] is None:
        return model
    part = labelled.filter("not calibrate") if mixed else labelled
    rows = part.mapInPandas(_shares(model), "i int, part array<double>").groupBy("i").applyInPandas(_added, "i int, part array<double>").orderBy("i").collect()
    system = np.array([r["part"] for r in rows])
    gram = system[:, :-1] + params.ridge * np.diag(np.r_[np.ones(params.features), 0.0])
    model = QualityModel(model.mean, model.scale, model.omega, model.phase, np.linalg.lstsq(gram, system[:, -1], rcond=None)[0], model.knots, model.levels)

    raw = F.pandas_udf(lambda s: pd.Series(model.raw(np.stack(s.to_numpy()).astype(float)) if len(s) else [], dtype=float), "double")
    part = (labelled.filter("calibrate") if mixed else labelled).select(raw("stats").alias("raw"), "label")
    cell = F.floor((F.least(F.greatest("raw", F.lit(_LOW)), F.lit(_HIGH)) - _LOW) * (_BINS / (_HIGH - _LOW)))
    cells = part.groupBy(cell.alias("cell")).agg(F.sum("raw").alias("x"), F.sum(F.col("label").cast("double")).alias("y"), F.count("*").alias("n")).orderBy("cell").collect()
    n = np.array([r["n"] for r in cells], dtype=float)
    knots, levels = _isotonic(np.array([r["x"] for r in cells]), np.array([r["y"] for r in cells]), n)
    return QualityModel(model.mean, model.scale, model.omega, model.phase, model.weights, knots, levels)


def scored(stats: Column, model: QualityModel) -> Column:
    """Score from 0 to 1 of a statistics array."""
    return F.pandas_udf(lambda s: pd.Series(model.score(np.stack(s.to_numpy()).astype(float)) if len(s) else [], dtype=float), "double")(stats)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out, 4 calibrates. A null id falls in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def fit_on_labels(stats: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Fit ``stats (doc_id, stats)`` to ``labels (doc_id, quality)``, held-out rows excluded.

    Repeated labels of a document count as often as they occur.
    """
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label")).filter("label is not null")
    rows = stats.filter(fold(F.col("doc_id")) != 0).join(known, stats.doc_id == known.label_id)
    return fit(rows.select("stats", "label", (fold(F.col("doc_id")) == 4).alias("calibrate")), params)


def classify(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``quality_score`` and ``quality_kept``; columns of these names are replaced.

    A null text scores as an empty one; null ids and repeated rows don't
    matter; an empty table gives no rows.
    """
    found = docs.withColumn("quality_score", scored(statistics(docs["text"]), model))
    return found.withColumn("quality_kept", F.col("quality_score") >= threshold)
