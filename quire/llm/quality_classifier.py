"""Quality scores from random Fourier features of document statistics.

Each text becomes a row of statistics (stats.NAMES). Random cosines of the scaled rows stand for a Gaussian kernel; every
partition adds up its part of the ridge regression's normal equations, of a fixed size, and the driver solves their sum.
Scores are made probabilities by isotonic regression on another fold, over a histogram of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batch_of, crc_of, settle, small_batches, steps, utf8
from quire.llm.stats import NAMES, Words

#: Cosines, bins of the calibration, ridge, fixed seed of the cosines, and the score from which label 1 is predicted.
COSINES, BINS, RIDGE, SEED, CUT = 256, 512, 1e-3, 20240607, 0.7


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return cosines(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def cosines(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """sqrt(2 / D) * cos(w x + b) and a constant; the kernel's width is the root of twice the number of statistics, halved."""
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((x.shape[1], COSINES)) / np.sqrt(x.shape[1] / 2)
    b = rng.uniform(0, 2 * np.pi, COSINES)
    z = np.clip((x - mean) / scale, -6, 6)
    return np.column_stack([np.sqrt(2 / COSINES) * np.cos(z @ w + b), np.ones(len(x))])


def isotonic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators of y / n in the order of x; (places, values) of the pools."""
    pools: list[list[float]] = []
    for at, count, total in zip(x.tolist(), n.tolist(), y.tolist(), strict=True):
        pools.append([at * count, count, total])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def statistics(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, fold, x): the statistics of every whole text, and crc32(id as text) mod 4."""
    kind = docs.schema[id].dataType.simpleString()
    fields = f"{id} {kind}, fold int, x array<double>"

    def measure(batches):
        for batch in steps(batches, "__text"):
            x = Words(*utf8(batch.column("__text"))).features()
            yield batch_of(fields, **{id: batch.column(id), "fold": crc_of(batch.column(id)) % 4, "x": list(x)})

    small_batches(docs.sparkSession)
    return docs.select(id, F.col(text).alias("__text")).mapInArrow(measure, fields)


def _matrix(rows: pa.RecordBatch) -> np.ndarray:
    column = rows.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, len(NAMES)))


def fit(measured: DataFrame, labels: DataFrame, id: str, label: str) -> Model:
    """Learn from the labelled rows outside fold 2: folds 0 and 1 give the weights, fold 3 the calibration.

    An id with several labels counts once, with their mean. With no labelled row the score is 0.5; where the calibrating
    fold is empty, the other two calibrate.
    """
    first = measured.agg(*[F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(len(NAMES))], *[F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(len(NAMES))]).first()
    mean = np.array([first[f"m{k}"] or 0.0 for k in range(len(NAMES))])
    scale = np.array([s if (s := first[f"s{k}"]) and s > 1e-9 else 1.0 for k in range(len(NAMES))])
    truth = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(id).agg(F.avg(label).alias("y"))
    known = measured.where("fold <> 2").join(truth, id)

    def partial(batches):
        total = np.zeros((COSINES + 1, COSINES + 2))
        for rows in batches:
            z = cosines(_matrix(rows), mean, scale)
            total += z.T @ np.column_stack([z, rows.column("y").to_numpy(zero_copy_only=False)])
        if total.any():
            yield batch_of("r int, part binary", r=range(len(total)), part=[row.tobytes() for row in total])

    def add(rows: pa.Table) -> pa.Table:
        parts = sorted(rows.column("part").to_pylist())
        return pa.Table.from_batches([batch_of("r int, part binary", r=[rows.column("r")[0].as_py()], part=[np.sum([np.frombuffer(p) for p in parts], axis=0).tobytes()])])

    summed = known.where("fold < 2").select("x", "y").mapInArrow(partial, "r int, part binary").groupBy("r").applyInArrow(add, "r int, part binary").collect()
    if not summed:
        return Model(mean, scale, np.zeros(COSINES + 1), np.array([0.0]), np.array([0.5]))
    total = np.array([np.frombuffer(bytes(r["part"])) for r in sorted(summed, key=lambda r: r["r"])])
    weights = np.linalg.solve(total[:, :-1] + RIDGE * max(1.0, total[-1, -2]) * np.eye(COSINES + 1) / COSINES, total[:, -1])
    bare = Model(mean, scale, weights, np.array([0.0]), np.array([0.5]))

    def histogram(batches):
        n, y = np.zeros(BINS), np.zeros(BINS)
        for rows in batches:
            at = np.clip((bare.raw(_matrix(rows)) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
            n += np.bincount(at, minlength=BINS)
            y += np.bincount(at, weights=rows.column("y").to_numpy(zero_copy_only=False), minlength=BINS)
        full = np.flatnonzero(n)
        yield batch_of("bin int, n double, y double", bin=full, n=n[full], y=y[full])

    for folds in ("fold = 3", "fold < 2"):
        bins = known.where(folds).select("x", "y").mapInArrow(histogram, "bin int, n double, y double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect()
        if bins:
            break
    bins.sort(key=lambda r: r["bin"])
    bare.knots, bare.values = isotonic(np.array([(r["bin"] + 0.5) / BINS * 2 - 0.5 for r in bins]), np.array([r["n"] for r in bins]), np.array([r["y"] for r in bins]))
    return bare


def classify(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """id, held_out, score and predicted for every row of docs.

    A null or blank text is scored by its statistics, which are then all zero. A null id counts as the empty string for
    the fold and is never labelled. Rows that repeat are scored alike.
    """
    measured = settle(statistics(docs, id, text))
    model = fit(measured, labels, id, label)
    fields = f"{id} {docs.schema[id].dataType.simpleString()}, held_out boolean, score double, predicted int"

    def judge(batches):
        for rows in batches:
            score = model.score(_matrix(rows))
            yield batch_of(fields, **{id: rows.column(id), "held_out": rows.column("fold").to_numpy() == 2, "score": score, "predicted": (score >= CUT).astype(int)})

    return measured.mapInArrow(judge, fields)


def accepted(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of docs for which label 1 is predicted, with all their columns; texts stay where they are."""
    model = fit(settle(statistics(docs, id, text)), labels, id, label)

    def keep(batches):
        for batch in steps(batches, text):
            yield batch.filter(pa.array(model.score(Words(*utf8(batch.column(text))).features()) >= CUT))

    return docs.mapInArrow(keep, docs.schema)
