"""Labelled training rows in bounded number, and the calibration of a score."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.storage import materialise


def text_of(col: Column) -> Column:
    """The id as text; null counts as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(text_of(F.col(doc_id))) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
                    most: int) -> DataFrame:
    """(text, label) of at most `most` documents of each class, written to the shared folder.

    The choice is by a hash of the id, so it is the same in every run. Rows with
    a null id, or a label other than 0 and 1, are left out; an id that is
    labelled twice keeps the larger label, and of the texts of an id the one with
    the smallest hash is taken. The ids are at most 2 * `most`, so they can be
    broadcast at any size of the tables.
    """
    usable = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & keep)
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = (usable.where("label = 0").orderBy(*order).limit(most)
              .union(usable.where("label = 1").orderBy(*order).limit(most)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return materialise(one.select("text", "label"), f"labelled-{label}")


class Logistic:
    """Logistic regression of a few features, fitted by Newton steps with an L2 penalty.

    Both classes weigh the same together, however many rows either has.
    """

    def __init__(self, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray):
        self.weights, self.centre, self.scale = weights, centre, scale

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 25) -> "Logistic":
        """With no rows, or rows of one class alone, the score is that class's smoothed share."""
        centre = x.mean(0) if len(x) else np.zeros(x.shape[1])
        scale = x.std(0) if len(x) else np.ones(x.shape[1])
        scale = np.where(scale > 0, scale, 1.0)
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        w = np.zeros(x.shape[1] + 1)
        w[0] = np.log(share / (1 - share))
        model = cls(w, centre, scale)
        if len(np.unique(y)) < 2:
            return model
        z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
        weight = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        ridge = np.full(len(w), penalty)
        ridge[0] = 1e-9
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            pull = z.T @ (weight * (p - y)) + ridge * w
            bend = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
            w = w - np.linalg.solve(bend, pull)
        model.weights = w
        return model

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + ((x - self.centre) / self.scale) @ self.weights[1:], -30, 30)))
