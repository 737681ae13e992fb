"""Self-organising map, trained in batch form: every pass is one aggregation over all rows."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.models.base import Detector, inputs, share


def winners(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """Index of the nearest prototype per row, the first one among equals."""
    distance = (codebook ** 2).sum(axis=1) - 2.0 * (x @ codebook.T)
    return distance.argmin(axis=1)


def neighbourhood(x: int, y: int, sigma: float) -> np.ndarray:
    """Gaussian weight between any two grid units, numbered row by row."""
    unit = np.arange(x * y)
    gx, gy = unit // y, unit % y
    squared = (gx[:, None] - gx[None, :]) ** 2 + (gy[:, None] - gy[None, :]) ** 2
    return np.exp(-squared / (2.0 * sigma * sigma))


def unit_sums(rows: DataFrame, columns: list[str], codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, column sums) per winning unit.

    Each task sends at most one row per unit, so the shuffle and what reaches the driver are
    bounded by the grid, not by the data.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(codebook)
    units, width = codebook.shape

    def add_up(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = shipped.value
        n, sums = np.zeros(units), np.zeros((units, width))
        for block in blocks:
            x = block.to_numpy(dtype=float)
            best = winners(x, book)
            n += np.bincount(best, minlength=units)
            np.add.at(sums, best, x)
        hit = np.flatnonzero(n)
        yield pd.DataFrame({"unit": hit, "n": n[hit], **{f"s{j}": sums[hit, j] for j in range(width)}})

    totals = [f"s{j}" for j in range(width)]
    schema = "unit int, n double, " + ", ".join(f"{s} double" for s in totals)
    per_unit = (rows.select(*columns).mapInPandas(add_up, schema).groupBy("unit")
                .agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in totals])).toPandas()
    n, sums = np.zeros(units), np.zeros((units, width))
    n[per_unit["unit"]] = per_unit["n"]
    sums[per_unit["unit"]] = per_unit[totals].to_numpy()
    return n, sums


def som_pass(rows: DataFrame, columns: list[str], codebook: np.ndarray, weights: np.ndarray,
             rate: float = 1.0) -> np.ndarray:
    """Prototypes after one pass: each moves towards the neighbourhood-weighted mean of the rows."""
    n, sums = unit_sums(rows, columns, codebook)
    mass = weights @ n
    target = np.where(mass[:, None] > 0, (weights @ sums) / np.where(mass > 0, mass, 1.0)[:, None], codebook)
    return codebook + rate * (target - codebook)


class SelfOrganizingMap(Detector):
    """Score: distance to the nearest prototype. Explanation: share of each absolute deviation."""

    name = "som"

    def __init__(self, columns=None, x: int = 10, y: int = 10, sigma: float = 0.8,
                 learning_rate: float = 0.4, passes: int = 10, seed: int = 42):
        kwargs = {} if columns is None else {"columns": columns}
        super().__init__(**kwargs, x=x, y=y, sigma=sigma, learning_rate=learning_rate, passes=passes,
                         seed=seed)
        self.codebook: np.ndarray | None = None

    def fit(self, df, id_col="TransactionID", written=False):
        p = self.params
        rows = self.training_rows(df, id_col, written)
        ticket = F.xxhash64("_id", F.lit(p["seed"]))
        start = rows.orderBy(ticket, "_id").limit(p["x"] * p["y"]).select(*self.columns).toPandas()
        # with fewer rows than units the first rows are used again
        self.codebook = np.resize(start.to_numpy(dtype=float), (p["x"] * p["y"], len(self.columns)))
        for t in range(p["passes"]):
            decay = 1.0 + t / (p["passes"] / 2.0)
            weights = neighbourhood(p["x"], p["y"], p["sigma"] / decay)
            self.codebook = som_pass(rows, self.columns, self.codebook, weights,
                                     p["learning_rate"] / decay)
        return self

    def explain_block(self, x):
        deviation = np.abs(x - self.codebook[winners(x, self.codebook)])
        return np.sqrt((deviation ** 2).sum(axis=1)), share(deviation)

    def arrays(self):
        return {"codebook": self.codebook}

    def restore(self, arrays):
        self.codebook = arrays["codebook"]
