"""Distributed W x W Gram matrices of trailing windows.

Cross-sectional linear algebra over N assets and a window of W days only needs
`G = sum_i x_i x_i'` and `s = sum_i x_i`, where x_i is the W-vector of asset i: both are sums
over assets. Days are cut into blocks; a block also receives the W - 1 days before it, so
every observation is sent at most twice instead of once per window. Inside a block the assets
are split into groups of bounded size, each group yields one partial G and s per day, and the
partials are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import spread

DAYS_PER_BLOCK = 64
TICKERS_PER_GROUP = 2048
# A series whose deviation is below this is constant and has no correlation.
FLAT = 1e-12
_GRAM = "day_idx int, n long, total array<double>, gram array<double>"
_MOMENTS = "day_idx int, n_valid long, deviation double, n long, total array<double>"


def _standardised(window: np.ndarray, day: int):
    """z-scores of the moving series of a full window, and which series those are."""
    if day < window.shape[1]:
        return None, None
    std = window.std(axis=1)
    moving = std > FLAT
    centred = window[moving] - window[moving].mean(axis=1, keepdims=True)
    return centred / std[moving, None], moving


def _centred(window: np.ndarray, day: int):
    """Deviations from the mean over the days from day 1 on, moved to the front."""
    width = window.shape[1]
    rows = min(width, day)
    if rows < 1:
        return None, None
    out = np.zeros_like(window)
    known = window[:, width - rows :]
    out[:, :rows] = known - known.mean(axis=1, keepdims=True)
    return out, slice(None)


TRANSFORMS = {"standardised": _standardised, "centred": _centred}


def _block_matrix(block: int, rows: pd.DataFrame, width: int):
    """Names, returns (series x days, with the days before the block) and day range."""
    first = block * DAYS_PER_BLOCK
    last = min(first + DAYS_PER_BLOCK, int(rows["n_days"].iloc[0]))
    codes, names = pd.factorize(rows["ticker"])
    matrix = np.zeros((len(names), DAYS_PER_BLOCK + width - 1))
    matrix[codes, rows["day_idx"].to_numpy() - first + width - 1] = rows["ret"].to_numpy()
    return names, matrix, first, last


def _block_grams(width: int, transform):
    upper = np.triu_indices(width)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, matrix, first, last = _block_matrix(key[0], rows, width)
        out = {"day_idx": [], "n": [], "total": [], "gram": []}
        for day in range(first, last):
            x, _ = transform(matrix[:, day - first : day - first + width], day)
            if x is None or not len(x):
                continue
            out["day_idx"].append(day)
            out["n"].append(len(x))
            out["total"].append(x.sum(axis=0))
            out["gram"].append((x.T @ x)[upper])
        return pd.DataFrame(out, dtype=object if not out["n"] else None)

    return run


def _block_moments(width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first = key[0] * DAYS_PER_BLOCK
        last = min(first + DAYS_PER_BLOCK, int(rows["n_days"].iloc[0]))
        codes, names = pd.factorize(rows["ticker"], use_na_sentinel=False)
        at = rows["day_idx"].to_numpy() - first + width  # column 0 stays empty
        matrix = np.zeros((len(names), DAYS_PER_BLOCK + width))
        matrix[codes, at] = rows["ret"].to_numpy()
        seen = np.zeros(matrix.shape, np.int16)
        seen[codes, at] = 1
        seen = seen.cumsum(axis=1)
        out = {"day_idx": [], "n_valid": [], "deviation": [], "n": [], "total": []}
        for day in range(max(first, width), last):
            end = day - first + width
            known = seen[:, end] > seen[:, end - width]
            if not known.any():
                continue
            window = matrix[:, end - width + 1 : end + 1]
            window = window if known.all() else window[known]
            centred = window - window.mean(axis=1, keepdims=True)
            std = np.sqrt(np.einsum("ij,ij->i", centred, centred) / width)
            moving = ~(std <= FLAT)
            scale = np.divide(1.0, std, out=np.zeros_like(std), where=moving)
            out["day_idx"].append(day)
            out["n_valid"].append(len(window))
            out["deviation"].append(std.sum())
            out["n"].append(int(moving.sum()))
            out["total"].append(scale @ centred)
        return pd.DataFrame(out, dtype=object if not out["n"] else None)

    return run


def _block_products(width: int, transform):
    def run(key: tuple, rows: pd.DataFrame, directions: pd.DataFrame) -> pd.DataFrame:
        out = {"ticker": [], "day_idx": [], "k": [], "value": []}
        if len(rows) and len(directions):
            names, matrix, first, last = _block_matrix(key[0], rows, width)
            names = np.asarray(names, dtype=object)
            for day, vectors in zip(directions["day_idx"], directions["directions"]):
                if not first <= day < last:
                    continue
                x, kept = transform(matrix[:, day - first : day - first + width], day)
                if x is None:
                    continue
                for k, direction in enumerate(vectors):
                    out["ticker"].append(names[kept])
                    out["day_idx"].append(np.full(len(x), day))
                    out["k"].append(np.full(len(x), k))
                    out["value"].append(x @ np.asarray(direction))
        if not out["k"]:
            return pd.DataFrame(out, dtype=object)
        return pd.DataFrame({c: np.concatenate(v) for c, v in out.items()})

    return run


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "day_idx": [key[0]],
            "n": [int(rows["n"].sum())],
            "total": [np.vstack(rows["total"].to_numpy()).sum(axis=0)],
            "gram": [np.vstack(rows["gram"].to_numpy()).sum(axis=0)],
        }
    )


def group_count(rows: DataFrame, tickers_per_group: int | None = None) -> int:
    """Number of asset groups per block that keeps a group within its bound."""
    tickers = rows.select("ticker").distinct().count()
    return max(1, -(-tickers // (tickers_per_group or TICKERS_PER_GROUP)))


def _blocked(rows: DataFrame, width: int, groups: int) -> DataFrame:
    if width - 1 > DAYS_PER_BLOCK:
        raise ValueError(f"windows are limited to {DAYS_PER_BLOCK + 1} days")
    own = F.floor(F.col("day_idx") / DAYS_PER_BLOCK).cast("int")
    feeds_next = F.col("day_idx") >= (own + 1) * DAYS_PER_BLOCK - (width - 1)
    ahead = F.when(feeds_next & ((own + 1) * DAYS_PER_BLOCK < F.col("n_days")), own + 1)
    copies = rows.filter(F.col("ret").isNotNull()).select(
        "ticker",
        "day_idx",
        "n_days",
        "ret",
        F.explode(F.array_compact(F.array(own, ahead))).alias("block"),
        F.pmod(F.xxhash64("ticker"), F.lit(groups)).cast("int").alias("part"),
    )
    return spread(copies, "block", "part")


def window_gram(rows: DataFrame, width: int, transform: str, groups: int) -> DataFrame:
    """Per day: number of series, vector sum and packed upper Gram matrix of their windows.

    `rows`: (ticker, day_idx, n_days, ret); an absent day counts as return 0.
    """
    blocks = _blocked(rows, width, groups).groupBy("block", "part")
    grams = blocks.applyInPandas(_block_grams(width, TRANSFORMS[transform]), _GRAM)
    if groups > 1:
        # Merge in two steps so that one task never reads all partials of a day.
        step = grams.withColumn("_k", F.pmod(F.spark_partition_id(), F.lit(64)))
        grams = step.groupBy("day_idx", "_k").applyInPandas(_merge, _GRAM)
        grams = grams.groupBy("day_idx").applyInPandas(_merge, _GRAM)
    return grams


def window_moments(rows: DataFrame, width: int, groups: int) -> DataFrame:
    """Per full window: series seen in it, sum of their population deviations, number of the moving
    ones and the vector sum of their z-scores.

    `rows` as in `window_gram`; the moments come from the same blocks of days and groups of assets, so no
    window is copied per cell.
    """
    blocks = _blocked(rows, width, groups).groupBy("block", "part")
    parts = blocks.applyInPandas(_block_moments(width), _MOMENTS)
    counted = [F.sum(c).alias(c) for c in ("n_valid", "deviation", "n")]
    return parts.groupBy("day_idx").agg(*counted, *element_sums("total", width))


def window_products(
    rows: DataFrame, directions: DataFrame, width: int, transform: str, groups: int
) -> DataFrame:
    """(ticker, day_idx, k, value): product of every series' window with the day's k-th vector.

    `directions`: (day_idx, directions array<array<double>>), a day-level table that is sent
    to each asset group.
    """
    targeted = directions.select(
        F.floor(F.col("day_idx") / DAYS_PER_BLOCK).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"),
        "day_idx",
        "directions",
    )
    blocks = _blocked(rows, width, groups).groupBy("block", "part")
    return blocks.cogroup(targeted.groupBy("block", "part")).applyInPandas(
        _block_products(width, TRANSFORMS[transform]),
        "ticker string, day_idx int, k int, value double",
    )


def unpack(packed: np.ndarray, width: int) -> np.ndarray:
    full = np.zeros((width, width))
    upper = np.triu_indices(width)
    full[upper] = packed
    return full + full.T - np.diag(np.diag(full))


def top_eigen(grams: DataFrame, width: int, k: int) -> DataFrame:
    """Leading eigenvalues and eigenvectors of each day's Gram matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            days, counts, values, vectors = [], [], [], []
            for day, n, packed in zip(batch["day_idx"], batch["n"], batch["gram"]):
                eig, vec = np.linalg.eigh(unpack(np.asarray(packed), width))
                order = np.argsort(eig)[::-1][:k]
                days.append(day)
                counts.append(n)
                values.append(np.maximum(eig[order], 0.0))
                vectors.append([vec[:, j] for j in order])
            yield pd.DataFrame({"day_idx": days, "n": counts, "eig": values, "vecs": vectors})

    schema = "day_idx int, n long, eig array<double>, vecs array<array<double>>"
    return grams.select("day_idx", "n", "gram").mapInPandas(run, schema)


def ridge_solutions(grams: DataFrame, width: int, ridge: float) -> DataFrame:
    """y solving ((m-1) * ridge * I + G) y = s for every day, as array<double>[W].

    m is the number of rows in the window: W, or the day number while fewer exist.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for day, total, packed in zip(batch["day_idx"], batch["total"], batch["gram"]):
                freedom = max(min(width, day) - 1, 1)
                matrix = unpack(np.asarray(packed), width) + freedom * ridge * np.eye(width)
                out.append(np.linalg.solve(matrix, np.asarray(total)))
            yield pd.DataFrame({"day_idx": batch["day_idx"], "y": out})

    return grams.mapInPandas(run, "day_idx int, y array<double>")


def element_sums(vector: str, width: int) -> list:
    """Per-position sums of an array column as ordinary (partially aggregated) sums."""
    return [F.sum(F.element_at(vector, k + 1)).alias(f"_s{k}") for k in range(width)]
