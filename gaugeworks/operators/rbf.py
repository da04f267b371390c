"""RBF regression of many series: ridge regression on Gaussian bumps at the last points, and support vectors.

Forecasts follow the recent points near the end of a series and fall back to its mean level further on. ``forecast_index``
and ``forecast_now`` take the squared loss with ridge 1/(2c) on a few landmarks; ``support_forecast`` solves the dual of the
epsilon-insensitive loss on all points within kernel reach. Both work on many series of an Arrow batch at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.scalars import dot
from gaugeworks.operators.series import last_points

# Width of the kernel, bound of the weights and stopping tolerance.
GAMMA, C, TOLERANCE = 0.125, 20.0, 0.001
LANDMARKS, EPSILON, SWEEPS = 16, 0.1, 2000
_SERIES = 256


def reach(gamma: float) -> int:
    """Distance beyond which exp(-gamma d^2) is exactly 0 in double precision."""
    return math.ceil(math.sqrt(750.0 / gamma))


def bumps(t: Column, centres: Column, gamma: float) -> Column:
    return F.transform(centres, lambda c: F.exp(F.lit(-gamma) * (t - c) * (t - c)))


def ridge_weights(t, y, w, inside, landmarks: int, gamma: float, c: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the bumps at the first ``landmarks`` points of many series at once, and which of them exist. All arrays have one row
    per series; ``inside`` marks the points that are there."""
    at = inside[:, :landmarks]
    f = np.exp(-gamma * (t[:, :, None] - t[:, None, :landmarks]) ** 2) * (inside[:, :, None] & at[:, None, :])
    fw = (f * w[:, :, None]).transpose(0, 2, 1)
    return np.linalg.solve(fw @ f + np.eye(f.shape[2]) / (2.0 * c), fw @ y[:, :, None])[:, :, 0], at


def support_weights(t, y, w, inside, gamma: float, c: float, epsilon: float, tolerance: float) -> np.ndarray:
    """Dual weights of an epsilon-insensitive support vector fit of many series at once, by coordinate descent.

    A weight minimises the dual along its own axis: what the others leave of its value, drawn toward 0 by ``epsilon`` and held
    within ``c`` times the weight of the point. Sweeps end when no weight of any series misses its optimality condition by more than
    ``tolerance`` (in units of the values), or after ``SWEEPS``.
    """
    k = np.exp(-gamma * (t[:, :, None] - t[:, None, :]) ** 2) * (inside[:, :, None] & inside[:, None, :])
    box, beta, fit = c * w * inside, np.zeros_like(y), np.zeros_like(y)
    for _ in range(SWEEPS):
        if violation(beta, y - fit, box, epsilon).max(initial=0.0) <= tolerance:
            break
        for i in range(y.shape[1]):
            rest = y[:, i] - fit[:, i] + beta[:, i]
            new = np.clip(np.sign(rest) * np.maximum(np.abs(rest) - epsilon, 0.0), -box[:, i], box[:, i])
            fit += k[:, i, :] * (new - beta[:, i])[:, None]
            beta[:, i] = new
    return beta


def violation(beta, residual, box, epsilon: float) -> np.ndarray:
    """How far each weight is from its optimality condition: within the tube at 0, on its edge between the bounds, beyond it at a bound."""
    up = np.where(beta < box, residual - np.where(beta >= 0, epsilon, -epsilon), 0.0)
    down = np.where(beta > -box, -residual - np.where(beta <= 0, epsilon, -epsilon), 0.0)
    return np.maximum(np.maximum(up, down), 0.0) * (box > 0)


def _fitted(points: DataFrame, keys: Sequence[str], solve) -> DataFrame:
    """``weights``, ``centres`` and ``mean`` per series; ``solve(t, y, w, inside)`` takes many series at once.

    ``points`` holds per series its ``mean`` and the array ``pts`` of ``(t, y, w)``, latest first. Those
    arrays are short by construction: callers bound them by kernel reach or by window length.
    """
    names = list(keys)
    schema = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _SERIES) for b in batches for at in range(0, b.num_rows, _SERIES)):
            pts, mean = batch.column("pts"), batch.column("mean").to_numpy(zero_copy_only=False)
            size = pts.value_lengths().to_numpy(zero_copy_only=False)
            inside = np.arange(size.max(initial=1)) < size[:, None]
            t, y, w = (np.zeros(inside.shape) for _ in range(3))
            for out, name in ((t, "t"), (y, "y"), (w, "w")):
                out[inside] = pts.flatten().field(name).to_numpy(zero_copy_only=False)
            y = (y - mean[:, None]) * inside
            weights, used = solve(t, y, w, inside)
            cuts = pa.array(np.concatenate([[0], np.cumsum(used.sum(1))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[used])) for x in (weights, t[:, :used.shape[1]])]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), batch.column("mean"), *lists], [*names, "mean", "weights", "centres"])

    return points.select(*names, "mean", "pts").mapInArrow(run, schema + ", mean double, weights array<double>, centres array<double>")


def _ridge(gamma: float, c: float, landmarks: int):
    return lambda t, y, w, inside: ridge_weights(t, y, w, inside, landmarks, gamma, c)


def _support(gamma: float, c: float, epsilon: float, tolerance: float):
    return lambda t, y, w, inside: (support_weights(t, y, w, inside, gamma, c, epsilon, tolerance), inside)


def _value_at(t: Column, gamma: float) -> Column:
    return F.col("mean") + dot(F.col("weights"), bumps(t, F.col("centres"), gamma))


def _index_points(df: DataFrame, keys: list[str], order: Sequence[str], value: str, rows: int) -> DataFrame:
    near = last_points(df, keys, order, rows)
    point = F.struct((F.lit(1) - F.col("_back")).cast("double").alias("t"),
                     F.col(value).cast("double").alias("y"), F.lit(1.0).alias("w"))
    pts = near.groupBy(*keys).agg(F.sort_array(F.collect_list(point), asc=False).alias("pts"))
    level = df.groupBy(*keys).agg(F.avg(value).alias("mean"))
    return pts.join(level, keys)


def forecast_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                   n: int = 12, gamma: float = GAMMA, c: float = C,
                   landmarks: int = LANDMARKS) -> DataFrame:
    """Values ``h`` = 1..n steps after the end of each series, on the time index.

    Only the last rows count besides the mean: further back all bumps are exactly 0. So a series sends at
    most ``landmarks + reach(gamma)`` rows, however long it is.
    """
    keys = list(keys)
    points = _index_points(df, keys, order, value, landmarks + reach(gamma))
    return _ahead(_fitted(points, keys, _ridge(gamma, c, landmarks)), keys, n, gamma)


def _ahead(model: DataFrame, keys: list[str], n: int, gamma: float) -> DataFrame:
    return (model.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(n))))
            .select(*keys, "h", _value_at(F.col("h").cast("double"), gamma).alias("forecast")))


def support_forecast(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value", n: int = 12,
                     gamma: float = GAMMA, c: float = C, epsilon: float = EPSILON, tolerance: float = TOLERANCE,
                     rows: int | None = None) -> DataFrame:
    """Values ``h`` = 1..n steps after the end of each series by epsilon-insensitive support vector regression about the mean of the
    series. The fit is on the last ``rows`` points, by default all within kernel reach of the end."""
    keys = list(keys)
    points = _index_points(df, keys, order, value, reach(gamma) + 1 if rows is None else rows)
    return _ahead(_fitted(points, keys, _support(gamma, c, epsilon, tolerance)), keys, n, gamma)


def forecast_now(df: DataFrame, keys: Sequence[str], gamma: float = GAMMA, c: float = C, landmarks: int = LANDMARKS) -> DataFrame:
    """One forecast per row at time 0; ``df`` has ``keys``, and the array ``pts`` of ``(t, y, w)``, latest first: readings ``y`` at times
    ``t`` before or after 0, each standing for ``w`` readings. Callers bound the arrays by the length of a window."""
    total = F.aggregate("pts", F.lit(0.0), lambda a, p: a + p["y"] * p["w"])
    count = F.aggregate("pts", F.lit(0.0), lambda a, p: a + p["w"])
    model = _fitted(df.withColumn("mean", total / count), keys, _ridge(gamma, c, landmarks))
    return model.select(*keys, _value_at(F.lit(0.0), gamma).alias("forecast"))
