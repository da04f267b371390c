"""AR, ARMA and ARIMA models of many series at once, from lag sums.

Fitting needs one pass: per series, sums of products of the value and its steps (first differences) at some lags, which
Spark aggregates partially, and the first and last few values, which correct the sums at the ends. Sums of
steps keep their precision whatever the level of a series is. What is left is a linear system of a few unknowns per
series, solved with numpy in ``mapInPandas`` on one row per series.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.scalars import dot
from gaugeworks.operators.series import TARGET_ROWS, with_lags

Z_95 = 1.959963984540054


def lag_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int, d: int = 0,
             target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Per series: ``n``, ``s`` (sums of y(t) y(t-j) for j = 0..k), ``head`` (its first k values, oldest
    first), ``tail`` (its last k + 1 values, latest first) and ``last_level``.

    With ``d`` = 1 the model series is the first difference.
    """
    if d not in (0, 1):
        raise ValueError("d must be 0 or 1")
    keys, order = list(keys), list(order)
    lagged = with_lags(df.where(F.col(value).isNotNull()), keys, order, value, k + d, target_rows, "_y")
    past = F.concat(F.array(F.col(value).cast("double")), F.col("_y"))
    if d:
        size = F.size("_past")
        past_d = F.zip_with(F.slice("_past", F.lit(1), size - 1), F.slice("_past", F.lit(2), size - 1),
                            lambda a, b: a - b)
    else:
        past_d = F.col("_past")
    base = (lagged.withColumn("_past", past).withColumn("_w", past_d).where(F.size("_w") > 0)
            .select(*keys, F.struct(*order).alias("_o"), F.col(value).cast("double").alias("_level"), "_w"))
    lags = [F.try_element_at("_w", F.lit(j + 1)) for j in range(k + 1)]
    full = F.size("_w") == k + 1
    sums = [F.coalesce(F.sum(lags[0] * x), F.lit(0.0)) for x in lags]
    return base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*sums).alias("s"),
        F.min_by(F.when(full, F.reverse("_w")), F.when(full, F.col("_o"))).alias("head"),
        F.max_by("_w", "_o").alias("tail"),
        F.max_by("_level", "_o").alias("last_level"))


def lag_matrices(s: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """For each series (first axis) the matrix of the sums of y(t-i) y(t-j) over the rows t that have all
    k lags.

    ``s`` holds the full lag sums, ``head`` is y(1)..y(k+1), ``tail`` is y(n)..y(n-k). The first row takes the
    products before t = k+1 off the full sums. One step down a diagonal moves the range of t back by one:
    one product comes in at the start, one leaves at the end.
    """
    k = s.shape[1] - 1
    m = np.empty((len(s), k + 1, k + 1))
    for j in range(k + 1):
        m[:, 0, j] = s[:, j] - (head[:, j:k] * head[:, :k - j]).sum(axis=1)
    back = head[:, k - 1::-1] if k else head[:, :0]
    for i in range(k):
        m[:, i + 1, i + 1:] = m[:, i, i:k] + back[:, i:i + 1] * back[:, i:] - tail[:, i:i + 1] * tail[:, i:k]
    lower = np.tril_indices(k + 1, -1)
    m[:, lower[0], lower[1]] = m[:, lower[1], lower[0]]
    return m


def moment_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int, d: int = 0,
                target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Per series: ``n``, ``yy`` (sum of y(t) squared), ``ys`` and ``ss`` (sums of y(t) s(t-j) and of s(t) s(t-j) for j = 0..k-1,
    where s(t) = y(t) - y(t-1)), ``head`` (its first values, oldest first, at most k + 1), ``tail`` (its last ones, latest
    first) and ``last_level``. With ``d`` = 1 the model series y is the first difference of ``value``.
    """
    if d not in (0, 1):
        raise ValueError("d must be 0 or 1")
    keys, order = list(keys), list(order)
    lagged = with_lags(df.where(F.col(value).isNotNull()), keys, order, value, k + d, target_rows, "_y")
    past = F.concat(F.array(F.col(value).cast("double")), F.col("_y"))
    steps = lambda c: F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))),
                                 F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: a - b)
    base = lagged.withColumn("_w", past)
    if d:
        base = base.withColumn("_w", steps("_w"))
    base = (base.withColumn("_s", steps("_w"))
            .select(*keys, F.struct(*order).alias("_o"), F.col(value).cast("double").alias("_level"), "_w", "_s"))
    now, step = F.try_element_at("_w", F.lit(1)), F.try_element_at("_s", F.lit(1))
    lags = [F.try_element_at("_s", F.lit(j + 1)) for j in range(k)]
    total = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    full = F.size("_w") == k + 1
    last = F.max_by("_w", "_o")
    return base.groupBy(*keys).agg(
        F.sum(F.when(F.size("_w") > 0, 1).otherwise(0)).alias("n"), total(now * now).alias("yy"),
        F.array(*[total(now * x) for x in lags]).alias("ys"), F.array(*[total(step * x) for x in lags]).alias("ss"),
        F.coalesce(F.min_by(F.when(full, F.reverse("_w")), F.when(full, F.col("_o"))), F.reverse(last)).alias("head"),
        last.alias("tail"), F.max_by("_level", "_o").alias("last_level"))


def step_matrices(yy: np.ndarray, ys: np.ndarray, ss: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """For each series (first axis) the matrix of the sums of products of s(t), .., s(t-k+1) and y(t-k), in this order, over the
    rows t that have all k lags. ``head`` is y(1)..y(k+1), ``tail`` is y(n)..y(n-k).

    The sums with y(t) become those with y(t-k) = y(t) - s(t) - .. - s(t-k+1).
    """
    k = ss.shape[1]
    g = np.empty((len(ss), k + 1, k + 1))
    steps = lag_matrices(ss, np.diff(head, axis=1), -np.diff(tail, axis=1))
    early = np.diff(head, axis=1)  # s(2)..s(k+1)
    cross = np.empty((len(ss), k))
    for i in range(k):
        # Rows t = i + 2 .. k are in the sums but lack some of the k lags.
        cross[:, i] = ys[:, i] - (head[:, i + 1:k] * early[:, :k - 1 - i]).sum(axis=1)
    square = yy - (head[:, :k] ** 2).sum(axis=1)
    g[:, :k, :k] = steps
    g[:, :k, k] = g[:, k, :k] = cross - steps.sum(axis=2)
    g[:, k, k] = square - 2 * cross.sum(axis=1) + steps.sum(axis=(1, 2))
    return g


def _solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """Least squares from scaled normal equations, and whether all unknowns are determined."""
    scale = np.sqrt(np.maximum(np.diag(a), 0))
    scale[scale == 0] = 1.0
    x, _, rank, _ = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-11)
    return x / scale, rank == len(b)


def _is_stationary(phi: np.ndarray) -> bool:
    """All roots of the AR part inside the unit circle."""
    if not len(phi):
        return True
    companion = np.zeros((len(phi), len(phi)))
    companion[0] = phi
    companion[1:, :-1] = np.eye(len(phi) - 1)
    return bool(np.abs(np.linalg.eigvals(companion)).max() < 1.0)


def long_ar_order(n: int, p: int, q: int, long_order: int | None = None) -> int:
    """Terms of the long autoregression for a series of n values: max(p, q) + ceil(log n), at most a quarter of n. Logarithmic
    growth is what the method asks for, and keeps the lags few for the longest series."""
    want = max(p, q) + math.ceil(math.log(max(n, 1))) if long_order is None else long_order
    return max(1, min(want, n // 4))


def lag_depth(n: int, p: int, q: int, long_order: int | None = None) -> int:
    """Lags that the fit of a series of n values looks back."""
    return p if q == 0 else max(p, q + long_ar_order(n, p, q, long_order))


def _ar_form(k: int, order: int, coef: np.ndarray) -> np.ndarray:
    """Weights on s(t), .., s(t-k+1), y(t-k) of the prediction of s(t) from s(t-1), .., s(t-order+1) and y(t-order)."""
    out = np.zeros(k + 1)
    out[1:order] = coef[:order - 1]
    out[order:] += coef[order - 1]
    return out


def _earlier(weights: np.ndarray, j: int) -> np.ndarray:
    """The same combination j rows earlier: weights on steps move by j places. Beyond the order of an AR they all are the one
    on the level, so the last place stays as it is."""
    return np.concatenate([np.zeros(j), weights[:len(weights) - 1 - j], weights[-1:]])


def fit_row(n: int, g: np.ndarray, tail: np.ndarray, p: int, q: int, long_order: int | None = None) -> tuple | str:
    """Coefficients of one series from its matrix of steps, or the reason why there are none.

    q = 0: least squares. q > 0: Hannan-Rissanen, where the residuals of a long AR are linear in the lags,
    so the second regression needs no further pass over the data. Both regress the step on earlier steps and one level, which
    spans the same space as the lags of the level but is well conditioned, and turn the result into coefficients of lags.
    """
    k = len(g) - 1
    rows = n - k
    design = np.zeros((1 + p + q, k + 1))
    design[0, 0] = 1.0
    if p == 0:
        design[0] = 1.0
    for j in range(1, p):
        design[j, j] = 1.0
    if p:
        design[p, p:] = 1.0
    resid = None
    if rows <= p + q:
        return f"too short: {max(rows, 0)} usable rows for {p + q} coefficients"
    if q:
        m = long_ar_order(n, p, q, long_order)
        basis = np.zeros((m, k + 1))
        basis[np.arange(m - 1), np.arange(1, m)] = 1.0
        basis[m - 1, m:] = 1.0
        pi, _ = _solve(basis @ g @ basis.T, basis @ g[:, 0])
        resid = -_ar_form(k, m, pi)
        resid[0] += 1.0
        for j in range(1, q + 1):
            design[p + j] = _earlier(resid, j)
    moments = design @ g @ design.T
    beta, determined = _solve(moments[1:, 1:], moments[1:, 0])
    sse = moments[0, 0] - 2 * beta @ moments[1:, 0] + beta @ moments[1:, 1:] @ beta
    dof = rows - p - q
    sigma2 = max(sse, 0.0) / dof if dof > 0 else None
    steps, theta = beta[:p], beta[p:]
    phi = np.zeros(p)
    if p:
        # y(t) = y(t-1) + s(t) with s(t) = sum of steps[j] s(t-j) + steps[p-1] y(t-p).
        phi[0] = 1.0 + steps[0]
        phi[1:] = steps[1:] - steps[:-1]
    recent_e = []
    if q:
        now = np.append(-np.diff(tail), tail[-1])
        for j in range(q):
            recent_e.append(float(_earlier(resid, j) @ now))
    return phi.tolist(), theta.tolist(), recent_e, sigma2, _is_stationary(phi), None if determined else "coefficients not unique"


def fit(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value", p: int = 3,
        q: int = 0, d: int = 0, long_order: int | None = None,
        target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """One row per series: ``phi``, ``theta``, ``sigma2``, ``stationary``, the state a forecast needs
    (``recent_y``, ``recent_e``, latest first, ``last_level``) and ``reason``. No constant term.

    With q > 0 the order of the long AR follows from the length of each series (``long_ar_order``). A series too short for the
    model has its row, with a null model and the ``reason``, which also tells if coefficients are not unique.
    """
    if q:
        longest = df.where(F.col(value).isNotNull()).groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        k = lag_depth(longest - d, p, q, long_order)
    else:
        k = p
    sums = moment_sums(df, keys, order, value, k, d, target_rows)
    key_fields = [sums.schema[c] for c in keys]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields]) + (
        ", n bigint, phi array<double>, theta array<double>, recent_e array<double>, sigma2 double,"
        " stationary boolean, reason string, recent_y array<double>, last_level double")
    names = [f.name for f in key_fields]
    made = ["phi", "theta", "recent_e", "sigma2", "stationary", "reason"]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            depth = pdf["n"].map(lambda n: lag_depth(n, p, q, long_order))
            for deep, part in pdf.groupby(depth):
                keyed = list(part[names].itertuples(index=False, name=None))
                enough = (part["n"] > deep).to_numpy()
                g = iter(_matrices(part[enough], deep))
                for key, n, tail, level, ok in zip(keyed, part["n"], part["tail"], part["last_level"], enough):
                    tail = np.asarray(tail[:deep + 1], float)
                    got = fit_row(n, next(g), tail, p, q, long_order) if ok else f"too short: {n} values for {deep} lags"
                    got = [None] * 5 + [got] if isinstance(got, str) else got
                    out.append([*key, n, *got, tail[:max(p, 1)].tolist(), level])
            yield pd.DataFrame(out, columns=[*names, "n", *made, "recent_y", "last_level"])

    return sums.mapInPandas(solve, schema)


def _matrices(part: pd.DataFrame, deep: int) -> np.ndarray:
    if not len(part):
        return np.empty((0, 0, 0))
    ys, ss = (np.stack(part[c].to_numpy()).astype(float)[:, :deep] for c in ("ys", "ss"))
    head, tail = (np.stack([v[:deep + 1] for v in part[c]]).astype(float) for c in ("head", "tail"))
    return step_matrices(part["yy"].to_numpy(float), ys, ss, head, tail)


def psi_weights(phi: Column, theta: Column, n: int) -> Column:
    """The first ``n`` weights of the moving-average form, psi(0) = 1 first."""
    nothing = F.array(F.lit(1.0))

    def step(acc: Column, j: Column) -> Column:
        ma = F.coalesce(F.try_element_at(theta, j), F.lit(0.0))
        return F.concat(F.array(dot(phi, acc) + ma), acc)

    if n == 1:
        return nothing
    return F.reverse(F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), nothing, step))


def forecast(model: DataFrame, keys: Sequence[str], n: int, d: int = 0, z: float = Z_95) -> DataFrame:
    """Rows ``h`` = 1..n with ``forecast``, ``lower``, ``upper`` from fitted models.

    A model whose AR part is not stationary keeps its point forecast but gets no interval; without a model the rows
    hold nulls.
    """
    phi, theta = F.col("phi"), F.col("theta")

    def step(acc: Column, _: Column) -> Column:
        y = dot(phi, acc["y"]) + dot(theta, acc["e"])
        return F.struct(F.concat(F.array(y), acc["y"]).alias("y"),
                        F.concat(F.array(F.lit(0.0)), acc["e"]).alias("e"))

    start = F.struct(F.col("recent_y").alias("y"), F.col("recent_e").alias("e"))
    run = F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, step)
    path = F.reverse(F.slice(run.getField("y"), 1, n))
    psi = psi_weights(phi, theta, n)

    def cumulated(arr: Column, start: Column) -> Column:
        return F.slice(F.aggregate(
            arr, F.array(start),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))), 2, n)

    staged = model.withColumn("_path", path).withColumn("_psi", psi)
    if d:
        staged = (staged.withColumn("_path", cumulated(F.col("_path"), F.col("last_level")))
                  .withColumn("_psi", cumulated(F.col("_psi"), F.lit(0.0))))
    staged = staged.withColumn("_var", cumulated(F.transform("_psi", lambda x: x * x), F.lit(0.0)))
    rows = staged.select(*keys, "sigma2", "stationary",
                         F.posexplode(F.arrays_zip("_path", "_var")).alias("_i", "_f"))
    half = F.when(F.col("stationary"), F.lit(z) * F.sqrt(F.col("sigma2") * F.col("_f._var")))
    point = F.col("_f._path")
    return rows.select(*keys, (F.col("_i") + 1).alias("h"), point.alias("forecast"),
                       (point - half).alias("lower"), (point + half).alias("upper"))


def arima_forecast(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                   p: int = 5, q: int = 3, d: int = 1, n: int = 20, long_order: int | None = None,
                   target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Fit and forecast each series in one job."""
    return forecast(fit(df, keys, order, value, p, q, d, long_order, target_rows), keys, n, d)
