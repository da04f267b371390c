"""Scalar helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive upper bounds of the health states, lowest state first.
STATE_BOUNDS = {
    "ping": (50.0, 500.0),
    "cpu": (0.10, 0.25, 0.40, 0.55),
    "mem": (0.1, 0.2, 0.3, 0.4),
    "reject": (0.001, 0.01, 0.1, 0.5),
}

# Number of the Bayes node which a health metric is evidence for.
STATE_NODE = {"ping": 1, "cpu": 2, "mem": 3, "reject": 4}


def discretise(value: Column, bounds: tuple[float, ...]) -> Column:
    """State 0..len(bounds): the first bound not exceeded."""
    out = F.lit(len(bounds))
    for state in range(len(bounds) - 1, -1, -1):
        out = F.when(value <= F.lit(bounds[state]), F.lit(state)).otherwise(out)
    return out


def health_state(metric: Column, value: Column) -> Column:
    """State of a value under the bounds of its metric; null for other metrics."""
    out = F.lit(None).cast("int")
    for name, bounds in STATE_BOUNDS.items():
        out = F.when(metric == name, discretise(value, bounds)).otherwise(out)
    return out


def country_label(country: Column, province: Column) -> Column:
    """Country, followed by ``.province`` when there is one."""
    blank = F.coalesce(F.trim(province), F.lit("")) == ""
    return F.when(blank, country).otherwise(F.concat(country, F.lit("."), province))


def routing_key(owner: Column, site: Column) -> Column:
    return F.concat_ws("_", owner, site)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays, over their common length."""
    n = F.least(F.size(a), F.size(b))
    prods = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function (Abramowitz and Stegun 7.1.26, error under 1.5e-7)."""
    z = F.abs(x) / F.lit(2.0 ** 0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * z)
    # The published coefficients, highest power first.
    poly = F.lit(1.061405429)
    for coef in (-1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = poly * t + F.lit(coef)
    erf = F.lit(1.0) - poly * t * F.exp(-z * z)
    return F.when(x >= 0, (F.lit(1.0) + erf) / 2).otherwise((F.lit(1.0) - erf) / 2)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_epoch(value: Column, unit: str = "s") -> Column:
    """Timestamp from epoch ``s``, ``ms`` or ``ns``; finer parts than a microsecond are dropped."""
    if unit == "s":
        return F.timestamp_seconds(value)
    if unit == "ms":
        return F.timestamp_millis(value)
    if unit == "ns":
        return F.timestamp_micros(F.call_function("div", value, F.lit(1000)))
    raise ValueError(f"unknown unit {unit!r}")


# Seconds of the duration letters.
_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def duration_seconds(text: str) -> int:
    """Seconds of a duration such as ``90m``, ``2H`` or ``30d``."""
    number, unit = text[:-1], text[-1].lower()
    if unit not in _UNIT_SECONDS or not number.isdigit():
        raise ValueError(f"bad duration {text!r}")
    return int(number) * _UNIT_SECONDS[unit]


def tumbling_start(ts: Column, seconds: int, origin: int = 0) -> Column:
    """Epoch second at which the fixed window of ``ts`` starts."""
    t = F.unix_seconds(ts) - F.lit(origin)
    return t - F.pmod(t, F.lit(seconds)) + F.lit(origin)


def sliding_starts(ts: Column, seconds: int, slide: int) -> Column:
    """Array with the epoch starts of all sliding windows that hold ``ts``; starts are multiples of ``slide``, which need not
    divide the width."""
    last = tumbling_start(ts, slide)
    starts = F.transform(F.sequence(F.lit(0), F.lit(-(-seconds // slide) - 1)), lambda i: last - i * F.lit(slide))
    return starts if seconds % slide == 0 else F.filter(starts, lambda s: s + F.lit(seconds) > F.unix_seconds(ts))
