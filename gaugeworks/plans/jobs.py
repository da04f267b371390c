"""Composed jobs: outlier alerts, forecasts of areas, the 3-D grid, standing risk jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import geo
from gaugeworks.functions.scalars import routing_key
from gaugeworks.operators import aggregate, arma, lookup, outliers, rbf, resample
from gaugeworks.operators.series import number_series, with_page
from gaugeworks.plans import risk
from gaugeworks.session import cut
from gaugeworks.streaming.jobs import PaneJob, WindowJob


def outlier_job(seconds: int = 10, keys: Sequence[str] = ("sensor",), threshold: float = outliers.THRESHOLD,
                name: str = "detect_outliers", **options) -> WindowJob:
    """Outlying values per window. The state holds distinct values with their number."""
    group = ["window_start", "window_end", *keys]
    return WindowJob(
        name=name, seconds=seconds, state_keys=[*keys, "value"],
        result=lambda closed: outliers.mad_outliers(closed, group, "value", "n", threshold), **options)


def outlier_alerts(closed: DataFrame, seconds: int = 10, keys: Sequence[str] = ("sensor",),
                   threshold: float = outliers.THRESHOLD, name: str = "detect_outliers",
                   page_rows: int = 1000, render: Callable[[Column], Column] = F.to_json) -> DataFrame:
    """Message for each window that has outliers; ``closed`` holds the state rows of the windows.

    ``render`` makes the text from a struct of ``task, seconds, items, outliers, values``. A window with more than
    ``page_rows`` distinct outlying values gets several messages, by ``page``.
    """
    group = ["window_start", *keys]
    # The state is read three times below, and outliers are few.
    closed = cut(closed)
    found = cut(outliers.mad_outliers(closed, group, "value", "n", threshold))
    listed = (with_page(found.select(*group, "value"), group, ["value"], page_rows)
              .groupBy(*group, "page").agg(F.sort_array(F.collect_list("value")).alias("_v")))
    totals = (closed.groupBy(*group).agg(F.sum("n").alias("items"))
              .join(found.groupBy(*group).agg(F.sum("n").alias("outliers")), group))
    values = F.transform("_v", lambda v: F.format_string("%.2f", v)).alias("values")
    fields = F.struct(F.lit(name).alias("task"), F.lit(seconds).alias("seconds"), "items", "outliers", values)
    return listed.join(totals, group).select(*group, "page", "outliers", "items", render(fields).alias("message"))


def alert_job(seconds: int = 10, keys: Sequence[str] = ("sensor",), threshold: float = outliers.THRESHOLD,
              name: str = "detect_outliers", **options) -> WindowJob:
    return WindowJob(
        name=name, seconds=seconds, state_keys=[*keys, "value"],
        result=lambda closed: outlier_alerts(closed, seconds, keys, threshold, name), **options)


def geo_forecast(df: DataFrame, positions: DataFrame, box: Sequence[float], p: int = 5, q: int = 3,
                 n: int = 20, long_order: int | None = None) -> DataFrame:
    """ARIMA over the summed readings of a box."""
    total = (aggregate.sum_by_time(lookup.geo_box(df, positions, box))
             .select(F.lit("box").alias("series"), "ts", "value"))
    return arma.arima_forecast(total, ["series"], ["ts"], p=p, q=q, d=1, n=n, long_order=long_order)


def area_series(df: DataFrame, positions: DataFrame, box: Sequence[float], seconds: int,
                value: Column | None = None, origin: int = 0, digits: int = 3) -> DataFrame:
    """All cells that meet a box, merged to one series and resampled."""
    merged = lookup.geo_box_cells(df, positions, box).withColumn("series", F.lit("area"))
    return resample.resample(merged, ["series"], seconds, value, origin, digits=digits)


def area_forecast(df: DataFrame, positions: DataFrame, box: Sequence[float], seconds: int,
                  value: Column | None = None, p: int = 3, n: int = 12, origin: int = 0) -> DataFrame:
    """AR forecast of a resampled area."""
    series = area_series(df, positions, box, seconds, value, origin)
    return arma.forecast(arma.fit(series, ["series"], ["bucket"], p=p), ["series"], n)


def cell_forecasts(resampled: DataFrame, keys: Sequence[str], method: str, p: int = 3, q: int = 4,
                   n: int = 12, long_order: int | None = None, landmarks: int = rbf.LANDMARKS) -> DataFrame:
    """AR, ARMA, ARIMA or RBF forecast of many resampled series in one job."""
    if method == "rbf":
        return rbf.forecast_index(resampled, keys, ["bucket"], n=n, landmarks=landmarks)
    if method not in ("ar", "arma", "arima"):
        raise ValueError(f"unknown method {method!r}")
    d = int(method == "arima")
    model = arma.fit(resampled, keys, ["bucket"], p=p, q=0 if method == "ar" else q, d=d, long_order=long_order)
    return arma.forecast(model, keys, n, d)


def grid_readings(events: DataFrame, owner: str = "owner", step: int = 35) -> DataFrame:
    """Route events (``site, ts, v``) to three-dimensional cells: adds ``swimlane`` and ``label``."""
    return events.withColumns({
        "swimlane": routing_key(F.lit(owner), F.col("site")),
        "label": geo.cell_label(F.col("v.lat"), F.col("v.lng"), F.col("v.alt"), step)})


def grid_sensors(routed: DataFrame) -> DataFrame:
    """Sensor numbers of the cells in first-seen order, with their boxes."""
    numbered = number_series(routed, "label", "ts")
    box = geo.cell_bounds(F.col("label"))
    return (numbered.withColumn("_b", box)
            .select("sensor", "label", "_b.lat1", "_b.lat2", "_b.lng1", "_b.lng2"))


def node_risk_job(cpt: DataFrame, seconds: int = 600, slide: int = 60, landmarks: int = rbf.LANDMARKS, **options) -> PaneJob:
    """Sliding job: risk metrics per instance. The state holds the readings of the open panes, each once."""
    return PaneJob(
        name="node_risk", seconds=seconds, slide=slide, state_keys=["instance", "type", "ts", "value"],
        state={"n": F.count(F.lit(1)).cast("int")},
        result=lambda closed: risk.node_risk_closed(closed, cpt, seconds, slide, landmarks=landmarks),
        collect=risk.risk_metrics, **options)


def cluster_status_job(seconds: int = 60, **options) -> WindowJob:
    """Tumbling job over risk metrics: attack broadness of the whole cluster as a metric."""
    peak = lambda r: F.max(F.when(F.col("risk") == r, F.col("value")))
    return WindowJob(
        name="cluster_status", seconds=seconds, state_keys=["instance"],
        state={"ddos": peak("ddos"), "overload": peak("overload")},
        map=risk.current_risks,
        result=lambda closed: risk.broadness(risk.drop_incomplete(closed)),
        collect=lambda status: risk.cluster_metric(status, seconds), **options)
