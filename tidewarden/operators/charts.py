"""Chart aggregates over the marts, and the general form they share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.numbers import mean_of_hundredths

AGGREGATES: dict[str, Callable[[str], Column]] = {
    "avg": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.countDistinct,
    # For columns of two decimal places: summed exactly, so the row order cannot change the result.
    "avg_hundredths": lambda name: mean_of_hundredths(F.col(name)),
}


def metric(
    df: DataFrame,
    dims: Sequence[str | Column],
    metrics: Mapping[str, tuple[str, str] | str] | Sequence[tuple[str, str]],
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Group by `dims` and compute labelled metrics: (aggregate, column) or a SQL expression.

    Pairs given without labels are labelled as `AVG(column)`. All groups are returned unless the caller asks for a
    limit; then the rows with the largest first metric are kept, ties in order of the dimensions.
    """
    if not isinstance(metrics, Mapping):
        metrics = {f"{kind.upper()}({column})": (kind, column) for kind, column in metrics}
    rows = df if where is None else df.filter(where)
    computed = [
        (F.expr(spec) if isinstance(spec, str) else AGGREGATES[spec[0].lower()](spec[1])).alias(label)
        for label, spec in metrics.items()
    ]
    grouped = rows.groupBy(*dims)
    result = grouped.agg(*computed)
    if limit is None:
        return result
    labels = list(metrics)
    order = [F.col(labels[0]).desc_nulls_last()]
    order += [F.col(c).asc_nulls_first() for c in result.columns if c not in labels]
    return result.orderBy(*order).limit(limit)


# Public names of time grains, as a dashboard stores them.
GRAINS = {
    "PT1S": "second",
    "PT1M": "minute",
    "PT1H": "hour",
    "P1D": "day",
    "P1W": "week",
    "P1M": "month",
    "P3M": "quarter",
    "P1Y": "year",
}
# What a chart's parameters may say about its data, and what they say about its looks alone.
DATA_KEYS = frozenset({"metric", "metrics", "groupby", "x_axis", "time_grain_sqla", "adhoc_filters", "row_limit"})
LOOKS_KEYS = frozenset({"datasource", "viz_type", "stack", "slice_id", "dashboards", "color_scheme", "show_legend"})


def _spec(given: Mapping) -> tuple[str, tuple[str, str] | str]:
    """(label, metric) of a stored metric: an aggregate of a column, or a SQL expression with its label."""
    if given["expressionType"] == "SQL":
        return given.get("label") or given["sqlExpression"], given["sqlExpression"]
    kind, column = given["aggregate"], given["column"]["column_name"]
    return given.get("label") or f"{kind}({column})", (kind, column)


def _condition(given: Mapping) -> str:
    if given["expressionType"] != "SQL" or given.get("clause", "WHERE") != "WHERE":
        raise ValueError("only SQL filters on rows are supported")
    return f"({given['sqlExpression']})"


def from_params(df: DataFrame, params: Mapping) -> DataFrame:
    """The rows behind a chart, from the parameters a dashboard stores for it.

    Groups are the x axis, cut to the time grain if there is one, and the `groupby` columns. `row_limit` keeps the rows
    with the largest first metric. A parameter that is not supported is an error: the chart would show something else.
    """
    unknown = sorted(set(params) - DATA_KEYS - LOOKS_KEYS)
    if unknown:
        raise ValueError(f"not supported in a chart: {', '.join(unknown)}")
    dims: list[str | Column] = list(params.get("groupby", []))
    axis, grain = params.get("x_axis"), params.get("time_grain_sqla")
    if axis is not None:
        dims.insert(0, axis if grain is None else F.date_trunc(GRAINS[grain], axis).alias(axis))
    stored = list(params.get("metrics", [])) + ([params["metric"]] if "metric" in params else [])
    where = " AND ".join(map(_condition, params.get("adhoc_filters", []))) or None
    return metric(df, dims, dict(map(_spec, stored)), where, params.get("row_limit"))


def compliance_by_institution(report: DataFrame, limit: int | None = None) -> DataFrame:
    return metric(
        report,
        ["institution_id", "compliance_status"],
        {"avg_compliance_rate_pct": ("avg_hundredths", "compliance_rate_pct")},
        limit=limit,
    )


def vendor_concentration(vendor_risk: DataFrame, limit: int | None = None) -> DataFrame:
    return metric(
        vendor_risk,
        ["concentration_risk_tier", "ict_third_party_provider"],
        {"sum_institutions_exposed": ("sum", "institutions_exposed")},
        limit=limit,
    )


def breach_timeline(breaches: DataFrame, limit: int | None = None) -> DataFrame:
    return metric(
        breaches,
        [F.date_format(F.date_trunc("day", "detection_timestamp"), "yyyy-MM-dd").alias("detection_day")],
        {"breach_count": "count(*)"},
        where="sla_breached = true",
        limit=limit,
    )


def volume_by_period(report: DataFrame, limit: int | None = None) -> DataFrame:
    return metric(
        report,
        ["reporting_period"],
        {
            f"sum_incident_count_{tier}": ("sum", f"incident_count_{tier}")
            for tier in ("critical", "major", "minor")
        },
        limit=limit,
    )
