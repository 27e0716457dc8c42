"""Dimension/metric model over a table.

A query names metrics and dimensions; it becomes one
``groupBy(dimensions).agg(default aggregations)`` -- no SQL text is
generated or parsed.  Unknown names are rejected.  Note that metrics over an
already-aggregated table (e.g. AVG of daily averages) are not additive; they
are computed as defined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.money import avg_usd, to_cents


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    agg: str            # avg | min | max | sum | count
    money: bool = False  # avg computed exactly in cents, rounded half-up


@dataclass(frozen=True)
class SemanticTable:
    name: str
    dimensions: dict[str, str]
    measures: dict[str, Measure] = field(default_factory=dict)


def _m(name, agg, money=False, expr=None):
    return name, Measure(name, expr or name, agg, money)


# --- fixed values: dimension and measure names of the serving tables with
# their default aggregations ---
MODEL = {
    "hourly_route_summary": SemanticTable(
        "hourly_route_summary",
        {d: d for d in ("route_id", "origin", "destination", "date", "season", "is_weekend")},
        dict([_m("avg_price", "avg", True), _m("min_price", "min"), _m("max_price", "max"),
              _m("airline_count", "max"), _m("total_anomalies", "sum")])),
    "route_stats": SemanticTable(
        "route_stats",
        {d: d for d in ("route_id", "origin", "destination", "date", "cheapest_airline")},
        dict([_m("min_price_usd", "min"), _m("avg_price_usd", "avg", True),
              _m("airline_count", "max")])),
}
# --- end of fixed values ---


def _agg(m: Measure) -> Column:
    c = F.col(m.expr)
    if m.agg == "avg" and m.money:
        return avg_usd(F.sum(to_cents(c)), F.count(c))
    fn = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}.get(m.agg)
    if fn is None:
        raise ValueError(f"unknown aggregation {m.agg!r} for {m.name}")
    return fn(c)


def semantic_query(df: DataFrame, table: SemanticTable, metrics: list[str],
                   dimensions: list[str] | None = None, where: Column | None = None,
                   order: list[tuple[str, bool]] | None = None,
                   limit: int | None = None) -> DataFrame:
    dimensions = list(dimensions or [])
    unknown = [m for m in metrics if m not in table.measures] + \
              [d for d in dimensions if d not in table.dimensions]
    if unknown:
        raise KeyError(f"unknown names for {table.name}: {unknown}")
    src = df.filter(where) if where is not None else df
    aggs = [_agg(table.measures[m]).alias(m) for m in metrics]
    keys = [F.col(table.dimensions[d]).alias(d) for d in dimensions]
    out = src.groupBy(*keys).agg(*aggs) if keys else src.agg(*aggs)
    if order:
        out = out.orderBy(*[F.col(c).desc() if desc else F.col(c).asc() for c, desc in order])
    if limit is not None:
        out = out.limit(limit)
    return out


def load_model(path: str) -> dict[str, SemanticTable]:
    """Read a YAML model (tables -> dimensions / measures with
    ``default_aggregation``); needs PyYAML.  Averages of prices (``money``, or
    a name with "price" in it) are exact, as in MODEL."""
    try:
        import yaml  # type: ignore
    except ImportError as err:  # pragma: no cover
        raise RuntimeError("PyYAML is not installed; use MODEL") from err
    with open(path) as fh:
        doc = yaml.safe_load(fh)
    out = {}
    for t in doc.get("tables", []):
        dims = {d["name"]: d.get("expr", d["name"]).lower() for d in t.get("dimensions", [])}
        meas = {m["name"]: Measure(m["name"], m.get("expr", m["name"]).lower(),
                                   m.get("default_aggregation", "sum"),
                                   bool(m.get("money", "price" in m["name"].lower())))
                for m in t.get("measures", [])}
        out[t["name"]] = SemanticTable(t["name"], dims, meas)
    return out
