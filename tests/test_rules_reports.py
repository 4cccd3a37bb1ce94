import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import lookups, reports, rules
from starloom.operators.metrics import Measure, MetricLayer, SemanticModel


def monthly(frame, months, route="R1"):
    rows = [(route, dt.date(2024 + (m - 1) // 12, (m - 1) % 12 + 1, 1), 10, 8, 10, 100.0, 40.0) for m in range(1, months + 1)]
    df = frame(rows, "route_id string, period_month date, flights_operated long, total_pax long, total_seat_capacity long, r double, c double")
    return df.selectExpr(
        "route_id", "period_month", "flights_operated", "total_pax", "total_seat_capacity",
        "cast(r as decimal(38,2)) as revenue_usd", "cast(c as decimal(38,2)) as operating_cost_usd",
        "cast(r - c as decimal(38,2)) as margin_usd", "0.1D as cancellation_rate", "0.9D as otp15_rate",
    )


def test_window_of_the_rule_keeps_thirteen_months(frame):
    routes = frame([("R1", "Domestic", "short_haul", True)], "route_id string, route_type string, distance_band string, is_strategic boolean")
    (row,) = rules.strategic_underperforming(monthly(frame, 14), routes).collect()
    assert row.flights_operated_12m == 130


def test_window_of_the_lookup_keeps_twelve(frame):
    (row,) = lookups.routes_with_kpis(monthly(frame, 14)).collect()
    assert row.revenue_usd == 1200
    assert (row.margin_pct, row.load_factor) == (0.6, 0.8)


def test_route_without_margin_ranks_last(frame):
    routes = frame([(r, "Domestic", "short_haul", True) for r in ("R1", "R2")], "route_id string, route_type string, distance_band string, is_strategic boolean")
    both = monthly(frame, 3).unionByName(monthly(frame, 3, "R2").withColumn("revenue_usd", F.lit(0).cast("decimal(38,2)")))
    assert [r.route_id for r in rules.strategic_underperforming(both, routes).collect()] == ["R1"]


def test_or_rule(frame):
    rule = rules.Rule("X", {"a": "> 1", "b": "> 1"}, logic="OR", always=["c = 'y'"])
    df = frame([(2, 0, "y"), (0, 2, "y"), (0, 0, "y"), (2, 2, "n")], "a int, b int, c string")
    got = rule.apply(df)
    assert got.count() == 2
    assert {"ontology_concept", "inferred_at"} <= set(got.columns)


def test_lookup_arguments(frame):
    df = monthly(frame, 2)
    for bad in ({"period_months": 0}, {"period_months": 25}, {"limit": 51}):
        with pytest.raises(ValueError):
            lookups.routes_with_kpis(df, **bad)
    with pytest.raises(ValueError):
        lookups.search_feedback(df, sentiment="angry")


def test_row_cap(spark):
    rows, cut = lookups.capped(spark.range(10), cap=10)
    assert len(rows) == 10 and cut
    assert lookups.capped(spark.range(10), cap=10, exact=True)[1] is False
    assert lookups.capped(spark.range(11), cap=10, exact=True)[1] is True


def test_page_filters(frame):
    tables = {"int_route_monthly_perf": monthly(frame, 6).unionByName(monthly(frame, 6, "R2"))}
    got = reports.report("revenue_by_route", tables, dt.date(2024, 2, 1), dt.date(2024, 4, 1), ["R2"]).collect()
    assert [(r.route_id, float(r.revenue)) for r in got] == [("R2", 200.0)]


def test_date_filter_reaches_the_scan(spark, frame, tmp_path):
    monthly(frame, 6).write.parquet(str(tmp_path / "t"))
    tables = {"int_route_monthly_perf": spark.read.parquet(str(tmp_path / "t"))}
    df = reports.report("revenue_by_route", tables, dt.date(2024, 2, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period_month" in plan
    assert "TakeOrderedAndProject" in plan
    assert "operating_cost" not in plan  # pruned


def test_matrix_totals(frame):
    df = frame([("A", "Gold"), ("A", "Gold"), ("B", "non_member")], "customer_segment string, loyalty_tier_safe string")
    got = {r.segment: (r.Gold, r.non_member, r.total) for r in reports.segment_matrix(df).collect()}
    assert got == {"A": (2, 0, 2), "B": (0, 1, 1), "Total": (2, 1, 3)}


def model(name, table, primary, foreign, dimensions, measures):
    return SemanticModel(name, table, "day", primary, foreign, {d: d for d in dimensions}, measures)


def test_entity_join_refuses_fan_out(frame):
    facts = frame([("x", 1), ("y", 2)], "k string, v int").withColumn("day", F.lit(dt.date(2024, 1, 1)))
    good = frame([("x", "red"), ("y", "blue")], "k string, colour string")
    models = [
        model("f", "facts", ("f", "k"), {"thing": "k"}, [], [Measure("vs", "v")]),
        model("t", "things", ("thing", "k"), {}, ["colour"], []),
    ]
    from starloom.operators.metrics import Metric

    metrics = {"vs": Metric("vs", "simple", measure="vs")}
    layer = MetricLayer({"facts": facts, "things": good}, models, metrics)
    assert {r.thing__colour: r.vs for r in layer.query(["vs"], ["thing__colour"]).collect()} == {"red": 1, "blue": 2}
    twice = MetricLayer({"facts": facts, "things": good.union(good)}, models, metrics)
    with pytest.raises(Exception, match="not unique"):
        twice.query(["vs"], ["thing__colour"]).collect()


def test_unknown_names_are_refused(frame):
    layer = MetricLayer({})
    with pytest.raises(KeyError):
        layer.query(["no_such_metric"])
    with pytest.raises(ValueError):
        layer.query(["m_revenue"], grain="decade")
