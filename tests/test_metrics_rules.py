"""Filled spines, entity paths, distinct counts by bitmaps, daily sums and rules from files."""

import datetime as dt
import json

import pytest

from starloom.operators import customers, distinct_counts, lookups
from starloom.operators.metrics import Measure, Metric, MetricLayer, SemanticModel
from starloom.operators.rule_files import BUILT_IN, read_rules
from starloom.operators.rules import IROPS_HEAVY
from starloom.sources.writers import write_by_month


def layer(spark, **tables):
    models = [
        SemanticModel("a", "a", "day", ("a", "a_id"), {"b": "b_id"}, {"kind": "kind"}, [Measure("n", "1")]),
        SemanticModel("b", "b", "day", ("b", "b_id"), {"c": "c_id", "owner": "owner_id"}, {}, []),
        SemanticModel("c", "c", "day", ("c", "c_id"), {}, {"name": "upper(name)"}, []),
    ]
    return MetricLayer(tables, models, {"n": Metric("n", "simple", measure="n")})


@pytest.fixture
def tables(spark):
    day = dt.date
    a = [(1, 10, "x", day(2024, 1, 1)), (2, 10, "x", day(2024, 1, 4)), (3, 11, None, day(2024, 1, 2)), (4, 99, None, day(2024, 1, 2)), (5, None, "y", None)]
    return {
        "a": spark.createDataFrame(a, "a_id int, b_id int, kind string, day date"),
        "b": spark.createDataFrame([(10, 7, "o1"), (11, 8, "o2")], "b_id int, c_id int, owner_id string"),
        "c": spark.createDataFrame([(7, "seven"), (8, None)], "c_id int, name string"),
    }


def test_entity_paths(spark, tables):
    got = layer(spark, **tables).query(["n"], ["c__name", "b__owner", "b__c"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [("SEVEN", "o1", 7, 2), (None, "o2", 8, 1), (None, None, None, 2)])
    )
    for wrong in ("d__name", "c__size", "owner__x"):
        with pytest.raises(ValueError):
            layer(spark, **tables).query(["n"], [wrong])
    twice = {**tables, "b": tables["b"].unionAll(tables["b"])}
    with pytest.raises(Exception, match="not unique"):
        layer(spark, **twice).query(["n"], ["c__name"]).collect()


def test_several_ways_are_refused(spark, tables):
    found = layer(spark, **tables)
    first = found.models[0]
    also = SemanticModel("d", "b", "day", ("d", "b_id"), {"c": "c_id"}, {}, [])
    first = SemanticModel("a", "a", "day", ("a", "a_id"), {"b": "b_id", "d": "b_id"}, {}, [Measure("n", "1")])
    found.models[0] = first
    found.models.append(also)
    with pytest.raises(ValueError, match="several ways"):
        found.query(["n"], ["c__name"])


def test_spine_fills_each_group_between_its_ends(spark, tables):
    spine = spark.sql("select explode(sequence(date '2024-01-01', date '2024-01-31')) as date_day")
    got = layer(spark, **tables).query(["n"], ["kind"], grain="day", spine=spine)
    day = lambda d: dt.date(2024, 1, d)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [(day(1), "x", 1), (day(2), "x", None), (day(3), "x", None), (day(4), "x", 1), (day(2), None, 2)])
    )


def test_bitmaps_roll_up(spark):
    rows = [(f"c{i * 7 % 90_000}" if i % 50 else None, dt.date(2024, 1 + i % 12, 1 + i % 28)) for i in range(100_000)]
    facts = spark.createDataFrame(rows, "who string, day date")
    bitmaps, numbers = distinct_counts.stored_bitmaps(facts, "who", "day")
    known = {r.value: r.number for r in numbers.collect()}
    assert sorted(known.values()) == list(range(1, len(known) + 1))
    for grain, period in (("month", lambda d: d.month), ("quarter", lambda d: (d.month - 1) // 3 * 3 + 1), ("year", lambda d: 1)):
        want = {}
        for who, d in rows:
            want.setdefault(period(d), []).append(who)
        got = {r.metric_time.month: (r.n_rows, r.n_distinct) for r in distinct_counts.distinct_by(bitmaps, grain).collect()}
        assert got == {p: (len(w), len({x for x in w if x})) for p, w in want.items()}
    more = distinct_counts.numbered(spark.createDataFrame([("new",), ("c7",), (None,)], "who string"), numbers)
    later = {r.value: r.number for r in more.collect()}
    assert later == {**known, "new": len(known) + 1}
    with pytest.raises(ValueError):
        distinct_counts.distinct_by(bitmaps, "week")


def test_daily_sums_read_only_the_last_months(spark, tmp_path):
    day = dt.date(2023, 1, 1)
    rows = [(f"c{i % 5}", day + dt.timedelta(days=i * 3), "Flown", 1.0, 0.5) for i in range(300)]
    rows += [(None, day, "Flown", 2.0, 0.0), ("c9", day, "Cancelled", 2.0, 0.0)]
    bookings = spark.createDataFrame(
        rows, "customer_id string, booking_date date, booking_status string, p double, a double"
    ).selectExpr(
        "customer_id", "booking_date", "booking_status", "cast(p as decimal(10,2)) as ticket_price_usd",
        "cast(a as decimal(10,2)) as ancillary_revenue_usd",
    )
    daily = write_by_month(customers.daily_spend(bookings), str(tmp_path / "d"), "booking_date")
    ours = customers.rfm_base_of_days(daily)
    names = ours.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, customers.rfm_base(bookings).select(names).collect()))
    assert "PartitionFilters: [isnotnull(in_month" in ours._jdf.queryExecution().executedPlan().toString()
    assert customers.rfm_base_of_days(daily.where("false")).count() == 0


def test_rule_files(spark, tmp_path):
    rules = read_rules()
    assert set(rules) == set(json.loads(BUILT_IN.read_text()))
    frame = spark.createDataFrame(
        [("a", 0.9, 0.01), ("b", 0.1, 0.06), ("c", 0.1, 0.05), ("d", None, 0.2), ("e", None, None)],
        "route_id string, disruption_percentile double, cancellation_rate_12m double",
    )
    ours = [r.route_id for r in rules["IROPSHeavyRoute"].apply(frame).collect()]
    assert sorted(ours) == sorted(r.route_id for r in IROPS_HEAVY.apply(frame).collect()) == ["a", "b", "d"]
    with pytest.raises(ValueError, match="not there"):
        rules["IROPSHeavyRoute"].apply(frame.drop("cancellation_rate_12m"))
    for wrong in (
        {"X": {"all": [["a", "~", 1]]}}, {"X": {"all": [["a", ">"]]}}, {"X": {"all": [["a", ">", [1]]]}},
        {"X": {}}, {"X": {"some": [["a", ">", 1]]}},
    ):
        path = tmp_path / "rules.json"
        path.write_text(json.dumps(wrong))
        with pytest.raises(ValueError):
            read_rules(path)


def test_capped_frame(spark):
    for n, more in ((9, False), (10, False), (11, True)):
        rows = lookups.capped_frame(spark.range(n), ["id"], cap=10).collect()
        assert len(rows) == min(n, 10) and {r.truncated for r in rows} == {more}
    assert lookups.capped_frame(spark.range(0), ["id"], cap=10).count() == 0
