import pytest

from starloom.plans import register
from starloom.plans.register import QUERIES, questions, warehouse
from starloom.plans.warehouse import FACT_DAYS

TABLES = {
    "region": (5, "id as r_regionkey, concat('G', id) as r_name"),
    "nation": (25, "id as n_nationkey, concat('N', id) as n_name, id % 5 as n_regionkey"),
    "supplier": (4, "id as s_suppkey, concat('S', id) as s_name, id as s_nationkey, id * 9.5d as s_acctbal"),
    "customer": (
        12, "id as c_custkey, concat('C', id) as c_name, id as c_nationkey, id * 800d as c_acctbal, "
        "if(id % 2 = 0, 'BUILDING', 'MACHINERY') as c_mktsegment",
    ),
    "part": (30, "id as p_partkey, cast(id * 7 % 50 + 1 as int) as p_size, 900d + id as p_retailprice"),
    "orders": (
        300, "id as o_orderkey, if(id % 11 = 5, null, id % 14) as o_custkey, if(id % 3 = 0, 'O', 'F') as o_orderstatus, "
        "1000d + id * 3.25 as o_totalprice, "
        "cast(date_add(date '1996-01-01', cast(id * 5 as int)) as timestamp_ntz) as o_orderdate, "
        "if(id % 2 = 0, '1-URGENT', '2-HIGH') as o_orderpriority",
    ),
    "lineitem": (
        500, "id % 320 as l_orderkey, id % 30 as l_partkey, id % 4 as l_suppkey, id as l_linenumber, "
        "cast(id % 50 as double) as l_quantity, 100d + id as l_extendedprice, if(id % 2 = 0, 'A', 'N') as l_returnflag, "
        "cast(date_add(date '1996-01-01', cast(id as int)) as timestamp_ntz) as l_shipdate",
    ),
    "events": (
        200, "id as event_id, timestamp_ntz '2024-01-05 10:00:00' as ts, id % 13 as user_id, "
        "if(id % 5 = 0, 'error', 'view') as event_type, id * 0.75d as value",
    ),
    "documents": (60, "id as doc_id, concat('the crew was of horrible ', id) as text, if(id % 2 = 0, 'en', 'fr') as lang"),
}


@pytest.fixture(scope="module", params=["once", "twice"])
def inputs(request, spark, tmp_path_factory):
    """Small tables; in the second set some customers and parts are there twice."""
    folder = tmp_path_factory.mktemp(request.param)
    for name, (n, columns) in TABLES.items():
        rows = spark.sql(f"select {columns} from range({n})")
        if request.param == "twice" and name in ("customer", "part"):
            rows = rows.union(rows.limit(5))
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder), request.param == "twice"


@pytest.mark.parametrize(
    "fact, columns",
    [
        ("fct_flights", "flight_sk flight_date flight_status pax_count total_revenue_usd route_type"),
        ("fct_bookings", "booking_id booking_date customer_id fare_class total_booking_revenue_usd in_month"),
        ("fct_bookings", "booking_sk booking_date route_id flight_sk flight_date"),
        ("fct_ancillary_offers", "ancillary_offer_sk offer_date offer_type accepted_revenue_usd"),
        ("fct_ancillary_offers", "ancillary_offer_sk loyalty_tier"),
        ("fct_bookings", "booking_id loyalty_tier_at_booking customer_segment_at_booking customer_version_sk"),
        ("fct_loyalty_events", "loyalty_event_sk customer_sk"),
        ("fct_loyalty_events", "loyalty_event_id event_date points_earned route_sk"),
        ("fct_customer_feedback", "feedback_id feedback_date route_id sentiment_score"),
        ("fct_customer_feedback", "feedback_id flight_sk language"),
    ],
)
def test_a_question_reads_the_rows_of_the_built_fact(spark, inputs, fact, columns):
    folder, twice = inputs
    tables = questions(warehouse(spark, folder))
    assert tables.warehouse.customers_repeat() == twice
    built = warehouse(spark, folder)[fact].selectExpr("*", f"trunc({FACT_DAYS[fact]}, 'month') as in_month")
    ours, expected = (sorted(map(str, df.select(*columns.split()).collect())) for df in (tables.asked(fact, columns), built))
    assert ours == expected and ours


@pytest.mark.parametrize(
    "query",
    [
        "metrics_across_models", "page_bookings_in_peak_season", "metrics_by_week_where", "lookup_capped_rows",
        "report_attach_rate_by_segment", "report_upgrade_conversion_by_tier",
    ],
)
def test_a_question_builds_no_fact(spark, inputs, query):
    folder, _ = inputs
    register._MARTS.clear()
    first = QUERIES[query](spark, folder).collect()
    assert not [name for _, done in register._MARTS.values() for name in done if name.startswith(("fct_", "int_"))]
    assert sorted(map(str, QUERIES[query](spark, folder).collect())) == sorted(map(str, first))


def test_joins_that_add_nothing_are_left_out(spark, inputs):
    folder, twice = inputs
    text = questions(warehouse(spark, folder)).asked("fct_bookings", "booking_id").select("booking_id")
    assert ("Join LeftOuter" in text._jdf.queryExecution().optimizedPlan().toString()) == twice
