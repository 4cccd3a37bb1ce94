import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.functions.quantiles import quantiles
from starloom.functions.ranks import Rank, add_ranks

RANKS = [
    Rank("p_up", "v"),
    Rank("p_down", "v", descending=True),
    Rank("n_up", "v", "ntile"),
    Rank("n_down", "v", "ntile", descending=True),
    Rank("p_money", "money"),
    Rank("n_money", "money", "ntile", tiles=7),
]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, some are null, the rest repeat little."""
    pick = random.Random(7)
    rows = []
    for i in range(1503):
        value = 40 if i % 3 == 0 else None if i % 11 == 0 else pick.randrange(900)
        rows.append((f"k{i}", value, None if value is None else f"{pick.randrange(500)}.25"))
    df = spark.createDataFrame(rows, "k string, v int, money string")
    return df.withColumn("money", F.col("money").cast("decimal(38,2)")).cache()


def as_map(df):
    return {r.k: tuple(r[x.name] for x in RANKS) for r in df.collect()}


def in_one_window(df):
    """The same ranks by windows over the whole table."""
    for rank in RANKS:
        if rank.kind == "ntile":
            order = Window.orderBy(rank.order(), F.md5("k"))
            df = df.withColumn(rank.name, F.ntile(rank.tiles).over(order))
        else:
            df = df.withColumn(rank.name, F.percent_rank().over(Window.orderBy(rank.order())))
    return df


def test_ranges_agree_with_one_window(skewed):
    assert as_map(add_ranks(skewed, "k", RANKS)) == as_map(in_one_window(skewed))


def test_no_window_over_all_rows(skewed):
    """Only the table of ranges, a row each, may be walked in one task."""
    ranked = add_ranks(skewed, "k", RANKS)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_range" in line for line in windows)


def test_single_row_and_all_ties(frame):
    one = add_ranks(frame([("a", 5)], "k string, v int"), "k", [Rank("p", "v")])
    assert one.first().p == 0.0
    ties = add_ranks(frame([(f"k{i}", 5) for i in range(30)], "k string, v int"), "k", [Rank("p", "v")])
    assert {r.p for r in ties.collect()} == {0.0}


def test_nulls_come_last(frame):
    df = frame([("a", 1), ("b", None), ("c", 2)], "k string, v int")
    found = {r.k: r.p for r in add_ranks(df, "k", [Rank("p", "v")]).collect()}
    assert found == {"a": 0.0, "c": 0.5, "b": 1.0}


def test_quantiles(frame):
    pick = random.Random(3)
    values = [pick.random() if i % 3 else 0.5 for i in range(3000)]
    df = frame([(v,) for v in values] + [(None,)], "v double")
    found = quantiles(df, "v", [0.1, 0.5, 0.9])
    ordered = sorted(values)
    for share, value in found.items():
        at = share * (len(ordered) - 1)
        low = int(at)
        wanted = ordered[low] + (ordered[min(low + 1, len(ordered) - 1)] - ordered[low]) * (at - low)
        assert value == pytest.approx(wanted, abs=1e-12)


def test_quantiles_of_nothing(frame):
    assert quantiles(frame([(None,)], "v double"), "v", [0.5]) == {0.5: None}
