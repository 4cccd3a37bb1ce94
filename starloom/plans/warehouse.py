"""The tables of the star schema, wired from inputs to concepts."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.frames import repeats
from starloom.functions.text import Vocabulary
from starloom.operators import customers as cust
from starloom.operators import dimensions as dim
from starloom.operators import facts, feedback, flights, quality, rules, scd2
from starloom.session import materialise, prepare
from starloom.sources.readers import stage
from starloom.sources.schemas import SOURCES
from starloom.sources.writers import MONTH, in_months, replace_months, write_by_month, write_table


class Warehouse(Mapping):
    """Every table by name, built on first use.

    ``inputs(name)`` gives one of the fourteen raw inputs. Indexing gives a lazy
    frame. ``written(name)`` gives the frame as a table in the shared folder, for steps
    that read it more than once. ``history`` gives the customer history so far; without
    one the first snapshot is taken at ``snapshot_at``.
    """

    def __init__(
        self,
        spark: SparkSession,
        inputs: Callable[[str], DataFrame],
        vocabulary: Vocabulary,
        today: dt.date,
        snapshot_at: dt.datetime,
        history: Callable[[], DataFrame] | None = None,
    ):
        self.spark = prepare(spark)
        self.inputs = inputs
        self.vocabulary = vocabulary
        self.today = today
        self.snapshot_at = snapshot_at
        self.history = history
        self._frames: dict[str, DataFrame] = {}
        self._written: dict[str, DataFrame] = {}
        self.stored: TablesOnDemand | None = None  # where tables are written when asked for

    def __iter__(self) -> Iterator[str]:
        return iter([*(f"stg_{s}" for s in SOURCES), *_BUILDERS])

    def __len__(self) -> int:
        return len(SOURCES) + len(_BUILDERS)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._written:
            return self._written[name]
        if self.stored is not None and name in list(self.stored):
            return self.stored[name]
        return self.made(name)

    def made(self, name: str) -> DataFrame:
        """The lazy frame of a table, whether or not it is written."""
        if name not in self._frames:
            if name in SOURCES:
                self._frames[name] = self.inputs(name)
            elif name.startswith("stg_"):
                self._frames[name] = stage(self[name[4:]], name[4:])
            else:
                self._frames[name] = _BUILDERS[name](self)
        return self._frames[name]

    def written(self, name: str) -> DataFrame:
        if self.stored is not None and name in list(self.stored):
            return self.stored[name]
        if name not in self._written:
            self._written[name] = materialise(self[name], name)
        return self._written[name]

    def rows(self, fact: str) -> DataFrame:
        """A fact before ``FACT_COLUMNS`` adds what follows from each row alone."""
        return self[f"{fact}_rows"]

    def customers_repeat(self) -> bool:
        """Whether ``dim_customer_current`` holds a customer twice. A customer has one open
        version after a snapshot if there was one before it, and one in the input, at most."""
        if repeats(self["stg_customers"], "customer_id"):
            return True
        return self.history is not None and repeats(scd2.current(self.history()), "customer_id")

    def build(self, folder: str, at_once: int = 4, check: bool = False) -> dict[str, DataFrame]:
        """Write every table to a new version below ``folder``, each from the tables written
        before it, then make that version the current one.

        Tables of one step do not read each other; a few are written at the same time
        so that small ones do not leave the cluster idle. Nothing of an earlier version is
        touched, so a build that fails leaves it readable, and the customer history may be
        read from it (``stored_history``). With ``check`` the declared checks run before the
        switch, and a violated rule on keys stops it.
        """
        version = f"{self.snapshot_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        built: dict[str, DataFrame] = {}
        with ThreadPoolExecutor(at_once) as pool:
            for step in _STEPS:
                writes = {
                    name: pool.submit(_write, self, name, f"{folder}/{version}/{name}") for name in step
                }
                for name, write in writes.items():
                    built[name] = self._written[name] = write.result()
        if check:
            broken = quality.run_checks(self, quality.MART_CHECKS + quality.CONCEPT_CHECKS)
            broken = broken.where("not passed and rule in ('unique', 'not_null')").collect()
            if broken:
                raise ValueError(f"not switched to {version}: {[tuple(r) for r in broken]}")
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        pointer = self.spark.createDataFrame([(version, now)], "version string, built_at timestamp_ntz")
        pointer.coalesce(1).write.mode("append").parquet(f"{folder}/{_POINTER}")
        return built


    def replace_months(self, folder: str, months: list[dt.date], names: list[str] | None = None) -> None:
        """Write the rows of some months of the facts anew, in the current version; only the
        folders of these months change. Facts are built from the inputs of these months."""
        version = current_version(self.spark, folder)
        if version is None:
            raise ValueError(f"nothing is built below {folder}")
        for name in names or list(FACT_DAYS):
            day = FACT_DAYS[name]
            rows = self.rows(name).where(in_months(day, months))
            replace_months(rows, f"{version}/{name}", day, months, FACT_COLUMNS[name], name not in SPREAD_FACTS)


def _write(w: Warehouse, name: str, path: str) -> DataFrame:
    day = FACT_DAYS.get(name)
    if day is None:
        return write_table(w.made(name), path)
    if name in w._frames:  # made, or put there, before: written as it is
        return write_by_month(w._frames[name], path, day, deal=name not in SPREAD_FACTS)
    return write_by_month(w.rows(name), path, day, FACT_COLUMNS[name], name not in SPREAD_FACTS)


class StoredTables(Mapping):
    """The tables of a built version by name, read from their files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._frames: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter([name for step in _STEPS for name in step])

    def __len__(self) -> int:
        return sum(len(step) for step in _STEPS)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self._frames[name]


class TablesOnDemand(StoredTables):
    """The tables of a version, each written when it is first asked for, from the tables it
    reads, which are written before it. ``done`` holds the names that are written."""

    def __init__(self, warehouse: Warehouse, path: str, done: set[str]):
        super().__init__(warehouse.spark, path)
        self.warehouse, self.done = warehouse, done
        warehouse.stored = self

    def __getitem__(self, name: str) -> DataFrame:
        if name not in list(self):
            raise KeyError(name)
        if name not in self.done:
            _write(self.warehouse, name, f"{self.path}/{name}")
            self.done.add(name)
        return super().__getitem__(name)


class AskedTables(TablesOnDemand):
    """Tables on demand, and facts for one question (``asked``), of which nothing is written.

    A left join that adds no column asked for can only repeat rows. Where its keys do not
    repeat, which is looked up over the keys alone, it is left out.
    """

    def __init__(self, warehouse: Warehouse, path: str, done: set[str]):
        super().__init__(warehouse, path, done)
        self._repeating: dict[str, bool] = {}

    def asked(self, name: str, text: str) -> DataFrame:
        """A table with the columns that the text names, as words; others may be missing. Facts
        are made from the inputs as the question runs."""
        if name not in FACT_DAYS:
            return self[name]
        w = self.warehouse
        if name == "fct_flights":
            rows = facts.flight_joins(w.made("int_flight_full"), w["dim_route"], w.made("dim_aircraft"), w["dim_airport"])
            return _in_month(name, rows)
        customers, left_out = None, list(_OF_CUSTOMERS)
        if known := _names(text, *_OF_CUSTOMERS):
            left_out = []
        if known or self._repeat("customers", w.customers_repeat):
            customers = dim.dim_customer_current(scd2.current(w.made("dim_customer_snapshot")), w.today)
        if name == "fct_loyalty_events":
            rows = facts.loyalty_rows(w["stg_loyalty_activity"], customers, w["dim_route"])
            return _in_month(name, rows).drop(*left_out)
        if name == "fct_ancillary_offers":
            rows = facts.offer_rows(w["stg_ancillary_offers"], w["stg_bookings"], customers)
            return _in_month(name, rows).drop(*left_out)
        of_flight = facts.OF_FLIGHT if name == "fct_bookings" else ["flight_sk"]
        keys = w.made("flight_keys")
        flights = keys
        if not _names(text, *of_flight) and not self._repeat("flights", lambda: repeats(keys, "flight_id")):
            flights = None
            left_out += of_flight
        if name == "fct_bookings":
            history = w.made("dim_customer_snapshot") if known else None
            rows = facts.bookings_alone(w["stg_bookings"], history, customers, flights)
        else:
            met = None if flights is None else w["stg_flights"]
            rows = facts.feedback_rows(w.made("feedback_read"), customers, w["dim_route"], met)
        return _in_month(name, rows).drop(*left_out)

    def _repeat(self, what: str, look: Callable[[], bool]) -> bool:
        if what not in self._repeating:
            self._repeating[what] = look()
        return self._repeating[what]


def _names(text: str, *columns: str) -> bool:
    return any(re.search(rf"\b{column}\b", text, re.IGNORECASE) for column in columns)


def _in_month(fact: str, rows: DataFrame) -> DataFrame:
    """A fact as it is read from its files."""
    return rows.select(*FACT_COLUMNS[fact](), F.trunc(FACT_DAYS[fact], "month").alias(MONTH))


# What facts take from customers and their versions.
_OF_CUSTOMERS = (
    "customer_sk", "customer_segment", "loyalty_tier", "customer_version_sk",
    "loyalty_tier_at_booking", "customer_segment_at_booking",
)


def stored_tables(spark: SparkSession, folder: str) -> StoredTables:
    """The current version below ``folder``."""
    path = current_version(spark, folder)
    if path is None:
        raise ValueError(f"nothing is built below {folder}")
    return StoredTables(spark, path)


_POINTER = "_current"


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Path of the version built last below ``folder``; None before the first."""
    try:
        pointers = spark.read.schema("version string, built_at timestamp_ntz").parquet(f"{folder}/{_POINTER}")
        last = pointers.agg(F.max_by("version", "built_at")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return last and f"{folder}/{last}"


def stored_history(spark: SparkSession, folder: str) -> Callable[[], DataFrame] | None:
    """The customer history of the current version, for the next build; None at the first."""
    path = current_version(spark, folder)
    return path and (lambda: spark.read.parquet(f"{path}/dim_customer_snapshot"))


def _snapshot(w: Warehouse) -> DataFrame:
    if w.history is None:
        return scd2.first_snapshot(w["stg_customers"].drop("_loaded_at"), "customer_id", w.snapshot_at)
    incoming = w["stg_customers"].drop("_loaded_at")
    return scd2.merge_snapshot(w.history(), incoming, "customer_id", w.snapshot_at)


def _read(w: Warehouse) -> DataFrame:
    return feedback.understood(w["stg_customer_feedback"].drop("_loaded_at"), w.vocabulary)


_MOOD = ["feedback_id", "sentiment_raw", "polarised_word_count", "sentiment_score", "sentiment_label"]

_BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "dim_date": lambda w: dim.dim_date(w.spark),
    "metricflow_time_spine": lambda w: dim.days(w.spark),
    "dim_airport": lambda w: dim.dim_airport(w["stg_airports"]),
    "dim_aircraft": lambda w: dim.dim_aircraft(w["stg_aircraft"]),
    "dim_fare": lambda w: dim.dim_fare(w["stg_bookings"]),
    "dim_route": lambda w: dim.dim_route(w["stg_routes"], w["dim_airport"]),
    "dim_customer_snapshot": _snapshot,
    "dim_customer_current": lambda w: dim.dim_customer_current(
        scd2.current(w["dim_customer_snapshot"]), w.today
    ),
    "int_flight_passenger_count": lambda w: flights.passengers(w["stg_bookings"]),
    "int_flight_revenue": lambda w: flights.revenue(w["stg_bookings"]),
    "int_flight_full": lambda w: flights.flight_full(
        w["stg_flights"], w["stg_routes"], w["stg_flight_costs"], w["stg_bookings"],
        w["stg_disruptions"], w["stg_weather_daily"],
    ),
    "int_route_monthly_perf": lambda w: flights.route_monthly(w["int_flight_full"]),
    "rfm_base": lambda w: cust.rfm_base(w["stg_bookings"]),
    "int_customer_rfm": lambda w: cust.rfm(w.written("rfm_base")),
    "offers_per_customer": lambda w: cust.offers_per_customer(
        w["stg_bookings"], w["stg_ancillary_offers"]
    ),
    "int_customer_lifetime": lambda w: cust.lifetime(w["int_customer_rfm"], w["offers_per_customer"]),
    "int_feedback_tokens": lambda w: feedback.tokens(w["stg_customer_feedback"]),
    "feedback_read": _read,
    "int_feedback_sentiment": lambda w: w["feedback_read"].select(*_MOOD),
    "int_feedback_category": lambda w: w["feedback_read"].select(
        "feedback_id", "complaint_category", "all_categories"
    ),
    "int_feedback_tags": lambda w: w["feedback_read"].select("feedback_id", "semantic_tags"),
    "int_route_complaint_themes": lambda w: feedback.complaint_themes(w["feedback_read"]),
    "fct_flights_rows": lambda w: facts.flight_joins(
        w["int_flight_full"], w["dim_route"], w["dim_aircraft"], w["dim_airport"]
    ),
    "flight_keys": lambda w: facts.flight_keys(w["stg_flights"], w["dim_route"]),
    "fct_bookings_rows": lambda w: facts.booking_rows(
        w["stg_bookings"], w["dim_customer_snapshot"], w["dim_customer_current"], w["flight_keys"]
    ),
    "fct_ancillary_offers_rows": lambda w: facts.offer_rows(
        w["stg_ancillary_offers"], w["stg_bookings"], w["dim_customer_current"]
    ),
    "fct_loyalty_events_rows": lambda w: facts.loyalty_rows(
        w["stg_loyalty_activity"], w["dim_customer_current"], w["dim_route"]
    ),
    "fct_customer_feedback_rows": lambda w: facts.feedback_rows(
        w["feedback_read"], w["dim_customer_current"], w["dim_route"], w["stg_flights"]
    ),
    "fct_flights": lambda w: w.rows("fct_flights").select(*facts.flight_columns()),
    "fct_bookings": lambda w: w.rows("fct_bookings").select(*facts.booking_columns()),
    "fct_ancillary_offers": lambda w: w.rows("fct_ancillary_offers").select(*facts.offer_columns()),
    "fct_loyalty_events": lambda w: w.rows("fct_loyalty_events").select(*facts.loyalty_columns()),
    "fct_customer_feedback": lambda w: w.rows("fct_customer_feedback").select(*facts.feedback_columns()),
    "ont_high_value_at_risk_customer": lambda w: rules.high_value_at_risk(
        w.written("int_customer_lifetime"), w["fct_customer_feedback"]
    ),
    "ont_strategic_underperforming_route": lambda w: rules.strategic_underperforming(
        w.written("int_route_monthly_perf"), w["dim_route"]
    ),
    "ont_premium_upsell_candidate": lambda w: rules.premium_upsell(
        w["fct_ancillary_offers"], w["dim_customer_current"]
    ),
    "ont_loyal_detractor": lambda w: rules.loyal_detractor(
        w["dim_customer_current"], w["rfm_base"], w["fct_customer_feedback"]
    ),
    "ont_irops_heavy_route": lambda w: rules.irops_heavy(w["fct_flights"], w["dim_route"]),
}

# The facts, written by month of these columns.
FACT_DAYS = {
    "fct_flights": "flight_date",
    "fct_bookings": "booking_date",
    "fct_ancillary_offers": "offer_date",
    "fct_loyalty_events": "event_date",
    "fct_customer_feedback": "feedback_date",
}

FACT_COLUMNS = {
    "fct_flights": facts.flight_columns,
    "fct_bookings": facts.booking_columns,
    "fct_ancillary_offers": facts.offer_columns,
    "fct_loyalty_events": facts.loyalty_columns,
    "fct_customer_feedback": facts.feedback_columns,
}

# Many narrow rows, which the joins leave evenly spread: dealing them out by month would
# shuffle more than the joins themselves.
SPREAD_FACTS = ("fct_bookings", "fct_ancillary_offers", "fct_loyalty_events")

# What is written, step by step; the other names are steps inside these tables.
_STEPS = [
    [
        "dim_date", "metricflow_time_spine", "dim_airport", "dim_aircraft", "dim_fare",
        "dim_customer_snapshot", "int_flight_full", "rfm_base", "int_feedback_tokens", "feedback_read",
    ],
    [
        "dim_route", "dim_customer_current", "int_route_monthly_perf", "int_customer_rfm",
        "int_route_complaint_themes",
    ],
    [
        "int_customer_lifetime", "fct_flights", "fct_bookings", "fct_ancillary_offers",
        "fct_loyalty_events", "fct_customer_feedback",
    ],
    [
        "ont_high_value_at_risk_customer", "ont_strategic_underperforming_route",
        "ont_premium_upsell_candidate", "ont_loyal_detractor", "ont_irops_heavy_route",
    ],
]
