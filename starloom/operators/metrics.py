"""Semantic models over the facts and the metrics built from their measures."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.frames import asked


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    agg: str = "sum"

    def column(self, only: Column | None = None) -> Column:
        value = F.expr(self.expr)
        if only is not None:
            value = F.when(only, value)
        if self.agg == "sum":
            return F.sum(value)
        if self.agg == "average":
            return F.avg(value)
        if self.agg == "count_distinct":
            return F.countDistinct(value)
        raise ValueError(f"unknown aggregation {self.agg}")


@dataclass(frozen=True)
class SemanticModel:
    """A fact: its entities (join keys), dimensions and measures.

    ``primary`` names the entity the table is unique by; ``foreign`` maps the other
    entities to their columns. ``dimensions`` maps names to SQL expressions.
    """

    name: str
    table: str
    time: str
    primary: tuple[str, str]
    foreign: dict[str, str]
    dimensions: dict[str, str]
    measures: list[Measure]

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)


@dataclass(frozen=True)
class Metric:
    """``simple``: one measure. ``ratio``: two metrics. ``derived``: an expression over
    metrics. ``where`` limits the rows a simple metric counts."""

    name: str
    kind: str
    measure: str = ""
    numerator: str = ""
    denominator: str = ""
    expr: str = ""
    inputs: tuple[str, ...] = ()
    where: str = ""


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _when(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


# The five models.
MODELS = [
    SemanticModel(
        "flight", "fct_flights", "flight_date", ("flight", "flight_sk"),
        {"route": "route_sk", "aircraft": "aircraft_sk", "origin_airport": "origin_airport_sk",
         "destination_airport": "destination_airport_sk"},
        _same("flight_status", "route_type", "aircraft_type", "is_on_time_15", "is_cancelled",
              "has_disruption")
        | {"distance_band": "CASE WHEN distance_km < 800 THEN 'short_haul' "
                            "WHEN distance_km < 3500 THEN 'medium_haul' ELSE 'long_haul' END"},
        [
            Measure("flights_scheduled", "1"),
            Measure("flights_operated", _when("flight_status <> 'Cancelled'")),
            Measure("flights_cancelled", _when("flight_status = 'Cancelled'")),
            Measure("flights_on_time", _when("is_on_time_15")),
            Measure("pax_count", "pax_count"),
            Measure("seat_capacity_sum", "seat_capacity"),
            Measure("distance_km_total", "distance_km"),
            Measure("ticket_revenue_total", "ticket_revenue_usd"),
            Measure("ancillary_revenue_total", "ancillary_revenue_usd"),
            Measure("total_revenue", "total_revenue_usd"),
            Measure("total_operating_cost", "total_operating_cost_usd"),
            Measure("total_margin", "flight_margin_usd"),
        ],
    ),
    SemanticModel(
        "booking", "fct_bookings", "booking_date", ("booking", "booking_id"),
        {"customer": "customer_id", "flight": "flight_sk", "route": "route_sk", "fare": "fare_sk"},
        _same("fare_class", "fare_family", "booking_channel", "booking_status",
              "loyalty_tier_at_booking", "customer_segment_at_booking", "is_premium_cabin"),
        [
            Measure("bookings_count", "1"),
            Measure("flown_bookings_count", _when("is_flown")),
            Measure("ticket_revenue", "ticket_price_usd"),
            Measure("ancillary_revenue", "ancillary_revenue_usd"),
            Measure("total_booking_revenue", "total_booking_revenue_usd"),
            Measure("unique_customers", "customer_id", "count_distinct"),
            Measure("bookings_with_ancillary", _when("ancillary_revenue_usd > 0")),
        ],
    ),
    SemanticModel(
        "feedback", "fct_customer_feedback", "feedback_date", ("feedback", "feedback_sk"),
        {"customer": "customer_id", "route": "route_sk"},
        _same("sentiment_label", "complaint_category", "language", "feedback_channel"),
        [
            Measure("feedbacks_count", "1"),
            Measure("avg_sentiment_score", "sentiment_score", "average"),
            Measure("negative_feedback_count", _when("is_negative")),
            Measure("positive_feedback_count", _when("is_positive")),
        ],
    ),
    SemanticModel(
        "ancillary_offer", "fct_ancillary_offers", "offer_date", ("offer", "ancillary_offer_sk"),
        {"booking": "booking_id", "customer": "customer_id", "fare": "fare_sk"},
        _same("offer_type", "fare_class"),
        [
            Measure("offers_presented", _when("presented_flag")),
            Measure("offers_accepted", _when("accepted_flag")),
            Measure("ancillary_accepted_revenue", "accepted_revenue_usd"),
        ],
    ),
    SemanticModel(
        "loyalty_event", "fct_loyalty_events", "event_date", ("event", "loyalty_event_sk"),
        {"customer": "customer_id", "route": "route_sk"},
        _same("event_type", "tier_at_event"),
        [
            Measure("events_count", "1"),
            Measure("points_earned_total", "points_earned"),
            Measure("points_redeemed_total", "points_redeemed"),
        ],
    ),
]


def _helper(name: str, measure: str) -> Metric:
    return Metric(name, "simple", measure=measure)


# The helper metrics and the ten indicators.
METRICS = {
    metric.name: metric
    for metric in [
        _helper("m_revenue", "total_revenue"),
        _helper("m_margin", "total_margin"),
        _helper("m_pax", "pax_count"),
        _helper("m_seat_capacity", "seat_capacity_sum"),
        _helper("m_flights_scheduled", "flights_scheduled"),
        _helper("m_flights_operated", "flights_operated"),
        _helper("m_flights_cancelled", "flights_cancelled"),
        _helper("m_flights_on_time", "flights_on_time"),
        _helper("m_bookings", "bookings_count"),
        _helper("m_unique_customers", "unique_customers"),
        _helper("m_bookings_with_ancillary", "bookings_with_ancillary"),
        Metric("route_revenue", "simple", measure="total_revenue", where="flight_status <> 'Cancelled'"),
        Metric("route_margin_pct", "ratio", numerator="m_margin", denominator="m_revenue"),
        Metric("load_factor", "ratio", numerator="m_pax", denominator="m_seat_capacity"),
        Metric(
            "delay_rate", "derived", expr="1 - m_flights_on_time / nullif(m_flights_operated, 0)",
            inputs=("m_flights_on_time", "m_flights_operated"),
        ),
        Metric("cancellation_rate", "ratio", numerator="m_flights_cancelled", denominator="m_flights_scheduled"),
        Metric(
            "repeat_booking_rate", "derived",
            expr="(m_bookings - m_unique_customers) / nullif(m_bookings, 0)",
            inputs=("m_bookings", "m_unique_customers"),
        ),
        Metric("ancillary_attach_rate", "ratio", numerator="m_bookings_with_ancillary", denominator="m_bookings"),
        Metric("loyalty_engagement", "simple", measure="points_earned_total"),
        Metric("customer_sentiment", "simple", measure="avg_sentiment_score"),
        Metric("customer_count", "simple", measure="unique_customers"),
    ]
}

GRAINS = ("day", "week", "month", "quarter", "year")
_STEPS = {
    "day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month",
    "quarter": "interval 3 months", "year": "interval 1 year",
}


@dataclass
class MetricLayer:
    """Answers metric questions over a set of fact tables."""

    tables: Mapping[str, DataFrame]
    models: list[SemanticModel] = field(default_factory=lambda: list(MODELS))
    metrics: dict[str, Metric] = field(default_factory=lambda: dict(METRICS))

    def query(
        self,
        metrics: list[str],
        group_by: list[str] | None = None,
        grain: str | None = None,
        where: str | None = None,
        spine: DataFrame | None = None,
    ) -> DataFrame:
        """Metrics by dimensions and, with ``grain``, by ``metric_time``.

        All metrics of one model come from one aggregation. A dimension of another
        model is written ``entity__dimension`` and joined through that entity before
        grouping; the way there may take several entities. ``where`` filters rows by the
        names in ``group_by`` and the fact's own columns. ``spine`` (one ``date_day`` per
        row, so that its periods are few) adds the periods that have no rows; with
        ``group_by``, in each group those between its own first and last period.
        """
        group_by = list(group_by or [])
        if grain is not None and grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        simple = self._simple_metrics(metrics)
        keys = (["metric_time"] if grain else []) + group_by
        parts = []
        for model in self.models:
            own = [m for m in simple if any(m.measure == x.name for x in model.measures)]
            if own:
                parts.append(self._aggregate(model, own, group_by, grain, where))
        if not parts:
            raise ValueError("no metrics asked for")
        result = parts[0]
        if len(parts) > 1:
            # Groups missing on one side must survive and null keys must meet, so the
            # sides are stacked and merged instead of joined.
            for part in parts[1:]:
                result = result.unionByName(part, allowMissingColumns=True)
            merged = [F.max(m.name).alias(m.name) for m in simple]
            result = result.groupBy(*keys).agg(*merged)
        if spine is not None and grain:
            periods = spine.select(self._period("date_day", grain)).distinct()
            if group_by:
                result = self._filled(result, group_by, grain).join(F.broadcast(periods), "metric_time", "left_semi")
            else:
                result = periods.join(result, "metric_time", "left")
        return result.select(*keys, *[self._formula(name).alias(name) for name in metrics])

    @staticmethod
    def _filled(result: DataFrame, group_by: list[str], grain: str) -> DataFrame:
        """The missing periods of each group, from each row up to the next one: one shuffle
        by group, no join."""
        following = F.lead("metric_time").over(Window.partitionBy(*group_by).orderBy("metric_time"))
        step = F.expr(_STEPS[grain])
        rows = result.where("metric_time is not null").withColumn("_next", following)
        until = F.coalesce(F.date_sub("_next", 1), "metric_time")
        rows = rows.select("*", F.posexplode(F.sequence("metric_time", until, step)).alias("_nth", "_period"))
        others = [c for c in result.columns if c not in (*group_by, "metric_time")]
        return rows.select(
            F.col("_period").alias("metric_time"), *group_by,
            *[F.when(F.col("_nth") == 0, F.col(c)).alias(c) for c in others],
        )

    def _simple_metrics(self, names: list[str]) -> list[Metric]:
        found: dict[str, Metric] = {}
        for name in names:
            metric = self.metrics[name]
            if metric.kind == "simple":
                found[name] = metric
            else:
                inputs = metric.inputs or (metric.numerator, metric.denominator)
                found.update({m.name: m for m in self._simple_metrics(list(inputs))})
        return list(found.values())

    def _formula(self, name: str) -> Column:
        metric = self.metrics[name]
        if metric.kind == "simple":
            return F.col(name)
        if metric.kind == "ratio":
            top, bottom = F.col(metric.numerator), F.col(metric.denominator)
            return F.try_divide(top.cast("double"), bottom.cast("double"))
        text = metric.expr
        for item in metric.inputs:
            text = re.sub(rf"\b{item}\b", f"CAST({item} AS DOUBLE)", text)
        return F.expr(text)

    @staticmethod
    def _period(day: str, grain: str) -> Column:
        return F.date_trunc(grain, day).cast("date").alias("metric_time")

    def _aggregate(
        self, model: SemanticModel, metrics: list[Metric], group_by: list[str],
        grain: str | None, where: str | None,
    ) -> DataFrame:
        df = asked(self.tables, model.table, *self._texts(model, metrics, group_by, where))
        for name in group_by:
            if "__" in name:
                df = self._join_entity(model, df, name)
            elif model.dimensions.get(name, name) != name:
                df = df.withColumn(name, F.expr(model.dimensions[name]))
            elif name not in model.dimensions and name not in model.foreign.values():
                raise ValueError(f"{model.name} has no dimension {name}")
        if where:
            df = df.where(where)
        keys = ([self._period(model.time, grain)] if grain else []) + [F.col(k) for k in group_by]
        measures = []
        for metric in metrics:
            only = F.expr(metric.where) if metric.where else None
            measures.append(model.measure(metric.measure).column(only).alias(metric.name))
        return df.groupBy(*keys).agg(*measures)

    def _texts(
        self, model: SemanticModel, metrics: list[Metric], group_by: list[str], where: str | None
    ) -> list[str]:
        """Texts that name every column a question takes from the table of a model."""
        texts = [model.time, where or ""]
        for metric in metrics:
            texts += [model.measure(metric.measure).expr, metric.where]
        for name in group_by:
            if "__" in name:
                texts.append(model.foreign[self._path(model, name.split("__", 1)[0])[0].primary[0]])
            else:
                texts += [name, model.dimensions.get(name, name)]
        return texts

    def _path(self, model: SemanticModel, entity: str) -> list[SemanticModel]:
        """The models on the shortest way from one to the model that an entity is the
        primary one of."""
        owners = {m.primary[0]: m for m in self.models}
        ways, seen = [[model]], {model.name}
        while ways:
            found = [way + [owners[entity]] for way in ways if entity in way[-1].foreign and entity in owners]
            if len(found) > 1:
                names = [[m.name for m in way] for way in found]
                raise ValueError(f"several ways lead from {model.name} to {entity}: {names}")
            if found:
                return found[0][1:]
            further = []
            for way in ways:
                for name in way[-1].foreign:
                    other = owners.get(name)
                    if other is not None and other.name not in seen:
                        further.append(way + [other])
            seen |= {way[-1].name for way in further}
            ways = further
        raise ValueError(f"{model.name} has no entity {entity}")

    def _join_entity(self, model: SemanticModel, df: DataFrame, name: str) -> DataFrame:
        """Add ``entity__dimension``, or ``entity__other`` for the key of an entity that the
        first one refers to."""
        entity, dimension = name.split("__", 1)
        path = self._path(model, entity)
        target = path[-1]
        if dimension not in target.dimensions and dimension not in target.foreign:
            raise ValueError(f"no model offers {name}")
        here = df.withColumn("_at", F.col(model.foreign[path[0].primary[0]]))
        for i, step in enumerate(path):
            last = i == len(path) - 1
            if not last:
                value = step.foreign[path[i + 1].primary[0]]
            else:
                value = target.dimensions.get(dimension) or target.foreign[dimension]
            here = here.join(self._unique(step, value), F.col("_at") == F.col("_entity"), "left")
            here = here.withColumn("_at", F.col("_value")).drop("_entity", "_value")
        return here.withColumnRenamed("_at", name)

    def _unique(self, model: SemanticModel, value: str) -> DataFrame:
        """A value for each key of a model. A key that repeats would multiply the measures:
        it stops the job instead."""
        entity, key = model.primary
        table = asked(self.tables, model.table, key, value)
        found = table.select(F.col(key).alias("_entity"), F.expr(value).alias("_value"))
        counted = found.groupBy("_entity").agg(F.max("_value").alias("_value"), F.count("*").alias("_n"))
        stop = F.raise_error(F.lit(f"entity {entity} is not unique"))
        return counted.select("_entity", F.when(F.col("_n") > 1, stop).otherwise(F.col("_value")).alias("_value"))
