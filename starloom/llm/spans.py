"""Places of pattern matches in texts, by SQL functions alone.

Splitting a text at a pattern gives the stretches between its matches; with the matches
themselves, running sums of lengths give every place, in code points. Both functions walk
the text from left to right and never overlap, so they see the same matches.

Patterns are Java ones. Repeated groups are possessive, so that a long match takes no
stack, and patterns start where a stretch of their characters starts, so that a long
stretch without a match is walked once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,text:string,part:string>>"
GROUP = 128  # matches placed at a time
STRETCH = 512


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, pattern: str, part: int = 0) -> Column:
    """All matches, as ``start, end, text, part``, where ``part`` is the text of a group. The
    text must not be null."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(part)) if part else hits
    gaps = F.split(text, pattern, -1)
    zipped = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)),
        F.arrays_zip(hits.alias("text"), parts.alias("part")),
        lambda gap, hit: F.struct(
            F.length(gap).alias("gap"), hit["text"].alias("text"), hit["part"].alias("part")
        ),
    )
    placed = once(zipped, _placed)
    return F.when(F.rlike(text, F.lit(pattern)), placed).otherwise(F.from_json(F.lit("[]"), SPAN))


def _placed(stretches: Column) -> Column:
    """The matches of stretches ``gap, text, part`` with their places.

    An array that grows is copied at each step, so stretches are taken in groups, and only
    arrays of one group, or of one entry for each group, grow."""

    def one(had: Column, x: Column) -> Column:
        start = had["at"] + x["gap"]
        end = start + F.length(x["text"])
        span = F.struct(
            start.alias("start"), end.alias("end"), x["text"].alias("text"), x["part"].alias("part")
        )
        return F.struct(end.alias("at"), F.concat(had["out"], F.array(span)).alias("out"))

    def group(had: Column, some: Column) -> Column:
        at = F.coalesce(F.try_element_at(had, F.lit(-1))["at"], F.lit(0))
        first = F.struct(at.alias("at"), F.from_json(F.lit("[]"), SPAN).alias("out"))
        return F.concat(had, F.array(F.aggregate(some, first, one)))

    last = F.greatest(F.ceil(F.size(stretches) / GROUP).cast("int") - 1, F.lit(0))
    groups = F.transform(
        F.sequence(F.lit(0), last), lambda g: F.slice(stretches, g * GROUP + 1, F.lit(GROUP))
    )
    none = F.from_json(F.lit("[]"), f"array<struct<at:int,out:{SPAN}>>")
    return F.flatten(F.transform(F.aggregate(groups, none, group), lambda g: g["out"]))


def stretches_of(text: Column) -> Column:
    """A text in stretches of ``STRETCH`` code points, so that what stands at a place can be
    read without a walk from the start of the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))


def cut(stretches: Column, start: Column, size: Column) -> Column:
    """At most ``size`` code points from ``start`` on; ``size`` is at most ``STRETCH``."""
    first = F.floor(start / STRETCH).cast("int")
    two = F.concat_ws("", F.get(stretches, first), F.get(stretches, first + 1))
    return F.substring(two, start - first * STRETCH + 1, size)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def free(spans: Column, others: Column) -> Column:
    """The spans that share no character with any of the others.

    As many others overlap a span as start before its end, less those that end before its
    start. Both numbers come from sorting the places of spans and others together."""

    def before(place_of_span, place_of_other, span_first: int) -> Column:
        # For each span, in order, how many of the others' places come before its own.
        mine = F.transform(
            spans,
            lambda s, i: F.struct(
                place_of_span(s).alias("place"), F.lit(1 - span_first).alias("turn"), i.alias("i")
            ),
        )
        theirs = F.transform(
            others,
            lambda o: F.struct(
                place_of_other(o).alias("place"), F.lit(span_first).alias("turn"), F.lit(-1).alias("i")
            ),
        )
        ranked = F.transform(
            F.sort_array(F.concat(mine, theirs)),
            lambda x, at: F.struct(x["i"].alias("i"), at.alias("at")),
        )
        ranked = F.transform(
            F.filter(ranked, lambda x: x["i"] >= 0),
            lambda x, k: F.struct(x["i"].alias("i"), (x["at"] - k).alias("n")),
        )
        return F.transform(F.sort_array(ranked), lambda x: x["n"])

    started = before(lambda s: s["end"], lambda o: o["start"], 1)
    ended = before(lambda s: s["start"], lambda o: o["end"], 0)
    apart = F.zip_with(started, ended, lambda x, y: x == y)
    kept = F.filter(
        F.zip_with(spans, apart, lambda s, a: F.struct(s.alias("span"), a.alias("apart"))),
        lambda x: x["apart"],
    )
    return F.when(F.size(others) == 0, spans).otherwise(F.transform(kept, lambda x: x["span"]))


def named(spans: Column, kind: str, number: int) -> Column:
    """The spans as ``start, number, kind, end``, fit for sorting by place."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("number"), F.lit(kind).alias("kind"),
            s["end"].alias("end"),
        ),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
