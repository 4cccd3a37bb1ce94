"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order (by a hash of the id), run
through up to ``max_repeats`` times. The copy of a document that ends at word ``c`` of its
queue has the virtual finish time ``c / target``; the mix takes copies in order of that
time until the budget, the sum of all targets, is used up. So each source is at the same
share of its target at any point of the mix.

Sources in code point order, null last, weigh ``weights``, repeating. They share the budget
by weight; a target stops at ``max_repeats`` times its source's words, and the excess goes
to the others by weight.

Running sums are taken over ranges of the whole order, so a source that holds a third of
all documents is spread like any other rows.

Defined cases: a null text has no words and is never taken; a null source is a source of
its own, the last one; rows that repeat are documents of their own; an empty table gives no
rows. Only the columns ``doc_id, text, source`` are read; others are handed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.running import with_running_sums
from starloom.session import materialise

# Separators of words besides the blank.
_BLANKS = "\t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    blank = F.translate(text, _BLANKS, " " * len(_BLANKS))
    parts = F.split(F.btrim(blank), " +")
    return F.when(F.coalesce(F.length(F.btrim(blank)), F.lit(0)) == 0, F.lit(0).cast("long")).otherwise(
        F.size(parts).cast("long")
    )


def targets(
    sized: DataFrame, weights: tuple[int, ...], share: float, max_repeats: int
) -> DataFrame:
    """``source, source_rank, source_size, target`` of every source of the sized documents."""
    by_name = with_running_sums(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")),
        [F.col("source").asc_nulls_last()],
        {"source_rank": F.lit(1).cast("long")},
    )
    nth = ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")
    weighted = by_name.select(
        "source",
        "source_rank",
        "source_size",
        F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), nth).alias("weight"),
        (F.col("source_size") * max_repeats).alias("most"),
    )
    weighted = materialise(
        weighted.withColumn("level", F.col("most").cast("double") / F.col("weight")), "sources"
    )
    budget, weight = weighted.agg(F.sum("source_size") * F.lit(float(share)), F.sum("weight")).first()
    budget, weight = budget or 0.0, weight or 0
    # Filled by rising level: the first source that is not full sets the level of the rest.
    filled = with_running_sums(
        weighted,
        [F.col("level").asc(), F.col("source_rank").asc()],
        {"most_upto": F.col("most"), "weight_upto": F.col("weight")},
    )
    rest = (F.lit(float(budget)) - (F.col("most_upto") - F.col("most")).cast("double")) / (
        F.lit(int(weight)) - F.col("weight_upto") + F.col("weight")
    )
    water = (
        filled.withColumn("rest", rest)
        .where("rest <= level")
        .agg(F.min_by("rest", F.struct("level", "source_rank")).alias("water"))
        .first()
        .water
    )
    target = F.col("most").cast("double")
    if water is not None:
        target = F.least(target, F.lit(float(water)) * F.col("weight"))
    return weighted.select("source", "source_rank", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.0,
    max_repeats: int = 3,
) -> DataFrame:
    """How often the mix takes each document.

    Returns ``doc_id, source, text_key, size, source_size, target, copies, taken`` and
    ``finish``, the virtual time of the first copy (null if none is taken).
    """
    sized = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64("text").alias("text_key"),
            word_count(F.col("text")).alias("size"),
        ),
        "sized",
    )
    sources = materialise(targets(sized, weights, share, max_repeats), "targets")
    budget = sources.agg(F.sum("target")).first()[0] or 0.0
    # One row per source: joined by name, broadcast only if Spark finds it small.
    queued = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        sized["*"], "source_rank", "source_size", "target",
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffle"),
    )
    queued = with_running_sums(
        queued,
        [F.col("source_rank"), F.col("shuffle"), F.col("doc_id"), F.col("text_key")],
        {"upto": F.col("size"), "row": F.lit(1).cast("long")},
    )
    # Words of the sources before: taken off, to leave the place in the own queue.
    before = with_running_sums(sources, [F.col("source_rank")], {"all_upto": F.col("source_size")})
    before = before.select("source_rank", (F.col("all_upto") - F.col("source_size")).alias("others"))
    queued = materialise(
        queued.join(before, "source_rank").withColumn("upto", F.col("upto") - F.col("others")),
        "queued",
    )
    copies = queued.where("size > 0 and target > 0").select(
        "row", "size", "target", "source_size", "upto",
        F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("nth"),
    )
    end = F.col("nth") * F.col("source_size") + F.col("upto")
    copies = copies.where((end - F.col("size")) < F.col("target")).select(
        "row", "nth", "size", (end / F.col("target")).alias("finish")
    )
    in_order = with_running_sums(
        materialise(copies, "copies"),
        [F.col("finish"), F.col("row"), F.col("nth")],
        {"words": F.col("size")},
    )
    last = (
        in_order.where(F.col("words") <= F.lit(float(budget)))
        .agg(F.max(F.struct("finish", "row", "nth")).alias("cut"))
        .first()
        .cut
    )

    def ending(nth: int) -> Column:
        return F.lit(nth) * F.col("source_size") + F.col("upto")

    def finish(nth: int) -> Column:
        return ending(nth) / F.col("target")

    if last is None:
        taken = [F.lit(False)] * max_repeats
    else:
        cut = F.struct(*[F.lit(v).alias(k) for k, v in last.asDict().items()])
        taken = [
            F.coalesce(
                (F.col("size") > 0)
                & (F.col("target") > 0)
                & (ending(k) - F.col("size") < F.col("target"))
                & (F.struct(finish(k).alias("finish"), F.col("row"), F.lit(k).alias("nth")) <= cut),
                F.lit(False),
            )
            for k in range(max_repeats)
        ]
    count = sum((t.cast("int") for t in taken), F.lit(0))
    return queued.select(
        "doc_id", "source", "text_key", "size", "source_size", "target",
        count.alias("copies"),
        (F.col("size") * count).alias("taken"),
        F.when(count > 0, finish(0)).alias("finish"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns and ``copies``, ``finish``; to train
    on it, read each document ``copies`` times in order of ``finish``. Columns of the
    documents with these two names are replaced."""
    mixed = mix(docs, **options).where("copies > 0")
    same = Window.partitionBy("doc_id", "source", "text_key").orderBy("finish")
    mixed = mixed.select(
        "doc_id", "source", "text_key", F.row_number().over(same).alias("nth"), "copies", "finish"
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("text_key"),
    ).alias("d")
    # Equal rows are told apart by number; each number meets one decision.
    rows = rows.withColumn(
        "nth",
        F.row_number().over(Window.partitionBy("doc_id", "source", "text_key").orderBy("text_key")),
    ).alias("d")
    mixed = mixed.alias("m")
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("doc_id", "source", "text_key", "nth")]
    joined = rows.join(mixed, on)
    clash = {"copies", "finish"} & set(docs.columns)
    kept = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in clash]
    return joined.select(*kept, F.col("m.copies"), F.col("m.finish"))
