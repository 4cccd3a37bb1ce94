"""Sentiment, complaint categories and tags of free-text feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import month_of
from starloom.functions.text import (
    Vocabulary,
    categories,
    category_matches,
    known_tokens,
    main_category,
    sentiment,
    tags,
    tokenise,
)


def tokens(feedback: DataFrame) -> DataFrame:
    """One row per token with its 1-based position in the split text."""
    split = feedback.select("feedback_id", tokenise(F.col("normalised_text")).alias("tokens"))
    placed = split.select("feedback_id", F.posexplode("tokens").alias("at", "token"))
    return placed.where("token <> ''").select(
        "feedback_id", (F.col("at") + 1).alias("token_position"), "token"
    )


def polarised_tokens(placed: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Tokens found in the lexicon, once per listing. The lexicon is the small side:
    it is broadcast while its size is under the session's threshold."""
    words = lexicon.select(F.col("word").alias("token"), "polarity")
    return placed.join(words, "token").select("feedback_id", "token_position", "token", "polarity")


def sentiment_label(score: Column, threshold: float = 0.2) -> Column:
    return (
        F.when(score <= -threshold, "negative").when(score >= threshold, "positive").otherwise("neutral")
    )


def understood(feedback: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Feedback rows with all word features, in one pass over the texts.

    Adds ``sentiment_raw``, ``polarised_word_count``, ``sentiment_score``,
    ``sentiment_label``, ``complaint_category``, ``all_categories`` and
    ``semantic_tags``. Works per row, so ``feedback_id`` is taken as unique.
    """
    columns = [c for c in feedback.columns if c != "normalised_text"]
    known = feedback.select(
        *columns,
        known_tokens(tokenise(F.col("normalised_text")), vocabulary).alias("_known"),
    )
    read = known.select(
        *columns,
        sentiment(F.col("_known"), vocabulary).alias("_mood"),
        category_matches(F.col("_known"), vocabulary).alias("_matches"),
        tags(F.col("_known"), vocabulary).alias("_tags"),
    )
    raw = F.coalesce(F.col("_mood.raw"), F.lit(0))
    hits = F.coalesce(F.col("_mood.hits"), F.lit(0))
    none = F.array().cast("array<string>")
    scored = read.select(
        *columns,
        raw.alias("sentiment_raw"),
        hits.alias("polarised_word_count"),
        F.when(hits > 0, raw.cast("double") / hits).otherwise(F.lit(0.0)).alias("sentiment_score"),
        main_category(F.col("_matches")).alias("complaint_category"),
        F.coalesce(categories(F.col("_matches")), none).alias("all_categories"),
        F.coalesce(F.col("_tags"), none).alias("semantic_tags"),
    )
    return scored.withColumn("sentiment_label", sentiment_label(F.col("sentiment_score")))


def sentiment_by_join(
    feedback: DataFrame, lexicon: DataFrame, negations: DataFrame, reach: int = 2
) -> DataFrame:
    """Sentiment per feedback for word lists of any size.

    Each token row carries the tokens just before it, so the negation test needs no
    window; word lists are joined, and only one small row per text and task is
    shuffled for the sums.

    The tokens before are the same array, moved by nulls in front, and zipped: a lambda that
    looked back into the array would have the optimizer split the whole text anew for each
    token, once it draws a filter from the ``inline``. The outer form draws none; its rows
    without a token meet no word.
    """
    split = feedback.select("feedback_id", tokenise(F.col("normalised_text")).alias("token"))
    before = [f"before_{back}" for back in range(1, reach + 1)]
    none = F.lit(None).cast("string")
    moved = [
        F.concat(F.array(*[none] * back), F.col("token")).alias(name) for back, name in enumerate(before, 1)
    ]
    # Small structs are exploded; the array of tokens is left behind.
    placed = split.select("feedback_id", "token", *moved)
    placed = placed.select("feedback_id", F.inline_outer(F.arrays_zip("token", *before)))
    words = lexicon.select(F.col("word").alias("token"), "polarity")
    found = placed.join(words, "token")
    turned = F.lit(False)
    distinct = negations.select("word").distinct()
    for back in range(1, reach + 1):
        listed = distinct.select(F.col("word").alias(f"before_{back}"), F.lit(True).alias(f"negated_{back}"))
        found = found.join(listed, f"before_{back}", "left")
        turned = turned | F.coalesce(F.col(f"negated_{back}"), F.lit(False))
    sums = (
        found.withColumn("effective", F.when(turned, -F.col("polarity")).otherwise(F.col("polarity")))
        .groupBy("feedback_id")
        .agg(F.sum("effective").alias("raw"), F.count("*").alias("hits"))
    )
    score = F.coalesce(F.col("raw") / F.col("hits"), F.lit(0.0))
    return (
        feedback.select("feedback_id")
        .join(sums, "feedback_id", "left")
        .select(
            "feedback_id",
            F.coalesce("raw", F.lit(0)).alias("sentiment_raw"),
            F.coalesce("hits", F.lit(0)).alias("polarised_word_count"),
            score.alias("sentiment_score"),
            sentiment_label(score).alias("sentiment_label"),
        )
    )


def category_counts(placed: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Matches and best priority per feedback and category, from token rows."""
    keywords = taxonomy.select(F.col("keyword").alias("token"), "category", "priority")
    return (
        placed.join(keywords, "token")
        .groupBy("feedback_id", "category")
        .agg(F.min("priority").alias("best_priority"), F.count("*").alias("match_count"))
    )


def complaint_themes(read: DataFrame, top: int = 3) -> DataFrame:
    """Per route and month: feedback counts, mood, and the most frequent themes.

    One grouping by theme feeds both the month totals and the ranking, so the texts
    are aggregated once; the window sees at most one row per category.
    """
    known = read.where(F.col("route_id").isNotNull()).withColumn(
        "period_month", month_of(F.col("feedback_at"))
    )
    label = F.col("sentiment_label")
    themes = known.groupBy("route_id", "period_month", "complaint_category").agg(
        F.count("*").alias("theme_count"),
        F.sum("sentiment_score").alias("score"),
        F.count_if(label == "negative").alias("negative"),
        F.count_if(label == "positive").alias("positive"),
    )
    per_month = Window.partitionBy("route_id", "period_month")
    place = F.row_number().over(
        per_month.orderBy(F.desc("theme_count"), F.asc("complaint_category"))
    )
    ranked = themes.withColumn("place", place)
    total = F.sum("theme_count")
    picks = []
    for i in range(1, top + 1):
        here = F.col("place") == i
        picks.append(F.max(F.when(here, F.col("complaint_category"))).alias(f"top_theme_{i}"))
        picks.append(F.max(F.when(here, F.col("theme_count"))).alias(f"top_theme_{i}_count"))
    return ranked.groupBy("route_id", "period_month").agg(
        total.alias("feedback_count"),
        (F.sum("score") / total).alias("avg_sentiment"),
        (F.sum("negative").cast("double") / total).alias("negative_ratio"),
        (F.sum("positive").cast("double") / total).alias("positive_ratio"),
        *picks,
    )


def keyword_polarity(feedback: DataFrame, negative: list[str], positive: list[str]) -> DataFrame:
    """Quick label from the number of contained words; substrings count."""
    text = F.lower("raw_text")

    def hits(words: list[str]) -> Column:
        return sum((text.contains(w).cast("int") for w in words), F.lit(0))

    label = (
        F.when(hits(negative) > hits(positive), "neg")
        .when(hits(positive) > hits(negative), "pos")
        .otherwise("neu")
    )
    return feedback.select("feedback_id", label.alias("quick_polarity"))
