import pytest
from pyspark.sql import functions as F

from starloom.functions.text import Vocabulary
from starloom.operators import feedback
from starloom.sources.lexicons import LEXICON, NEGATIONS, TAXONOMY, seed_frame

VOCABULARY = Vocabulary(LEXICON, TAXONOMY, NEGATIONS)
TEXTS = {
    "lost": "Bagage perdu entre Paris et Abidjan, service injoignable.",
    "gift": "Surclassement gratuit en classe affaires, expérience fantastique.",
    "negated": "pas bon",
    "far": "pas du tout bon",
    "double": "ne pas bon",
    "twice_listed": "excellent",
    "ligature": "!œuvre",
    "null": None,
    "empty": "",
    "mixed": "retard, bon bon merci top rapide calme calme",
    "minus": "retard retard retard bon bon",
    "plus": "bon bon bon retard retard",
    "upgrade": "upgrade bagage",
    "tie": "repas bagage",
    "edge": "...Bon!!! ",
}


@pytest.fixture(scope="module")
def stage(spark):
    rows = list(TEXTS.items())
    df = spark.createDataFrame(rows, "feedback_id string, raw_text string")
    return df.withColumn("normalised_text", F.lower("raw_text"))


@pytest.fixture(scope="module")
def read(stage):
    return {r.feedback_id: r for r in feedback.understood(stage, VOCABULARY).collect()}


@pytest.mark.parametrize(
    "name, raw, hits, score, label",
    [
        ("lost", -1, 1, -1.0, "negative"),
        ("gift", 3, 3, 1.0, "positive"),
        ("negated", -1, 1, -1.0, "negative"),
        ("far", 1, 1, 1.0, "positive"),
        ("double", -1, 1, -1.0, "negative"),
        ("twice_listed", 2, 2, 1.0, "positive"),
        ("null", 0, 0, 0.0, "neutral"),
        ("empty", 0, 0, 0.0, "neutral"),
        ("minus", -1, 5, -0.2, "negative"),
        ("plus", 1, 5, 0.2, "positive"),
        ("edge", 1, 1, 1.0, "positive"),
    ],
)
def test_sentiment(read, name, raw, hits, score, label):
    row = read[name]
    assert (row.sentiment_raw, row.polarised_word_count) == (raw, hits)
    assert row.sentiment_score == score
    assert row.sentiment_label == label


@pytest.mark.parametrize(
    "name, main, every",
    [
        ("lost", "baggage", ["baggage"]),
        ("gift", "upgrade", ["upgrade"]),
        ("null", "general", []),
        ("empty", "general", []),
        ("upgrade", "upgrade", ["baggage", "upgrade"]),  # listed twice, counts twice
        ("tie", "baggage", ["baggage", "food"]),
    ],
)
def test_categories(read, name, main, every):
    assert read[name].complaint_category == main
    assert read[name].all_categories == every


def test_tags_ignore_negation(read):
    assert read["negated"].semantic_tags == ["bon:pos"]
    assert read["twice_listed"].semantic_tags == ["excellent:pos"]
    assert read["minus"].semantic_tags == ["bon:pos", "delay:cat", "retard:neg"]
    assert read["null"].semantic_tags == []


def test_token_positions_count_the_empty_edge(stage):
    rows = feedback.tokens(stage).where("feedback_id = 'ligature'").collect()
    assert [(r.token_position, r.token) for r in rows] == [(2, "uvre")]


def test_no_tokens_for_null_or_empty(stage):
    assert feedback.tokens(stage).where("feedback_id in ('null', 'empty')").count() == 0


def test_join_form_agrees(spark, stage, read):
    joined = feedback.sentiment_by_join(
        stage, seed_frame(spark, "lexicon_sentiment"), seed_frame(spark, "negation_words")
    ).collect()
    for row in joined:
        other = read[row.feedback_id]
        for column in ("sentiment_raw", "polarised_word_count", "sentiment_score", "sentiment_label"):
            assert row[column] == other[column], (row.feedback_id, column)


def test_word_features_need_no_shuffle(stage):
    plan = feedback.understood(stage, VOCABULARY)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Join" not in plan


def test_long_word_lists_give_the_same(stage, read):
    """Twenty thousand words more, none of which occurs, change nothing."""
    letters = "zwvkjxqyhu"
    more = ["".join("q" + letters[int(d)] for d in str(i)) for i in range(20_000)]
    long = Vocabulary(
        VOCABULARY.lexicon + [(word, "en", -1) for word in more],
        VOCABULARY.taxonomy + [("delay", "en", word, 1) for word in more],
        VOCABULARY.negations,
    )
    for row in feedback.understood(stage, long).collect():
        other = read[row.feedback_id]
        for column in ("sentiment_raw", "complaint_category", "all_categories", "semantic_tags"):
            assert row[column] == other[column], (row.feedback_id, column)


def test_themes_rank_ties_by_name(spark):
    rows = [("a", "R1", "delay"), ("b", "R1", "crew"), ("c", "R1", "crew"), ("d", "R1", "baggage"),
            ("e", "R1", "seat"), ("f", None, "seat")]
    df = spark.createDataFrame(rows, "feedback_id string, route_id string, complaint_category string")
    df = df.selectExpr(
        "*", "timestamp_ntz '2024-05-06 10:00:00' as feedback_at", "-0.5D as sentiment_score",
        "'negative' as sentiment_label",
    )
    (row,) = feedback.complaint_themes(df).collect()
    assert [row.top_theme_1, row.top_theme_2, row.top_theme_3] == ["crew", "baggage", "delay"]
    assert (row.top_theme_1_count, row.feedback_count, row.negative_ratio) == (2, 5, 1.0)


def test_quick_polarity(frame):
    df = frame([("a", "LOST and bad"), ("b", "Bravo, merci"), ("c", "lost bravo")], "feedback_id string, raw_text string")
    found = {r.feedback_id: r.quick_polarity for r in feedback.keyword_polarity(df, ["lost", "bad"], ["bravo", "merci"]).collect()}
    assert found == {"a": "neg", "b": "pos", "c": "neu"}


def test_long_texts_are_split_once(spark):
    """The tokens before a token are no reason to split its text again, and short lists no
    reason to shuffle tokens."""
    rows = [("long", "bon pas bon et pas du tout bon " * 3), ("null", None), ("empty", "")]
    df = spark.createDataFrame(rows, "feedback_id string, raw_text string")
    df = df.withColumn("normalised_text", F.lower("raw_text"))
    lists = [seed_frame(spark, name) for name in ("lexicon_sentiment", "negation_words")]
    found = feedback.sentiment_by_join(df, *lists)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") <= 1
    assert "LogicalRDD [word" not in text
    got = {r.feedback_id: (r.sentiment_raw, r.polarised_word_count) for r in found.collect()}
    # Each round: bon, pas bon, pas du tout bon; the first of a later round has "tout bon" before it.
    assert got == {"long": (3, 9), "null": (0, 0), "empty": (0, 0)}
