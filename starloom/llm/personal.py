"""Personal data in texts, by weak supervision.

Four kinds are reported wherever they match and pass their check: ``email``, ``ip``,
``card`` (Luhn) and ``phone``. Looser candidates (``spelled_email``, ``local_phone``,
``iban``, ``person``) are reported when the span classifier takes them for personal data:

1. Three labelers vote on every candidate, base ones included: for (1), against (-1), or
   not at all (0). The *pattern* labeler judges its form, the *gazetteer* labeler looks parts
   of it up in short lists, the *context* labeler looks for words about its kind (or about
   something else) around it.
2. Expectation-maximisation estimates, without any label, how often personal data is among
   each kind's candidates, and how each labeler votes on personal data and on the rest.
   There are at most 27 patterns of votes a kind, which are counted over all documents; only
   these counts reach the driver.
3. The estimated probabilities train the final classifier, naive Bayes over features of the
   span that the labelers do not see: kind, length, share of digits, and the characters
   next to it. Its odds and the labelers' are added up.

All work on texts is SQL: patterns, votes, counts and scores.

Defined cases: a null text is empty and holds nothing; every input row gives one row. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.spans import count_of, cut, digits, found, free, listed, once, stretches_of
from starloom.session import materialise

# The patterns of the base kinds. A card of fewer than 16 digits or more than
# 19 is none, so shorter runs of digits are not even matched.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

SPELLED_EMAIL = (
    r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}+"
    r" ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,10}+"
)
LOCAL_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PERSON = (
    r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.? "
    r"[A-ZÀ-Þ][a-zß-ÿ]{1,30}(?: [A-ZÀ-Þ][a-zß-ÿ]{1,30})?"
)

BASE = ["email", "ip", "card", "phone"]
LOOSE = ["spelled_email", "local_phone", "iban", "person"]

# The gazetteers.
DOMAIN_ENDS = "com|org|net|edu|gov|de|fr|es|uk|eu|info|io"
CALLING_CODES = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|81|82|84|86|9[0-58]"
CARD_BRANDS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
IBAN_COUNTRIES = "DE|FR|ES|IT|NL|BE|AT|CH|GB|IE|PT|PL"
FIRST_NAMES = (
    "anna|david|elena|emma|hans|james|jean|john|jose|juan|julia|klaus|laura|louis|maria|marie|mary|"
    "michael|paul|peter|pierre|robert|sophie|thomas|william"
)

# Words about a kind, and words that speak against personal data.
ABOUT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|addr|host|server|login|client",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|anruf|llama",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "person": "name|born|lives|patient|address|wohnt|vive",
}
AGAINST = "version|isbn|serial|invoice|order|model|article|chapter|release"

LIKE = {"spelled_email": "email", "local_phone": "phone"}
NEIGHBOURS = 40  # code points of context to either side


def _luhn(number: Column) -> Column:
    """Whether the digits of a card number add up."""
    size = F.length(number)
    values = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.substring(number, i, F.lit(1)).cast("int") * F.when((size - i) % 2 == 1, 2).otherwise(1),
    )
    total = F.aggregate(values, F.lit(0), lambda had, v: had + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def _parts_fit(address: Column) -> Column:
    return F.forall(
        F.split(address, r"\."),
        lambda part: (F.length(F.regexp_replace(part, "^0+", "")) <= 3)
        & (F.coalesce(F.try_to_number(F.lpad(F.regexp_replace(part, "^0+", ""), 3, "0"), F.lit("999")), F.lit(0)) <= 255),
    )


def matches(text: Column) -> dict[str, Column]:
    """The spans of every kind in a text that is not null."""

    def cards(s: Column) -> Column:
        number = digits(s["text"])
        return F.length(number).between(16, 19) & _luhn(number)

    return {
        "email": found(text, EMAIL),
        "ip": F.filter(found(text, IP), lambda s: _parts_fit(s["text"])),
        "card": F.filter(found(text, CARD), cards),
        "phone": F.filter(
            found(text, PHONE), lambda s: F.length(digits(s["text"])).between(8, 15)
        ),
        "spelled_email": found(text, SPELLED_EMAIL),
        "local_phone": found(text, LOCAL_PHONE),
        "iban": found(text, IBAN),
        "person": found(text, PERSON),
    }


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _pattern_vote(kind: str, text: Column) -> Column:
    """Judges the form beyond what the pattern of the kind asks."""
    number = F.length(digits(text))
    if kind in ("email", "spelled_email"):
        return _vote(text.rlike(r"(?i)[a-z]{2,}[^@]*$") & (F.length(text) <= 80), text.rlike(r"^[0-9.]+@"))
    if kind == "ip":
        return _vote(~text.rlike(r"(?:^|\.)0[0-9]"), text.rlike(r"^0\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))
    if kind == "card":
        return _vote(number == 16, number > 16)
    if kind in ("phone", "local_phone"):
        return _vote(number.between(10, 13), number < 9)
    if kind == "iban":
        return _vote(F.length(F.replace(text, F.lit(" "), F.lit(""))).between(15, 34), F.lit(False))
    return _vote(text.rlike(r" \S+ \S+"), F.lit(False))


def _gazetteer_vote(kind: str, text: Column) -> Column:
    if kind in ("email", "spelled_email"):
        return _vote(text.rlike(rf"(?i)[. ](?:{DOMAIN_ENDS})$"), text.rlike(r"[0-9]$"))
    if kind == "ip":
        private = r"^(?:10|127|0|255)\.|^192\.168\.|^2(?:2[4-9]|[345][0-9])\."
        return _vote(~text.rlike(private), text.rlike(private))
    if kind == "card":
        return _vote(text.rlike(rf"^(?:{CARD_BRANDS})"), ~text.rlike(rf"^(?:{CARD_BRANDS})"))
    if kind == "phone":
        known = rf"^\+(?:{CALLING_CODES})"
        return _vote(text.rlike(known), ~text.rlike(known))
    if kind == "local_phone":
        return _vote(text.rlike(r"^\(?[2-9]"), text.rlike(r"^\(?[01]"))
    if kind == "iban":
        return _vote(text.rlike(rf"^(?:{IBAN_COUNTRIES})"), ~text.rlike(rf"^(?:{IBAN_COUNTRIES})"))
    return _vote(text.rlike(rf"(?i) (?:{FIRST_NAMES})(?: |$)"), F.lit(False))


def _context_vote(kind: str, around: Column) -> Column:
    return _vote(
        around.rlike(rf"(?i)(?:{ABOUT[LIKE.get(kind, kind)]})"), around.rlike(rf"(?i)\b(?:{AGAINST})")
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` per document; each span has its place, kind, whether it is a base
    one, the three votes, and the features of the classifier."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("stretches", stretches_of(F.col("text")))
    text, stretches = F.col("text"), F.col("stretches")

    def judged(kind: str, number: int, spans: Column) -> Column:
        def beside(s: Column) -> Column:
            first = F.greatest(s["start"] - NEIGHBOURS, F.lit(0))
            return F.struct(
                cut(stretches, first, s["start"] - first).alias("before"),
                cut(stretches, s["end"], F.lit(NEIGHBOURS)).alias("after"),
            )

        def one(s: Column, around: Column) -> Column:
            start, end, hit = s["start"], s["end"], s["text"]
            before, after = around["before"], around["after"]
            size = F.least(F.floor(F.log2(end - start)), F.lit(7))
            share = F.floor(4 * F.length(digits(hit)) / (end - start))
            return F.struct(
                F.lit(number).alias("number"),
                start.alias("start"),
                end.alias("end"),
                F.lit(kind).alias("kind"),
                _pattern_vote(kind, hit).alias("pattern"),
                _gazetteer_vote(kind, hit).alias("gazetteer"),
                _context_vote(kind, F.concat(before, F.lit(" "), after)).alias("context"),
                F.array(
                    F.concat(F.lit(f"{kind} length "), size.cast("string")),
                    F.concat(F.lit(f"{kind} digits "), share.cast("string")),
                    F.concat(F.lit("before "), _sort_of(F.right(before, F.lit(1)))),
                    F.concat(F.lit("after "), _sort_of(F.left(after, F.lit(1)))),
                ).alias("features"),
            )

        return F.transform(spans, lambda s: once(beside(s), lambda around: one(s, around)))

    spans = matches(text)
    base = [judged(k, i, spans[k]) for i, k in enumerate(BASE)]
    loose = [judged(k, i, spans[k]) for i, k in enumerate(LOOSE, len(BASE))]
    rows = rows.select("doc_id", F.concat(*base).alias("base"), F.concat(*loose).alias("loose"))
    return rows.select("doc_id", "base", free(F.col("loose"), F.col("base")).alias("loose"))


def _sort_of(character: Column) -> Column:
    return (
        F.when(F.coalesce(F.length(character), F.lit(0)) == 0, "edge")
        .when(character.rlike(r"\s"), "blank")
        .when(character.rlike("[0-9]"), "digit")
        .when(character.rlike(r"[A-Za-z]|[^\x00-\x7F]"), "letter")
        .otherwise("other")
    )


Votes = tuple[str, int, int, int]


def reliabilities(counts: dict[Votes, int], rounds: int = 50) -> dict[Votes, float]:
    """Probability of personal data for each pattern of votes, by expectation-maximisation.

    Labelers vote independently, given the truth. The start trusts the majority."""
    belief = {votes: 1 / (1 + math.exp(-1.0 * sum(votes[1:]))) for votes in counts}
    for _ in range(rounds):
        share: dict[str, list[float]] = {}
        votes_of = [[{v: 1.0 for v in (-1, 0, 1)} for _ in range(2)] for _ in range(3)]
        for votes, n in counts.items():
            p = belief[votes]
            of_kind = share.setdefault(votes[0], [1.0, 1.0])
            of_kind[1] += n * p
            of_kind[0] += n * (1 - p)
            for k, vote in enumerate(votes[1:]):
                votes_of[k][1][vote] += n * p
                votes_of[k][0][vote] += n * (1 - p)
        belief = {}
        for votes in counts:
            odds = math.log(share[votes[0]][1] / share[votes[0]][0])
            for k, vote in enumerate(votes[1:]):
                for truth, sign in ((1, 1), (0, -1)):
                    table = votes_of[k][truth]
                    odds += sign * math.log(table[vote] / sum(table.values()))
            belief[votes] = 1 / (1 + math.exp(-max(min(odds, 30.0), -30.0)))
    return belief


def _lookup(values: dict[str, float], key: Column) -> Column:
    if not values:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for item in sorted(values.items()) for x in item])
    return F.coalesce(F.try_element_at(table, key), F.lit(0.0))


def _votes_key(s: Column) -> Column:
    return F.concat_ws(" ", s["kind"], *(s[v].cast("string") for v in ("pattern", "gazetteer", "context")))


def personal_spans(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, base, added`` per document: spans as ``number, start, end, kind`` and more."""
    rows = materialise(candidates(docs), "personal")
    every = rows.select(F.explode(F.concat("base", "loose")).alias("s"))
    # At most 27 patterns of votes for each of eight kinds.
    counted = every.groupBy("s.kind", "s.pattern", "s.gazetteer", "s.context").count().collect()
    belief = reliabilities({(r[0], r[1], r[2], r[3]): r[4] for r in counted})
    odds = {
        " ".join(map(str, votes)): math.log(max(p, 1e-9) / max(1 - p, 1e-9))
        for votes, p in belief.items()
    }
    chance = 1 / (1 + F.exp(-_lookup(odds, _votes_key(F.col("s")))))
    # Features take few values each: a hundred rows or so.
    trained = (
        every.select(F.explode("s.features").alias("feature"), chance.alias("p"))
        .groupBy("feature")
        .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
        .collect()
    )
    yes = sum(n * belief[v] for v, n in {(r[0], r[1], r[2], r[3]): r[4] for r in counted}.items())
    no = sum(r[4] for r in counted) - yes
    weights = {
        r.feature: math.log((r.yes + 1) / (yes + 2)) - math.log((r.no + 1) / (no + 2)) for r in trained
    }

    def accepted(s: Column) -> Column:
        shape = F.aggregate(s["features"], F.lit(0.0), lambda had, f: had + _lookup(weights, f))
        return _lookup(odds, _votes_key(s)) + shape > math.log(threshold / (1 - threshold))

    return rows.select("doc_id", "base", F.filter("loose", accepted).alias("added"))


def personal_report(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, a count of each base kind, ``base_sha256`` and ``spans`` per document."""
    rows = personal_spans(docs, threshold)
    base = F.array_sort(_placed(F.col("base")))
    spans = F.array_sort(_placed(F.concat("base", "added")))
    return rows.select(
        "doc_id",
        *[count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def _placed(spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["number"].alias("number"), s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
