"""Word features of a text, computed row by row inside the JVM.

A document's tokens stay in one array: no row per token, no join, no shuffle. Tokens
outside the word lists are dropped first with a hash lookup, keeping positions, and
the few that remain are looked up in literal hash tables: an array of small maps, one of
which a checksum of the word picks, so that a lookup costs the same for any list.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: everything but these letters separates tokens.
SEPARATOR = "[^a-zàâäéèêëîïôöùûüç]+"


def tokenise(text: Column) -> Column:
    """Lower-case text to tokens; empty ones at the edges are kept so positions hold."""
    return F.split(text, SEPARATOR, -1)


@dataclass(frozen=True)
class Vocabulary:
    """The word lists as lookup rows; a word listed twice counts twice."""

    lexicon: list[tuple[str, str, int]]
    taxonomy: list[tuple[str, str, str, int]]
    negations: list[tuple[str, str]]
    reach: int = 2
    words: list[str] = field(init=False)

    def __post_init__(self):
        words = {word for word, _, _ in self.lexicon}
        words |= {keyword for _, _, keyword, _ in self.taxonomy}
        words |= {word for word, _ in self.negations}
        object.__setattr__(self, "words", sorted(words))

    def polarity(self) -> dict[str, list[int]]:
        found = defaultdict(list)
        for word, _, polarity in self.lexicon:
            found[word].append(polarity)
        return found

    def categories(self) -> dict[str, list[tuple[str, int]]]:
        found = defaultdict(list)
        for category, _, keyword, priority in self.taxonomy:
            found[keyword].append((category, priority))
        return found

    def tags(self) -> dict[str, list[str]]:
        found = defaultdict(list)
        for word, _, polarity in self.lexicon:
            found[word].append(f"{word}:neg" if polarity < 0 else f"{word}:pos")
        for category, _, keyword, _ in self.taxonomy:
            found[keyword].append(f"{category}:cat")
        return found


class HashTable:
    """A constant table by word, parsed once when the plan is optimised."""

    def __init__(self, entries: dict, kind: str):
        self.size = 1 << max(0, (len(entries) - 1).bit_length())
        slots: list[dict] = [{} for _ in range(self.size)]
        for word, value in entries.items():
            slots[zlib.crc32(word.encode()) % self.size][word] = value
        text = json.dumps(slots, ensure_ascii=False)
        self.slots = F.from_json(F.lit(text), f"array<map<string,{kind}>>")

    def __getitem__(self, word: Column) -> Column:
        slot = (F.crc32(word.cast("binary")) % self.size).cast("int")
        return F.get(self.slots, slot)[word]


def known_tokens(tokens: Column, vocabulary: Vocabulary) -> Column:
    """The tokens found in any word list, as array<struct<at, word>>."""
    placed = F.transform(tokens, lambda word, at: F.struct(at.alias("at"), word.alias("word")))
    return F.filter(placed, lambda token: token.word.isin(vocabulary.words))


def sentiment(known: Column, vocabulary: Vocabulary) -> Column:
    """struct<raw, hits>: polarity sum and count of the polarised tokens.

    A negation within the ``reach`` tokens before a polarised one turns its sign once.
    """
    polarity = vocabulary.polarity()
    total = HashTable({word: sum(found) for word, found in polarity.items()}, "bigint")
    count = HashTable({word: len(found) for word, found in polarity.items()}, "bigint")
    negations = sorted({word for word, _ in vocabulary.negations})
    far = -vocabulary.reach - 1
    zero = F.lit(0).cast("long")

    def step(state: Column, token: Column) -> Column:
        value = F.coalesce(total[token.word], zero)
        turned = token.at - state["last"] <= vocabulary.reach
        return F.struct(
            F.when(token.word.isin(negations), token.at).otherwise(state["last"]).alias("last"),
            (state["raw"] + F.when(turned, -value).otherwise(value)).alias("raw"),
            (state["hits"] + F.coalesce(count[token.word], zero)).alias("hits"),
        )

    start = F.struct(F.lit(far).alias("last"), zero.alias("raw"), zero.alias("hits"))
    return F.aggregate(known, start, step)


def category_matches(known: Column, vocabulary: Vocabulary) -> Column:
    """array<struct<category, priority>>: one entry per matching list row."""
    by_word = HashTable(
        {
            word: [{"category": c, "priority": p} for c, p in found]
            for word, found in vocabulary.categories().items()
        },
        "array<struct<category:string,priority:int>>",
    )
    found = F.filter(F.transform(known, lambda token: by_word[token.word]), lambda m: m.isNotNull())
    return F.flatten(found)


def categories(matches: Column) -> Column:
    """The distinct categories, sorted."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["category"])))


def main_category(matches: Column, default: str = "general") -> Column:
    """Most matches first, then the best (lowest) priority, then the name."""

    def score(category: Column) -> Column:
        own = F.filter(matches, lambda m: m["category"] == category)
        best = F.array_min(F.transform(own, lambda m: m["priority"]))
        return F.struct((-F.size(own)).alias("n"), best.alias("p"), category.alias("c"))

    return F.coalesce(F.array_min(F.transform(categories(matches), score))["c"], F.lit(default))


def tags(known: Column, vocabulary: Vocabulary) -> Column:
    """Sorted distinct ``word:neg``, ``word:pos`` and ``category:cat`` tags."""
    by_word = HashTable(vocabulary.tags(), "array<string>")
    found = F.filter(F.transform(known, lambda token: by_word[token.word]), lambda t: t.isNotNull())
    return F.array_sort(F.array_distinct(F.flatten(found)))
