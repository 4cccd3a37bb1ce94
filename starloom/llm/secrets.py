"""Secrets in texts, and parts of credentials that only tell together.

Three kinds are reported wherever they match: ``assign`` (a value given to a password,
token or key), ``access`` (cloud access ids) and ``hex`` (32 or more hex digits). Weaker
candidates are a part of a credential each: ``user`` (a named account or client id),
``opaque`` (a long run of letters of both cases and digits) and ``endpoint`` (an address
with a scheme or a port). They are reported when a complementary part lies in scope, which
is ``scope`` code points to either side:

- an identifier (``access``, ``user``) is linked by a secret (``assign``, ``hex``, ``opaque``),
- a secret by an identifier or an endpoint,
- an endpoint by a secret.

Linking is an interval join: parts go to bins of ``scope`` code points of their text, and
meet only parts of the same bin. Bins are short, spans do not overlap within a kind, so a
bin holds a bounded number of parts, however long the text or common the text is.

Defined cases: a null text is empty and holds nothing; rows of equal id and text get the
same result; a null id is a key like any other. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.spans import count_of, found, free, listed, named
from starloom.session import materialise

# The patterns of the base kinds.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
)
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

USER = (
    r"""(?i)(?:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key_?id)["']?"""
    r"""\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{3,}+)"""
)
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
ENDPOINT = (
    r"""(?:https?|ftps?|ssh|jdbc:[a-z]{1,20}|mongodb|postgres(?:ql)?|mysql|redis|amqps?)://[^\s"'<>]++"""
    r"|(?<![A-Za-z0-9.-])[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,10}+:[0-9]{2,5}(?![0-9])"
)

BASE = ["assign", "access", "hex"]
WEAK = ["user", "opaque", "endpoint"]
ROLE = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "identifier",
        "user": "identifier", "endpoint": "endpoint"}


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, base, weak`` per document: spans as ``start, number, kind, end``,
    weak ones only where they do not overlap a base one."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    text = F.col("text")
    assigned = F.filter(found(text, ASSIGN, 2), lambda s: F.length(s["part"]) >= 8)
    access = F.filter(found(text, ACCESS), lambda s: F.length(s["text"]) >= 16)
    mixed = F.filter(
        found(text, OPAQUE),
        lambda s: s["text"].rlike("[a-z]") & s["text"].rlike("[A-Z]") & s["text"].rlike("[0-9]"),
    )
    every = [
        assigned, access, found(text, HEX), found(text, USER), mixed, found(text, ENDPOINT),
    ]
    kinds = BASE + WEAK
    rows = rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.array_sort(F.concat(*[named(every[k], kinds[k], k) for k in range(3)])).alias("base"),
        F.array_sort(F.concat(*[named(every[k], kinds[k], k) for k in range(3, 6)])).alias("loose"),
    )
    weak = free(F.col("loose"), F.col("base"))
    return rows.select("doc_id", "text_key", "base", weak.alias("weak"))


def _role(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[kind]


def linked(rows: DataFrame, scope: int = 200) -> DataFrame:
    """``id, text_key, links``: weak spans with a complementary part in scope."""
    some = rows.where(F.size("weak") > 0).select(
        F.struct("doc_id").alias("id"), "text_key", "base", "weak"
    )
    weak = some.select("id", "text_key", F.explode("weak").alias("s")).distinct()
    weak = weak.select(
        "id", "text_key", "s", _role(F.col("s.kind")).alias("role"),
        F.explode(F.sequence(F.floor(F.col("s.start") / scope), F.floor(F.col("s.end") / scope))).alias("bin"),
    ).alias("w")
    parts = some.select("id", "text_key", F.explode(F.concat("base", "weak")).alias("s")).distinct()
    parts = parts.select(
        "id", "text_key", "s", _role(F.col("s.kind")).alias("role"),
        F.explode(
            F.sequence(
                F.floor((F.col("s.start") - scope) / scope), F.floor((F.col("s.end") + scope) / scope)
            )
        ).alias("bin"),
    ).alias("p")
    near = (F.col("p.s.start") <= F.col("w.s.end") + scope) & (
        F.col("p.s.end") >= F.col("w.s.start") - scope
    )
    fits = (F.col("w.role") != F.col("p.role")) & (
        (F.col("w.role") == "secret") | (F.col("p.role") == "secret")
    )
    on = [F.col(f"w.{c}") == F.col(f"p.{c}") for c in ("id", "text_key", "bin")]
    met = weak.join(parts, on[0] & on[1] & on[2] & near & fits, "left_semi")
    return (
        met.select("id", "text_key", "s")
        .distinct()
        .groupBy("id", "text_key")
        .agg(F.collect_list("s").alias("links"))
    )


def secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base, spans`` per document; ``base`` and ``spans``
    list ``start, number, kind, end`` by place, ``spans`` with the linked weak ones."""
    rows = materialise(candidates(docs), "secret_parts")
    links = linked(rows, scope).alias("l")
    joined = rows.alias("r").join(
        links,
        (F.struct(F.col("r.doc_id").alias("doc_id")) == F.col("l.id"))
        & (F.col("r.text_key") == F.col("l.text_key")),
        "left",
    )
    base = F.col("r.base")
    nothing = F.slice(base, F.lit(1), F.lit(0))
    counts = [count_of(base, kind).alias(f"n_{kind}") for kind in BASE]
    return joined.select(
        "r.doc_id",
        *counts,
        base.alias("base"),
        F.array_sort(F.concat(base, F.coalesce("l.links", nothing))).alias("spans"),
    )


def secret_report(docs: DataFrame, scope: int = 200) -> DataFrame:
    """The spans as text: ``base_sha256`` of the base ones, ``spans`` of all."""
    return secrets(docs, scope).select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
