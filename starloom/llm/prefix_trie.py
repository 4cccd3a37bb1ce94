"""The trie of conversation prefixes, from composable fingerprints.

A sequence of turns has the fingerprint ``(n, h)``: its length, and the turns' hashes as
digits of a number to the base ``BASE`` modulo a prime. Fingerprints form a monoid: that of
two sequences in a row is ``(n1 + n2, h1 * BASE ** n2 + h2)``. So the fingerprints of all
prefixes of a rebuilt conversation (the head of its base, then its own turns after that
many) are composed from those of the two conversations it is rebuilt from. Turns are never
copied; a prefix refers to the turn it ends with by conversation and position.

1. Turns are dealt into ranges of their order and read once; each range has fingerprints
   from its own start, and a row per range tells what the conversation that runs into the
   next range has so far. A conversation may lie in many ranges.
2. Each rebuilt prefix becomes one row: conversation, depth, fingerprint, fingerprint of
   the prefix before, reference of the last turn.
3. Rows with one depth and fingerprint are a node. Nodes are verified: all members must
   have the same node before, and last turns that are equal text for text; where all refer
   to the same turn, they are. If a node fails, everything is done again with hashes of
   another key, so the result never rests on hashes alone.
4. Sums over subtrees need no walk: a node's own figures are put down to its smallest
   member, summed from the end of that conversation upwards (running sums over ranges), and
   every prefix row brings its conversation's sum to its node.

Defined cases: turns of a null conversation are left out. Null roles and texts are empty;
turns come by number, null first, then by role and text, so repeated rows are turns of their
own. ``c - c % 5`` takes the remainder with the sign of ``c``. A conversation whose base is
absent starts with nothing, and one without turns left is a member of the root. An empty
table gives no rows. Other columns are ignored. The ids of the conversations that end at a
node are hashed as a sorted stream: no list of them is held, but one task reads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.running import with_running_sums
from starloom.llm.tokens import limit_batches
from starloom.session import materialise

PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D1CE4E5B9BF58476D1CE4E5
GROUP, HEAD = 5, 9  # conversations that share a base; lengths of a head, from 0
Fingerprint = tuple[int, int]


def turn_hash(role: str, text: str, key: int, prime: int = PRIME) -> int:
    """A number from 1 to ``prime - 1`` for a turn."""
    raw = role.encode("utf-8", "surrogatepass")
    digest = hashlib.blake2b(digest_size=16, key=key.to_bytes(8, "big"))
    digest.update(len(raw).to_bytes(8, "big") + raw + text.encode("utf-8", "surrogatepass"))
    return int.from_bytes(digest.digest(), "big") % (prime - 1) + 1


def joined(left: Fingerprint, right: Fingerprint, prime: int = PRIME) -> Fingerprint:
    """Fingerprint of two sequences in a row."""
    return left[0] + right[0], (left[1] * pow(BASE, right[0], prime) + right[1]) % prime


def without_head(whole: Fingerprint, head: Fingerprint, prime: int = PRIME) -> Fingerprint:
    """Fingerprint of what follows the head in a sequence."""
    n = whole[0] - head[0]
    return n, (whole[1] - head[1] * pow(BASE, n, prime)) % prime


def _raw(value: int) -> bytes:
    return value.to_bytes(16, "big")


_READ = "conv long, part int, n long, h binary, before binary, bytes long, role string, text string"


def _fingerprints(key: int, prime: int):
    """Numbers and fingerprints of sorted turns, from the start of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, h = None, 0, 0
        for batch in batches:
            ns, hs, befores, sizes = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("conv", "role", "text"))
            for now, role, text in zip(*columns):
                if now != conv:
                    conv, n, h = now, 0, 0
                befores.append(_raw(h))
                n, h = n + 1, (h * BASE + turn_hash(role, text, key, prime)) % prime
                ns.append(n)
                hs.append(_raw(h))
                sizes.append(len(text.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("part"), pa.array(ns, pa.int64()),
                 pa.array(hs, pa.binary()), pa.array(befores, pa.binary()),
                 pa.array(sizes, pa.int64()), batch.column("role"), batch.column("text")],
                ["conv", "part", "n", "h", "before", "bytes", "role", "text"],
            )

    return run


def _carried(turns: DataFrame, prime: int) -> dict[int, tuple[int, int, int]]:
    """For each range (a row for each): conversation, number and fingerprint that run into it."""
    last = turns.groupBy("part").agg(
        F.min("conv").alias("first"), F.max(F.struct("conv", "n", "h")).alias("last")
    )
    out: dict[int, tuple[int, int, int]] = {}
    at: tuple[int, int, int] | None = None
    for row in sorted(last.collect()):
        n, h = row.last.n, int.from_bytes(row.last.h, "big")
        if at is not None:
            out[row.part] = at
            if row.first == row.last.conv == at[0]:
                n, h = joined(at[1:], (n, h), prime)
        at = row.last.conv, n, h
    return out


def _whole(carried: dict[int, tuple[int, int, int]], prime: int):
    """Numbers and fingerprints from the start of the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not any(p in carried for p in batch.column("part").unique().to_pylist()):
                yield batch.select(["conv", "n", "h", "before", "bytes", "role", "text"])
                continue
            rows = batch.to_pylist()
            for row in rows:
                conv, *so_far = carried.get(row["part"], (None, 0, 0))
                if row["conv"] == conv:
                    for name, n in (("h", row["n"]), ("before", row["n"] - 1)):
                        own = n, int.from_bytes(row[name], "big")
                        row[name] = _raw(joined(tuple(so_far), own, prime)[1])
                    row["n"] += so_far[0]
            names = ["conv", "n", "h", "before", "bytes", "role", "text"]
            yield pa.RecordBatch.from_pylist(
                [{k: r[k] for k in names} for r in rows],
                schema=pa.schema([batch.schema.field(k) for k in names]),
            )

    return run


def numbered_turns(conversations: DataFrame, key: int, prime: int = PRIME) -> DataFrame:
    """``conv, n, h, before, bytes, role, text``: each turn with its number and the
    fingerprints of the conversation up to it and before it."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv is not null")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("conv", F.spark_partition_id().alias("part"), "role", "text")
    turns = materialise(dealt.mapInArrow(_fingerprints(key, prime), _READ), "turns")
    schema = "conv long, n long, h binary, before binary, bytes long, role string, text string"
    return materialise(turns.mapInArrow(_whole(_carried(turns, prime), prime), schema), "turns")


def head_length(conv: Column) -> Column:
    """Turns a conversation takes from its base."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("long")


def _rebuilt_tails(prime: int):
    """Composes the fingerprints of base heads and own turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parents = [], []
            names = ("n", "h", "before", "own", "own_h", "taken", "head_h")
            for n, h, before, own, own_h, taken, head_h in zip(
                *(batch.column(c).to_pylist() for c in names)
            ):
                skipped = own, int.from_bytes(own_h, "big")
                head = taken, int.from_bytes(head_h, "big")
                for out, upto, raw in ((keys, n, h), (parents, n - 1, before)):
                    tail = without_head((upto, int.from_bytes(raw, "big")), skipped, prime)
                    out.append(_raw(joined(head, tail, prime)[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv", "depth", "bytes", "ref_conv", "ref_n", "last")]
                + [pa.array(keys, pa.binary()), pa.array(parents, pa.binary())],
                ["conv", "depth", "bytes", "ref_conv", "ref_n", "last", "key", "parent"],
            )

    return run


_ROWS = (
    "conv long, depth long, bytes long, ref_conv long, ref_n long, last boolean, key binary, "
    "parent binary"
)


def rebuilt_prefixes(turns: DataFrame, prime: int = PRIME) -> DataFrame:
    """A row for each prefix of each rebuilt conversation, from the empty one on: ``conv,
    depth, key, parent, bytes, ref_conv, ref_n, last``."""
    empty = F.lit(_raw(0))
    turns = turns.drop("role", "text")
    # At most HEAD - 1 turns of a conversation.
    short = turns.where(F.col("n") < HEAD).select("conv", F.struct("n", "h", "before", "bytes").alias("turn"))
    heads = short.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("head"))
    sizes = turns.groupBy("conv").agg(F.max("n").alias("turns"))
    convs = materialise(heads.join(sizes, "conv"), "conversations")
    own = convs.select(
        "conv", "turns", F.col("head").alias("own_head"),
        head_length(F.col("conv")).alias("wanted"),
        (F.col("conv") - F.col("conv") % GROUP).alias("base"),
    )
    base = convs.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    met = own.join(base, "base", "left").withColumn(
        "head", F.slice(F.coalesce("base_head", F.array().cast(_HEAD)), 1, F.col("wanted").cast("int"))
    )
    met = met.select(
        "conv", "base", "head", "wanted",
        F.size("head").cast("long").alias("taken"),
        F.coalesce(F.try_element_at("head", F.lit(-1))["h"], empty).alias("head_h"),
        F.coalesce(F.get("own_head", (F.col("wanted") - 1).cast("int"))["h"], empty).alias("own_h"),
        (F.size("head") + F.greatest(F.col("turns") - F.col("wanted"), F.lit(0))).alias("total"),
    )
    met = materialise(met, "rebuilt")
    root = met.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
        F.lit(None).cast("long").alias("ref_conv"), F.lit(None).cast("long").alias("ref_n"),
        (F.col("total") == 0).alias("last"), empty.alias("key"), F.lit(None).cast("binary").alias("parent"),
    )
    first = met.select("conv", "base", "total", F.explode("head").alias("turn")).select(
        "conv", F.col("turn.n").alias("depth"), "turn.bytes", F.col("base").alias("ref_conv"),
        F.col("turn.n").alias("ref_n"), (F.col("turn.n") == F.col("total")).alias("last"),
        F.col("turn.h").alias("key"), F.col("turn.before").alias("parent"),
    )
    depth = F.col("taken") + F.col("n") - F.col("wanted")
    rest = turns.join(met.drop("base", "head"), "conv").where("n > wanted").select(
        "conv", "n", "h", "before", "bytes", F.col("wanted").alias("own"), "own_h", "taken", "head_h",
        depth.alias("depth"), F.col("conv").alias("ref_conv"), F.col("n").alias("ref_n"),
        (depth == F.col("total")).alias("last"),
    )
    rest = rest.mapInArrow(_rebuilt_tails(prime), _ROWS)
    return root.unionByName(first).unionByName(rest)


_HEAD = "array<struct<n: long, h: binary, before: binary, bytes: long>>"


def _differing(rows: DataFrame, nodes: DataFrame, turns: DataFrame) -> int:
    """Nodes whose members differ in the node before, or turns that differ from the turn
    their node refers to."""
    split = nodes.where("not parent <=> other_parent").count()
    if split:
        return split
    met = rows.where("depth > 0").join(nodes.select("depth", "key", "ref"), ["depth", "key"])
    pairs = met.select(F.struct("ref_conv", "ref_n").alias("own"), "ref").where("own <> ref").distinct()
    text = turns.select(
        F.struct(F.col("conv").alias("ref_conv"), F.col("n").alias("ref_n")).alias("ref"), "role", "text"
    )
    own = text.select(F.col("ref").alias("own"), F.col("role").alias("own_role"), F.col("text").alias("own_text"))
    both = pairs.join(own, "own").join(text, "ref")
    return both.where("role <> own_role or text <> own_text").count()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the conversations that end at each node, from sorted rows."""
    schema = pa.schema([("depth", pa.int64()), ("key", pa.binary()), ("ends_sha256", pa.string())])
    at, digest = None, None
    for batch in batches:
        out = []
        for depth, key, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "conv"))):
            if (depth, key) != at:
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = (depth, key), hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema=schema)
    if at is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*at, digest.hexdigest())))], schema=schema)


def verified_prefixes(conversations: DataFrame, primes: list[int]) -> tuple[DataFrame, DataFrame]:
    """Prefix rows and nodes, with hashes under which no two prefixes are taken for one."""
    for key in range(1 << 31):
        prime = primes[min(key, len(primes) - 1)]
        turns = numbered_turns(conversations, key, prime)
        rows = materialise(rebuilt_prefixes(turns, prime), "prefixes")
        nodes = materialise(
            rows.groupBy("depth", "key").agg(
                F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"),
                F.min("parent").alias("parent"), F.max("parent").alias("other_parent"),
                F.max("bytes").alias("bytes"),
                F.min(F.struct("ref_conv", "ref_n")).alias("ref"),
            ),
            "nodes",
        )
        if not _differing(rows, nodes, turns):
            return rows, nodes
    raise RuntimeError("no key found")


def prefix_trie(conversations: DataFrame, primes: tuple[int, ...] = (PRIME,)) -> DataFrame:
    """One row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``; ``saved_tokens`` counts the bytes of turns that
    further members of a node need not store or read again."""
    limit_batches(conversations.sparkSession, 4 << 20)
    rows, nodes = verified_prefixes(conversations, list(primes))
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")
    ).agg(F.count("*").alias("n_children"))
    nodes = materialise(
        nodes.join(children, ["depth", "key"], "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
        ),
        "nodes",
    )
    met = rows.select("conv", "depth", "key", "last").join(
        nodes.select("depth", "key", "conv_id", "n_convs", "n_children", "bytes"), ["depth", "key"]
    )
    smallest = F.col("conv") == F.col("conv_id")
    own = met.select(
        "conv", "depth", "key",
        F.when(smallest, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(F.lit(0)).cast("long").alias("saved"),
        (smallest & F.col("last") & (F.col("n_children") == 0)).cast("long").alias("leaf"),
    )
    order = [F.col("conv"), F.col("depth").desc()]
    summed = materialise(
        with_running_sums(own, order, {"upto": F.col("saved"), "leaves": F.col("leaf")}), "summed"
    )
    # Sums start anew with each conversation, from its end.
    start = summed.groupBy("conv").agg(
        F.min(F.col("upto") - F.col("saved")).alias("had"), F.min(F.col("leaves") - F.col("leaf")).alias("had_leaves")
    )
    below = (
        summed.join(start, "conv")
        .groupBy("depth", "key")
        .agg(
            F.sum(F.col("upto") - F.col("had")).alias("saved_tokens"),
            F.sum(F.col("leaves") - F.col("had_leaves")).alias("n_leaves"),
        )
    )
    ended = rows.where("last").select("depth", "key", "conv")
    ends = (
        ended.repartition("depth", "key")
        .sortWithinPartitions("depth", "key", "conv")
        .mapInArrow(_ends, "depth long, key binary, ends_sha256 string")
    )
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(below, ["depth", "key"])
        .join(ends, ["depth", "key"], "left")
        .join(above, ["depth", "parent"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
