"""A Merkle tree over a dataset, with a proof for every row; places come from bitmaps, not from a sort.

1. Every row becomes a leaf, a digest of its fields. Texts are read once and never shuffled.
2. The ids of a group (``source``) are a bitmap, cut into containers of 1024 ids. Tasks set bits in
   64-bit words, kept only where a bit is set; the words of all tasks are merged by OR. A container
   has a directory: the bits before each of its words. Running totals of the containers' rows give
   each its first place.
3. A row's place is the first place of its container plus a rank query: the directory's entry of
   its word plus the bits below its own. Rows meet their containers, which have 1024 ids at most.
4. Sixteen consecutive places are a slot array, keyed by group and place; it becomes one node. That
   is repeated until a group has one node, its subroot. The subroots, numbered in the order of
   their groups, form a tree of the same kind.
5. Top down, every slot array gets the siblings on the way from its node to the root, which all its
   members share; a member's proof is its own siblings before those.

A bitmap has no room for copies of an id. Containers with more rows than bits are found by their
counts; their rows are numbered by a distributed sort, by id, then leaf. Hot ids and hot containers
(fewer than a thousand can be) stay in the tasks where they are. Equal rows have equal leaves, so it
does not matter which of them gets which place.

Edge cases: null ids come before all others, the null group before all groups. A null field is
written as ``-``, an empty one as ``0:``. An empty table has no tree and gives no rows. Columns
beside those named in the call are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalstrata.llm.common import join_keyed, running_totals
from pedalstrata.operators.numbering import sequence_id_distributed
from pedalstrata.sources.staging import discard, stage

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# 16 words of 64 bits are a container.
_CHUNK = "shiftright(id, 10)"
_WORD = "coalesce(cast(shiftright(id, 6) & 15 AS int), 0)"
_BIT = "coalesce(cast(id & 63 AS int), 0)"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """UTF-8 length, colon, value; ``-`` for null. No two lists of fields are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def containers(rows: DataFrame) -> DataFrame:
    """``grp``, ``chunk``: the words of each container, the bits before each, its bits and its rows."""
    words = rows.groupBy("grp", F.expr(_CHUNK).alias("chunk"), F.expr(_WORD).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, {_BIT})")).alias("bits"), F.count(F.lit(1)).alias("n")
    )
    merged = words.groupBy("grp", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"),  # 16 at most
        F.sum(F.bit_count("bits")).alias("ones"),
        F.sum("n").alias("n"),
    )
    directory = F.aggregate(
        "words", F.array(F.lit(0)), lambda sums, w: F.concat(sums, F.array(F.element_at(sums, -1) + F.bit_count(w["bits"])))
    )
    return merged.select("grp", "chunk", "words", directory.alias("before"), "ones", "n")


def _rank() -> Column:
    """Bits below the row's own in its container."""
    at = "cast(array_position(words.word, w) AS int)"
    return F.expr(f"element_at(before, {at}) + bit_count(element_at(words, {at}).bits & ~shiftleft(-1L, b))")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (``id``, ``grp``, ``leaf``, more) with ``pos``, the place among the rows of the group."""
    given = [F.col(c) for c in rows.columns]
    made = stage(containers(rows))
    index = stage(running_totals(made, ["grp"], ["chunk"], "n", "first").withColumn("rows", F.col("n")))
    discard(made)
    located = rows.select(*given, F.expr(_CHUNK).alias("chunk"), F.expr(_WORD).alias("w"), F.expr(_BIT).alias("b"))
    found = join_keyed(located, index, ["grp", "chunk"], "n")
    ranked = found.where("rows = ones").select(*given, (F.col("first") + _rank()).cast("bigint").alias("pos"))
    tied = index.where("rows > ones").select("grp", "chunk", "n", "first")
    if tied.isEmpty():
        return ranked
    # Numbers run through all of these rows; less those of earlier containers they are places.
    skipped = stage(running_totals(tied, [], ["grp", "chunk"], "n", "skip"))
    order = ["grp", "chunk", "id", "leaf"]
    copies = join_keyed(located.drop("w", "b"), skipped, ["grp", "chunk"], "n")
    numbered = sequence_id_distributed(copies, order, "number")
    return ranked.unionByName(numbered.select(*given, (F.col("first") + F.col("number") - 1 - F.col("skip")).alias("pos")))


def _reduced(nodes: DataFrame, group: Sequence[str]) -> tuple[list[DataFrame], DataFrame | None]:
    """Slot arrays per level, stored, and the last node of each group.

    ``nodes`` has ``pos``, ``node`` and ``own``, which the members of the first level keep. A lone slot
    at place 0 is the only node of its group, as places have no gaps.
    """
    levels, tops = [], None
    lone = (F.col("up") == 0) & (F.size("slots") == 1)
    while True:
        slots = F.array_sort(F.collect_list(F.struct("pos", "node", "own")))  # FAN at most
        level = nodes.groupBy(*group, F.expr(f"pos div {FAN}").alias("up")).agg(slots.alias("slots"))
        level = stage(level.withColumn("node", F.when(~lone, digest(F.array_join("slots.node", "")))))
        last = level.where("node IS NULL").select(
            *group, F.lit(len(levels)).alias("level"), F.col("up").alias("pos"), F.col("slots")[0]["node"].alias("node")
        )
        tops = last if tops is None else tops.unionByName(last)
        levels.append(level)
        nodes = level.where("node IS NOT NULL").select(*group, F.col("up").alias("pos"), "node", F.lit(None).cast("int").alias("own"))
        if nodes.isEmpty():
            return levels, stage(tops)


_SIDE = "array<struct<left:string,right:string>>"


def _members(level: DataFrame, above: DataFrame, group: Sequence[str], down: Sequence[str]) -> DataFrame:
    """Each member of the slot arrays with its path: its own siblings, then those of ``above``."""
    names = "transform(filter(slots, s -> s.pos {} member.pos), s -> s.node)"
    side = F.struct(*[F.array_join(F.expr(names.format(op)), "").alias(n) for n, op in (("left", "<"), ("right", ">"))])
    both = level.alias("l").join(above.alias("a"), _equal("l", "a", [*group, ("up", "pos")]))
    opened = both.select(*[F.col(f"l.{g}") for g in group], *[F.col(f"a.{c}") for c in [*down, "path"]], "slots", F.explode("slots").alias("member"))
    alone = F.size("slots") == 1
    # A lone top is its group's node itself and has no siblings; a lone last slot has one empty side.
    own = F.when(F.col("top") & alone, F.expr(f"cast(array() AS {_SIDE})")).otherwise(F.array(side))
    return opened.select(*group, *down, F.col("member.pos").alias("pos"), "member", F.concat(own, "path").alias("path"))


def _equal(a: str, b: str, on: Sequence[str | tuple[str, str]]) -> Column:
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    out = F.lit(True)
    for x, y in pairs:
        out = out & F.col(f"{a}.{x}").eqNullSafe(F.col(f"{b}.{y}"))
    return out


def _paths(levels: list[DataFrame], tops: DataFrame, group: Sequence[str], down: Sequence[str]) -> DataFrame:
    """Members of the first level with their paths; ``tops`` has the last nodes' ``path`` and ``down``."""
    known = None
    for number in reversed(range(len(levels))):
        own = tops.where(F.col("level") == number).select(*group, "pos", *down, "path", F.lit(True).alias("top"))
        above = own if known is None else known.withColumn("top", F.lit(False)).unionByName(own)
        members = _members(levels[number], above, group, ["top", *down])
        known = members.select(*group, "pos", *down, "path") if number else members
        if number:
            known = stage(known)
    return known


def manifest(rows: DataFrame) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``path``.

    ``rows`` has ``doc_id``, ``source`` (the group) and ``leaf``; other columns are kept. ``path`` is the
    proof: per level, from the leaf up, the siblings ``left`` and ``right`` of the node, as hex text.
    """
    keep = [c for c in rows.columns if c not in ("doc_id", "source", "leaf")]
    given = stage(
        rows.select(F.col("doc_id").cast("bigint").alias("id"), F.col("source").cast("string").alias("grp"), "leaf", F.struct(*(keep or ["leaf"])).alias("kept"))
    )
    leaves = placed(given).select("grp", "pos", F.col("leaf").alias("node"), F.struct("id", "kept").alias("own"))
    levels, tops = _reduced(leaves, ["grp"])
    numbered = sequence_id_distributed(tops.select(F.col("grp").alias("name")), ["name"], "number", unique=True)
    order = stage(tops.join(numbered, F.col("grp").eqNullSafe(F.col("name"))).select("grp", "level", "pos", "node", "number"))
    upper = order.select((F.col("number") - 1).alias("pos"), "node", F.struct("grp", "level", "pos").alias("own"))
    above, root = _reduced(upper, [])
    start = root.select("level", "pos", F.col("node").alias("root"), F.expr(f"cast(array() AS {_SIDE})").alias("path"))
    subroots = _paths(above, start, [], ["root"])
    subroots = stage(
        subroots.select("member.own.grp", "member.own.level", "member.own.pos", F.col("member.node").alias("subroot"), "root", "path")
    )
    found = _paths(levels, subroots, ["grp"], ["subroot", "root"])
    return found.select(
        F.col("member.own.id").alias("doc_id"),
        F.col("grp").alias("source"),
        F.col("member.node").alias("leaf"),
        *[F.col("member")["own"]["kept"][c].alias(c) for c in keep],
        "subroot",
        "root",
        "path",
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))
