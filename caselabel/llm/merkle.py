"""Merkle manifest of a dataset by slot pivots.

A row's leaf hashes its five columns.  The leaves of a language, by ``doc_id``,
are the bottom of a tree; every run of ``fanout`` nodes becomes the hash of their
hashes until one is left, the language's subroot.  The subroots, by language, are
the bottom of one more tree, which gives the root.

* **Slot pivot.**  One aggregate by parent spreads the children into ``fanout``
  columns, one conditional aggregate for each slot.  All columns concatenated
  hash to the parent; what stands before and after the own slot's column are the
  siblings, which the proofs of everything below that slot get appended.
* **Levels per shuffle.**  ``LEVELS`` levels lie in blocks of ``fanout ** LEVELS``
  consecutive nodes.  Nodes are dealt out once by tree and block; as every pivot
  groups by these two as well, the levels of a block need no further exchange.
  So a tree of a billion leaves takes five shuffles, each a 64th of the one before.
* **Up, then down.**  Going up, only hashes move, and each stratum of blocks is a
  written table.  Going down, each stratum is pivoted again, now with the proofs,
  and meets the proofs of its blocks' tops.  Proofs of leaves are never shuffled.
* **Places.**  Leaves are range-partitioned by language, id and hash; a place is a
  partition's start plus the offset in it.  No window holds a language, and equal
  rows may lie in several partitions.

Texts are read once, where they lie; leaves of 32 bytes move instead.

Null values have a leaf like any other (``-``); a null language is a language of
its own, before the others; a null id comes first and is never tampered with.
Repeated ids are ordered by leaf, repeated rows are leaves each.  An empty table
gives no row.  Columns other than the five are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.llm.tables import hot_join, written

FANOUT = 2
#: Levels pivoted between two shuffles.
LEVELS = 6
#: One of so many documents is tampered with, by the checksum of its id.
TAMPER = 7

_PATH = "array<struct<left: binary, right: binary>>"
_EMPTY = "X''"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 bytes, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(n_chars: Column) -> Column:
    """Hash, as 32 bytes, of a document row with ``n_chars`` in the place of its own."""
    parts = [field(F.col(c)) for c in ("doc_id", "source", "lang")] + [field(n_chars), field(F.col("text"))]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their place from 0 in the order of ``by``.

    The sorted ranges are a written table, so that places stay what they are when
    a task runs again.  Rows alike in ``by`` may fall into different ranges.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
    placed = written(ranged.withColumn("_at", F.monotonically_increasing_id()), name)
    part, offset = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # one row per partition
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    found = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return found.withColumn("pos", F.col("_start") + offset).drop("_part", "_start", "_at")


def lift(nodes: DataFrame, carry: list[str], fanout: int, levels: int) -> DataFrame:
    """The nodes ``levels`` levels higher, each with the proofs of all below it.

    ``nodes`` has ``tree, idx, size, hash`` (``size`` nodes in the tree's level).
    ``members`` lists the columns ``carry`` of each node below and its ``path``,
    the siblings left and right of it by level.  A tree with one node left stays.
    """
    kept = "".join(f"'{c}', {{0}}{c}, " for c in carry)
    start = f"named_struct({kept.format('')}'path', CAST(array() AS {_PATH}))"
    now = nodes.selectExpr("tree", f"idx div {fanout**levels} AS block", "idx", "size", "hash", f"array({start}) AS members")
    now = now.repartition("tree", "block")
    nobody = f"CAST(array() AS {now.schema['members'].dataType.simpleString()})"
    slots = range(fanout)
    pivots = [f"max(CASE WHEN idx % {fanout} = {s} THEN hash END) AS hash{s}" for s in slots]
    pivots += [f"first(CASE WHEN idx % {fanout} = {s} THEN members END, true) AS members{s}" for s in slots]
    spread = [f"coalesce(hash{s}, X'')" for s in slots]
    below = []
    for s in slots:
        siblings = f"named_struct('left', concat(X'', {', '.join(spread[:s] or [_EMPTY])}), 'right', concat(X'', {', '.join(spread[s + 1 :] or [_EMPTY])}))"
        path = f"concat(m.path, IF(width > 1, array({siblings}), CAST(array() AS {_PATH})))"
        below.append(f"coalesce(transform(members{s}, m -> named_struct({kept.format('m.')}'path', {path})), {nobody})")
    hashed = f"IF(width > 1, unhex(sha2(lower(hex(concat({', '.join(spread)}))), 256)), hash0) AS hash"
    for _ in range(levels):
        by = [F.expr(e) for e in ("tree", "block", "size AS width", f"idx div {fanout} AS idx")]
        now = now.groupBy(*by).agg(*[F.expr(e) for e in pivots])
        now = now.selectExpr("tree", "block", f"(width + {fanout - 1}) div {fanout} AS size", "idx", hashed, f"concat({', '.join(below)}) AS members")
    # The one node left of a block has its number; by this name the dealing by block serves the join with the level above.
    return now.select("tree", F.col("block").alias("idx"), "size", "hash", "members")


class Forest:
    """Trees over ``nodes`` (``tree, idx, size, hash`` and more columns), kept as strata of blocks.

    ``largest`` is the largest ``size``.  ``roots`` has one row per tree.
    """

    def __init__(self, nodes: DataFrame, largest: int, fanout: int = FANOUT, levels: int = LEVELS):
        self.fanout, self.levels = fanout, levels
        self.strata = [nodes]
        while largest > 1:
            up = lift(self.strata[-1], ["idx"], fanout, levels).select("tree", "idx", "size", "hash")
            self.strata.append(written(up, "merkle-stratum"))
            largest = -(-largest // fanout**levels)

    @property
    def roots(self) -> DataFrame:
        return self.strata[-1].select("tree", "hash")

    def proofs(self, tops: DataFrame, carry: list[str]) -> DataFrame:
        """``carry`` of each bottom node, its ``path`` up to the root and beyond it, and the tree's ``top``.

        ``tops`` has ``tree``, the ``path`` from the tree's root on, and ``top``, any value.
        """
        above = tops.select("tree", F.lit(0).cast("long").alias("idx"), F.col("path").alias("_path"), "top")
        for k in range(len(self.strata) - 2, -1, -1):
            kept = carry if k == 0 else ["idx"]
            met = lift(self.strata[k], kept, self.fanout, self.levels).select("tree", "idx", "members").join(above, ["tree", "idx"])
            each = met.select("tree", "top", "_path", F.explode("members").alias("m"))
            longer = F.concat(F.col("m.path"), F.col("_path"))
            if k == 0:
                return each.select(*[F.col(f"m.{c}").alias(c) for c in carry], longer.alias("path"), "top")
            above = written(each.select("tree", F.col("m.idx").alias("idx"), longer.alias("_path"), "top"), "merkle-proofs")
        return self.strata[0].join(above, ["tree", "idx"]).select(*carry, F.col("_path").alias("path"), "top")


def proof_hash(path: Column) -> Column:
    """Hash of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: _hex(F.concat(p["left"], p["right"]))), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to, in hex."""
    return F.aggregate(path, _hex(leaf), lambda node, p: F.sha2(F.concat(_hex(p["left"]), node, _hex(p["right"])), 256))


def proofs(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Every document's ``leaf``, ``used`` (the leaf after tampering, if any), ``path`` and ``top`` (subroot and root).

    Hashes are of 32 bytes.  ``path`` holds the siblings, left and right, of each level.
    """
    n_chars = F.col("n_chars")
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPER)) == 0
    # A null language sorts first and must not be lost in joins, so it gets a name of its own.
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    leaves = docs.select("doc_id", lang.alias("lang"), leaf_of(n_chars).alias("leaf"), F.when(hit, leaf_of(F.try_add(n_chars, F.lit(1)))).alias("bent"))
    leaves = numbered(written(leaves, "merkle-leaves"), ["lang", "doc_id", "leaf"], "merkle-places")

    trees = written(leaves.groupBy("lang").agg(F.min("pos").alias("tree"), F.count(F.lit(1)).alias("size")), "merkle-trees")
    total, largest, n_trees = trees.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0)), F.count(F.lit(1))).first()
    used = F.coalesce("bent", "leaf").alias("used")
    placed = hot_join(leaves, trees.withColumn("rows", F.col("size")), ["lang"], "rows", total)
    nodes = placed.select("tree", (F.col("pos") - F.col("tree")).alias("idx"), "size", F.col("leaf").alias("hash"), "doc_id", "leaf", used)
    nodes = written(nodes, "merkle-nodes")

    bottom = Forest(nodes, largest, fanout, levels)
    # ``tree`` is the place of a language's first leaf, so subroots are in the order of their languages.
    subroots = numbered(bottom.roots, ["tree"], "merkle-subroots")
    subroots = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("pos").alias("idx"), F.lit(n_trees).cast("long").alias("size"), "hash", F.col("tree").alias("of"))
    top = Forest(written(subroots, "merkle-top"), n_trees, fanout, levels)
    root = top.roots.select("tree", F.array().cast(_PATH).alias("path"), F.col("hash").alias("top"))
    tops = top.proofs(root, ["of", "hash"]).select(F.col("of").alias("tree"), "path", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"))
    return bottom.proofs(written(tops, "merkle-tops"), ["doc_id", "leaf", "used"])


def manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every document row."""
    found = proofs(docs, fanout, levels).select("doc_id", "leaf", "path", "top", fold(F.col("used"), F.col("path")).alias("folded_root"))
    root = _hex(F.col("top.root"))
    return found.select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        _hex(F.col("top.subroot")).alias("subroot"),
        root.alias("root"),
        proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
