"""Jaccard self-join of shingle sets by vertical partitioning of the global shingle order.

The global order is the order of the shingles' 64-bit hashes.  Cutting it into
fragments splits every set into segments, and the overlap of two sets is the
sum of the overlaps of their segments.

* **Equal sets** collapse first: they form a class with a 128-bit signature, and
  one set stands for it.
* **Candidates.**  Two sets with similarity of at least t differ in few shingles,
  and each shingle touches one fragment.  With more fragments than possible
  differences, some fragments must be equal in both, so pairs that share no
  whole segment need not be looked at.  The number of fragments follows from
  the set size, by size class; a set close to the lower end of its class also
  shows up in the class below.  A set leaves out empty segments unless it has
  more of them than the spare fragments make up for, so no link is lost.
* **Sketches.**  A set's sketch has one bit per hash bucket, the parity of the
  set's shingles in it, and a few bits per shingle.  Two sets differ in at least
  as many shingles as their sketches differ in bits, so a pair whose sketches
  differ in too many bits can't link.  This drops most candidates and never a
  link, and only the sets of the others are ever moved.
* **Overlaps.**  For a candidate pair the order is cut into ``PARTS`` fragments,
  partial overlaps are counted fragment by fragment, in different tasks, and
  summed per pair.
* **No all-pairs.**  A set of documents that share a segment is first compared
  with its least member only.  Then only documents in different components so
  far can matter.  The others' sketches are compared with each other, block
  against block, and give clusters; in a cluster with several components the
  sets are, again fragment by fragment.  Only a spanning set of pairs ever
  leaves a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.llm import words as wd
from caselabel.llm.components import components
from caselabel.llm.tables import hot_join, unused, written

#: Fragments of the order in which partial overlaps are counted.
PARTS = 4
#: Spare fragments beyond those that a pair's differences can touch.
SPARE = 2
#: Shingles of one block in the block-by-block comparison, and most sets in it.
BLOCK_SHINGLES, BLOCK_SETS = 1 << 19, 256
#: Bits of a sketch per shingle and at least, and sketch bits of one block.
SKETCH_SHARE, SKETCH_LEAST, SKETCH_BLOCK = 1, 128, 1 << 20


class Similarity:
    """The threshold ``num / den`` with the bounds that follow from it, in whole numbers."""

    def __init__(self, num: int = 90, den: int = 100) -> None:
        if not 0 < num <= den:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.num, self.den = num, den

    def differences(self, smaller: int) -> int:
        """Most shingles in which a set of this size and an equal or larger one can differ."""
        return smaller * self.den // self.num - smaller

    def largest(self, smaller: int) -> int:
        """Size of the largest set that can link with a set of this size."""
        return smaller * self.den // self.num

    def apart(self, both: int | np.ndarray | Column):
        """Most shingles in which two sets of together this many can differ, over a common denominator: ``(a, b)`` for a / b."""
        return both * (self.den - self.num), self.den + self.num

    def classes(self, top: int) -> np.ndarray:
        """Lower ends of the size classes; below the first, only equal sets link."""
        low = 1
        while self.differences(low) == 0 and low <= top:
            low += 1
        ends = [low]
        while ends[-1] <= top:
            ends.append(int(ends[-1] * 1.4) + 1)
        return np.array(ends, np.int64)


def segment_keys(shingle_set: np.ndarray, bounds: np.ndarray, sim: Similarity) -> np.ndarray:
    """Hashes of the whole segments of a sorted set, for each size class it shows up in."""
    n = len(shingle_set)
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    found = []
    totals = None
    for c in (own, own - 1):
        if c < 0 or (c < own and n > sim.largest(int(bounds[c + 1]) - 1)):
            continue
        count = sim.differences(int(bounds[c + 1]) - 1) + 1 + SPARE
        # Equal steps of the hash order; 32 leading bits times a small count stay below 2^64.
        fragment = ((shingle_set >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        cuts = np.searchsorted(fragment, np.arange(count + 1, dtype=np.uint64))
        if totals is None:
            totals = np.zeros(n + 1, np.uint64)
            np.cumsum(wd.mix(shingle_set ^ np.uint64(0x5851F42D4C957F2D)), out=totals[1:])
        sums = totals[cuts[1:]] - totals[cuts[:-1]]
        label = np.uint64((c + 1) << 40) + np.arange(count, dtype=np.uint64)
        keys = wd.mix(sums + wd.mix(label))
        filled = cuts[1:] > cuts[:-1]
        found.append(keys if count - int(filled.sum()) > SPARE else keys[filled])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def class_of(shingle_set: np.ndarray) -> int:
    """Name of the class of equal sets, in 64 bits."""
    return int(wd.mix(shingle_set ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).view(np.int64))


def sketch_bits(n: int) -> int:
    """Bits of the sketch of ``n`` shingles, a power of two."""
    return max(SKETCH_LEAST, 1 << (int(SKETCH_SHARE * n) - 1).bit_length()) if n else SKETCH_LEAST


def sketch_of(shingle_set: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each bucket, as 64-bit words; half as many buckets are the two halves' exclusive or."""
    bits = sketch_bits(len(shingle_set))
    place = (wd.mix(shingle_set + np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits) & 1).astype(bool)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    data, offsets = wd.buffers(column)
    for a, b in wd.slices(offsets):
        hashes, first = wd.shingles(wd.words(data, offsets[a : b + 1]), k)
        for i in range(b - a):
            yield np.unique(hashes[first[i] : first[i + 1]])


def _list(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def text_handle() -> Column:
    """Tells texts under one id apart."""
    return F.xxhash64(F.lit("handle"), "text")


def signatures(docs: DataFrame, k: int, sim: Similarity) -> DataFrame:
    """``(doc_id, handle, n, cid, check, keys, sketch)`` per row: set size, 128-bit signature, segment keys and sketch.

    ``cid`` names the class of equal sets.
    """

    def sign(batches):
        bounds = sim.classes(1 << 20)
        for batch in batches:
            for part in _pieces(batch):
                n, cid, check, keys, sketches = [], [], [], [], []
                for s in _sets(part.column(1), k):
                    if len(s) >= bounds[-1]:
                        bounds = sim.classes(2 * len(s))
                    n.append(len(s))
                    cid.append(class_of(s))
                    check.append(int(wd.mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64).view(np.int64)))
                    keys.append(segment_keys(s, bounds, sim) if len(s) >= bounds[0] else np.zeros(0, np.uint64))
                    sketches.append(sketch_of(s).view(np.uint64) if len(s) >= bounds[0] else np.zeros(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(check, pa.int64()), _list(keys), _list(sketches)],
                    ["doc_id", "handle", "n", "cid", "check", "keys", "sketch"],
                )

    schema = "doc_id long, handle long, n long, cid long, check long, keys array<long>, sketch array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_handle().alias("handle")).mapInArrow(sign, schema)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded text, so that results leave before the next piece is read."""
    _, offsets = wd.buffers(batch.column(1))
    for a, b in wd.slices(offsets, 4 * wd.SLICE_BYTES):
        yield batch.slice(a, b - a)


def segments(docs: DataFrame, k: int) -> DataFrame:
    """``(cid, part, segment)``: the sets of ``docs`` (``cid, text``) cut into ``PARTS`` fragments of the order."""
    shift = np.uint64(64 - (PARTS - 1).bit_length())

    def cut(batches):
        for batch in batches:
            for piece in _pieces(batch):
                cid, part, found = [], [], []
                for name, s in zip(piece.column(0).to_pylist(), _sets(piece.column(1), k), strict=True):
                    if class_of(s) != name:  # another text under the same id
                        continue
                    ends = np.searchsorted(s >> shift, np.arange(PARTS + 1, dtype=np.uint64))
                    for p in range(PARTS):
                        if ends[p + 1] > ends[p]:
                            cid.append(name)
                            part.append(p)
                            found.append(s[ends[p] : ends[p + 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid, pa.int64()), pa.array(part, pa.int32()), _list(found)], ["cid", "part", "segment"]
                )

    return docs.select("cid", "text").mapInArrow(cut, "cid long, part int, segment array<long>")


def linked(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs ``(a, b)`` that link, by partial overlaps counted per fragment and summed; ``na, nb`` are set sizes."""
    cut = pairs.select("a", "b", "na", "nb", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    left = sets.select(F.col("cid").alias("a"), "part", F.col("segment").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), "part", F.col("segment").alias("sb"))
    partial = cut.join(left, ["a", "part"]).join(right, ["b", "part"])
    partial = partial.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where(F.col("common") * sim.den >= (F.col("na") + F.col("nb") - F.col("common")) * sim.num).select("a", "b")


def _block_links(sim: Similarity):
    """Spanning links of one block pair, from the segments of its sets."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        cids, owner = np.unique(rows["cid"].to_numpy(), return_inverse=True)
        size, comp, side = (np.zeros(len(cids), np.int64) for _ in range(3))
        size[owner], comp[owner], side[owner] = rows["n"], rows["comp"], rows["side"]
        common = np.zeros((len(cids), len(cids)), np.float32)
        for part in rows["part"].unique():  # partial overlaps, fragment by fragment
            mine = np.flatnonzero((rows["part"] == part).to_numpy())
            parts = [np.asarray(rows["segment"].iat[i]) for i in mine]
            who = np.repeat(owner[mine], [len(p) for p in parts])
            _, column, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            shared = times[column] > 1
            place = (np.cumsum(times > 1) - 1)[column[shared]]
            step, who = 4096, who[shared]
            order = np.argsort(place, kind="stable")
            place, who = place[order], who[order]
            for low in range(0, int(place[-1]) + 1 if len(place) else 0, step):
                a, b = np.searchsorted(place, [low, low + step])
                grid = np.zeros((len(cids), step), np.float32)
                grid[who[a:b], place[a:b] - low] = 1
                common += grid @ grid.T
        union = size[:, None] + size[None, :] - common
        good = (common * sim.den >= union * sim.num) & (comp[:, None] != comp[None, :])
        if side.any():  # two different blocks: only across
            good &= side[:, None] != side[None, :]
        root = {c: c for c in comp.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(np.triu(good, 1)), strict=True):
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((cids[i], cids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def may_link(pairs: DataFrame, sketches: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs ``(a, b, na, nb)`` whose sketches do not rule a link out."""
    left = sketches.select(F.col("cid").alias("a"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("cid").alias("b"), F.col("sketch").alias("sb"))
    words = F.least(F.size("sa"), F.size("sb"))

    def folded(sketch: str) -> Column:
        parts = F.sequence(F.lit(0), (F.size(sketch) / words).cast("int") - 1)
        word = lambda i: F.aggregate(parts, F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(sketch, i + j * words)))
        return F.when(F.size(sketch) == words, F.col(sketch)).otherwise(F.transform(F.sequence(F.lit(0), words - 1), word))

    bits = F.aggregate(F.zip_with(folded("sa"), folded("sb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    most, part = sim.apart(F.col("na") + F.col("nb"))
    return pairs.join(left, "a").join(right, "b").where(bits * part <= most).select("a", "b", "na", "nb")


def _sketch_links(sim: Similarity):
    """Spanning pairs of one block pair that may link."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        cid, n, side = (rows[c].to_numpy() for c in ("cid", "n", "side"))
        sketches = [np.asarray(x, np.int64) for x in rows["sketch"]]
        words = min(map(len, sketches))
        folded = np.stack([np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) for x in sketches])
        signs = np.unpackbits(folded.view(np.uint8), axis=1).astype(np.float32) * 2 - 1
        bits = (64 * words - signs @ signs.T) / 2
        most, part = sim.apart(n[:, None] + n[None, :])
        good = bits * part <= most
        good &= np.minimum(n[:, None], n[None, :]) * sim.den >= np.maximum(n[:, None], n[None, :]) * sim.num
        if side.any():  # two different blocks: only across
            good &= side[:, None] != side[None, :]
        root = np.arange(len(cid))
        while True:  # least position reachable
            least = np.minimum(root, np.where(good, root[None, :], len(cid)).min(axis=1))
            least = least[least]
            if (least == root).all():
                break
            root = least
        other = root != np.arange(len(cid))
        return pd.DataFrame({"a": cid[other], "b": cid[root[other]]})

    return links


def _blocks(placed: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """Rows with a ``blocks`` number dealt to all pairs ``(i, j)`` of their own block and another."""
    placed = placed.withColumn("own", F.pmod(F.xxhash64(F.lit(1), "cid"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    return placed.select(*keys, *pair, (F.col("own") > F.col("other")).cast("int").alias("side"), *columns)


def _near(shared: DataFrame, sketches: DataFrame, sim: Similarity) -> DataFrame:
    """Spanning pairs ``(a, b)`` of the sets that share a segment, are not its least, and may link by their sketches.

    Segments with the same members are compared once, large ones in blocks.
    """
    others = shared.where("cid <> low").select("key", "cid", "n").distinct()
    keys = others.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"),
        F.max("n").alias("top"),
        F.bit_xor(F.xxhash64("cid")).alias("who"),
        F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("check"),
    )
    keys = keys.where("members > 1").groupBy("members", "who", "check", "top").agg(F.min("key").alias("key"))
    per_block = F.greatest(F.lit(2), F.least(F.lit(1024), F.floor(F.lit(SKETCH_BLOCK / SKETCH_SHARE) / F.col("top"))))
    keys = keys.select("key", F.ceil(F.col("members") / per_block).cast("int").alias("blocks"))
    members = _blocks(others.join(keys, "key"), ["key"], "cid", "n").join(sketches, "cid")
    return members.groupBy("key", "i", "j").applyInPandas(_sketch_links(sim), "a long, b long").distinct()


def _rest(near: DataFrame, comps: DataFrame, sizes: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """Links between sets that ``near`` connects but that stand in different components so far.

    What ``near`` connects, directly or by others, is a cluster.  In a cluster
    only sets of similar size can link: it is cut into bands of sizes, ``2^c``
    to ``2^(c+1)`` and those around each ``2^c``.  Large bands are compared block
    by block.
    """
    clusters = components(near).select(F.col("node").alias("cid"), F.col("component").alias("cluster"))
    comps = comps.select(F.col("node").alias("cid"), F.col("component").alias("comp"))
    members = clusters.join(sizes, "cid").join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    power = F.floor(F.log2(F.col("n") + F.lit(0.5)))
    start = F.pow(F.lit(2), power)
    bands = F.array_compact(
        F.array(
            2 * power,
            F.when(F.col("n") * sim.num <= start * sim.den, 2 * power - 1),
            F.when(F.col("n") * sim.den >= 2 * start * sim.num, 2 * power + 1),
        )
    )
    members = written(members.withColumn("band", F.explode(bands)), "jaccard-members")
    groups = members.groupBy("cluster", "band").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("members"), F.max("n").alias("top")
    )
    per_block = F.greatest(F.lit(2), F.least(F.lit(BLOCK_SETS), F.floor(F.lit(BLOCK_SHINGLES) / F.col("top"))))
    blocks = F.ceil(F.col("members") / per_block).cast("int")
    groups = groups.where("c0 <> c1").select("cluster", "band", blocks.alias("blocks"), "members")
    placed = hot_join(members, groups, ["cluster", "band"], "members", members.count())
    full = _blocks(placed, ["cluster", "band"], "cid", "n", "comp").join(sets, "cid")
    return full.groupBy("cluster", "band", "i", "j").applyInPandas(_block_links(sim), "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``; see ``linked_texts``."""
    return linked_texts(docs, k, num, den).drop("handle")


def linked_texts(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``(doc_id, handle, n_shingles, component_id)`` of every row of ``docs`` (``doc_id, text``).

    Texts link when ``den`` times their common shingles is at least ``num``
    times all their shingles.  ``component_id`` is the smallest ``doc_id``
    reachable by links.  Each row stands for its own text, so repeated rows
    share a component.  Null, empty and blank texts have no shingles, link with
    nothing and are their own component.  Rows with a null ``doc_id`` share the
    component of equal texts; a text that stands under a null id only links with
    no other text and has no component.  Other columns are ignored; an empty
    table gives an empty result.
    """
    sim = Similarity(num, den)
    rows = written(signatures(docs, k, sim), "jaccard-rows")
    classes = rows.where("n > 0").groupBy("cid", "check", "n").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("sketch").alias("sketch"))
    classes = written(classes, "jaccard-classes")
    by_key = W.partitionBy("key")
    keyed = rows.select(F.explode("keys").alias("key"), "cid", "n")
    keyed = keyed.withColumns({"low": F.min("cid").over(by_key), "high": F.max("cid").over(by_key)})
    shared = written(keyed.where("low <> high").select("key", "cid", "n", "low"), "jaccard-shared")
    candidates = shared.select("cid").distinct().join(classes.where("least IS NOT NULL"), "cid")
    candidates = written(candidates.select("cid", "n", "least", "sketch"), "jaccard-candidates")
    sizes, sketches = candidates.select("cid", "n"), candidates.select("cid", "sketch")
    first = shared.where("cid <> low").select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("low").alias("b")).distinct()
    first = first.join(sizes.select(F.col("cid").alias("b"), F.col("n").alias("nb")), "b")
    within = F.least("na", "nb") * sim.den >= F.greatest("na", "nb") * sim.num
    first = written(may_link(first.where(within), sketches, sim), "jaccard-pairs")
    near = written(_near(shared, sketches, sim), "jaccard-near")
    involved = first.select(F.explode(F.array("a", "b")).alias("cid")).union(near.select(F.explode(F.array("a", "b"))))
    involved = written(involved.distinct().join(candidates.select("cid", "least"), "cid"), "jaccard-involved")
    # The row with the least id stands for a class; other texts under that id are told apart by their signature.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        involved.select(F.col("least").alias("doc_id"), "cid"), "doc_id"
    )
    sets = written(segments(texts.dropDuplicates(["doc_id", "cid", "text"]).select("cid", "text"), k), "jaccard-sets")
    links = written(linked(first, sets, sim), "jaccard-links")
    more = written(_rest(near, components(links), sizes, sets, sim), "jaccard-more")
    comps = written(components(links.unionByName(more)), "jaccard-components")
    named = comps.withColumnRenamed("node", "cid").join(classes, "cid")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("copies").alias("rows"))
    total = rows.count()
    of_class = hot_join(comps.withColumnRenamed("node", "cid"), least, ["component"], "rows", total).select("cid", "component_id")
    answer = classes.join(of_class, "cid", "left").select(
        "cid", "check", "n", F.coalesce("component_id", "least").alias("component_id"), "copies"
    )
    keep = rows.select("doc_id", "handle", "n", "cid", "check")
    full = hot_join(keep.where("n > 0"), answer, ["cid", "check", "n"], "copies", total)
    alone = keep.where("n = 0").select("doc_id", "handle", "n", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "handle", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles")


def keep_first(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``doc_id``.

    All columns stay.  Of different linked texts under that id one stays, and of
    equal rows one.  Rows without shingles link with nothing and all stay, as do
    rows without an id, which can't be told apart.
    """
    found = linked_texts(docs, k, num, den).where("n_shingles > 0 AND doc_id IS NOT NULL")
    texts = found.groupBy("doc_id", "handle").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("copies"))
    texts = written(texts, "jaccard-texts")
    own = texts.where("doc_id = component_id")
    winner = own.groupBy("doc_id").agg(F.min("handle").alias("winner"))
    lost = texts.where("doc_id <> component_id").select("doc_id", "handle")
    lost = lost.unionByName(own.join(winner, "doc_id").where("handle <> winner").select("doc_id", "handle"))
    repeated = own.where("copies > 1").select("doc_id", "handle")
    # The lists are narrow; the texts are shuffled once by id and handle, for all three joins.
    row, names = unused("handle", docs), docs.columns
    marked = docs.withColumn(row, text_handle())

    def by_row(keys: DataFrame) -> DataFrame:
        return keys.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("handle").alias(row))

    kept = marked.join(by_row(lost), ["doc_id", row], "left_anti")
    single = kept.join(by_row(repeated), ["doc_id", row], "left_anti")
    rank = unused("rank", marked)
    order = W.partitionBy("doc_id", row).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in names)))
    one = kept.join(by_row(repeated), ["doc_id", row], "left_semi").withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return single.select(names).unionByName(one.select(names))
