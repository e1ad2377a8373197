"""Near-duplicate embeddings with a forest of random-projection trees.

Vectors are compared only within their group: equal label and equal dimension.

* **Equal vectors** collapse to a class with a count, so copies cost nothing.
* **Forest.**  A group above ``MAX_LEAF`` vectors is split by ``TREES`` trees.  A
  node has a random direction, drawn from a seed that names the node, and cuts
  at a place between the quartiles of a bounded sample of the group.  Vectors
  near the cut go to both sides: the margin is ``SPILL`` times the distance of
  two vectors that just link.  The cut lies where the fewest do, so a cluster
  stays whole if it can.  Leaves that are still too large are split again by a
  tree of their own, fitted on their own sample.
* **Leaves.**  All pairs of a leaf are compared, by a matrix product, with the
  cosine of the original vectors in double precision.  Every vector carries the
  list of its leaves, so a pair that shares several leaves counts in the first
  of them only.  A leaf gives link counts and a spanning set of its links, both
  no longer than the leaf.
* **Dense leaves.**  Where most vectors are near any cut, or much of a sample
  links, cutting would lose links or gain nothing.  Such a leaf is not split; it
  is compared block against block, exactly, in tasks of bounded size.
* **Union.**  The spanning links go to the connected components in Spark.

Groups up to ``MAX_LEAF`` and dense leaves are compared in full; the others are
found with the recall of the forest, which the tests hold against brute force.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.llm.components import components
from caselabel.llm.tables import hot_join, written

LEAST_COSINE = 0.93
TREES = 8
LEAF, MAX_LEAF = 512, 2048
SPILL = 0.5
#: Largest share of a node's sample near the cut.
MOST_SPILL = 0.5
#: Sampled vectors of a group, the most levels fitted on them at once, and the rounds of splitting.
SAMPLE, LEVELS, ROUNDS = 2048, 7, 6
#: Share of linked pairs in the sample from which a leaf is dense, and the block size there.
DENSE, BLOCK = 0.05, 1024
SEED = 97


@lru_cache(maxsize=256)
def _directions(gid: int, tree: int, levels: int, dim: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, gid & 0xFFFFFFFF, (gid >> 32) & 0xFFFFFFFF, tree, dim])
    return rng.standard_normal(((1 << levels) - 1, dim))


def _vectors(column) -> np.ndarray:
    """Rows of packed doubles as a matrix; the rows have one length."""
    parts = [bytes(b) for b in column]
    return np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _members(unit: np.ndarray, directions: np.ndarray, bands: np.ndarray, levels: int) -> np.ndarray:
    """``vectors x leaves``: which leaves of one tree a vector falls into."""
    place = unit @ directions.T
    now = np.ones((len(unit), 1), bool)
    for level in range(levels):
        first, count = (1 << level) - 1, 1 << level
        here = place[:, first : first + count]
        left = now & (here <= bands[first : first + count, 1])
        right = now & (here > bands[first : first + count, 0])
        now = np.stack([left, right], axis=2).reshape(len(unit), -1)
    return now


def fit_tree(unit: np.ndarray, gid: int, tree: int, levels: int, margin: float) -> np.ndarray:
    """Lower and upper cut of every node, from a sample; a node that is not split sends all to its first side."""
    directions = _directions(gid, tree, levels, unit.shape[1])
    bands = np.full((len(directions), 2), np.inf)
    place = unit @ directions.T
    now = [np.arange(len(unit))]
    for level in range(levels):
        below = []
        for i, rows in enumerate(now):
            node = (1 << level) - 1 + i
            values = np.sort(place[rows, node])
            if len(values) > 1:
                cuts = np.quantile(values, np.linspace(0.25, 0.75, 11))
                near = np.searchsorted(values, cuts + margin) - np.searchsorted(values, cuts - margin)
                best = int(np.lexsort((np.abs(np.arange(11) - 5), near))[0])
                if near[best] <= MOST_SPILL * len(values):
                    bands[node] = cuts[best] - margin, cuts[best] + margin
            below += [rows[place[rows, node] <= bands[node, 1]], rows[place[rows, node] > bands[node, 0]]]
        now = below
    return bands


def _fits(sample: DataFrame, trees: int, bar: float, spill: float) -> DataFrame:
    """``(gid, dense, levels, bands)`` of each group from its sampled rows ``(gid, vec, place, members)``."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "cid"]).head(SAMPLE)
        unit = _unit(_vectors(rows["vec"]))
        gid, members = int(rows["gid"].iat[0]), int(rows["members"].iat[0])
        near = unit[:512] @ unit[:512].T >= bar
        pairs = max(1, len(near) * (len(near) - 1))
        margin = spill * np.sqrt(max(0.0, 2 - 2 * bar))
        levels = max(1, min(LEVELS, int(np.ceil(np.log2(members / LEAF))), int(np.log2(max(2, len(unit) // 8)))))
        bands = [fit_tree(unit, gid, t, levels, margin) for t in range(trees)]
        dense = trees == 1 and ((near.sum() - len(near)) / pairs >= DENSE or np.isinf(bands[0][0, 0]))
        return pd.DataFrame({"gid": [gid], "dense": [bool(dense)], "levels": [levels], "bands": [b"".join(b.tobytes() for b in bands)]})

    return sample.groupBy("gid").applyInPandas(fit, "gid long, dense boolean, levels int, bands binary")


def _assigned(rows: DataFrame, trees: int) -> DataFrame:
    """``(cid, leaf)`` for each leaf of each row ``(cid, gid, vec, levels, bands)``."""

    def leaves(frames):
        for frame in frames:
            for gid, part in frame.groupby("gid", sort=False):
                levels, raw = int(part["levels"].iat[0]), part["bands"].iat[0]
                unit = _unit(_vectors(part["vec"]))
                bands = np.frombuffer(raw, np.float64).reshape(trees, -1, 2)
                cid = part["cid"].to_numpy()
                whole = [t for t in range(trees) if np.isinf(bands[t][0, 0])]
                if whole:  # trees that don't split have one leaf in common
                    yield pd.DataFrame({"cid": cid, "gid": np.full(len(cid), gid), "tree": np.full(len(cid), -1, np.int32), "slot": np.zeros(len(cid), np.int32)})
                for t in sorted(set(range(trees)) - set(whole)):
                    row, leaf = np.nonzero(_members(unit, _directions(int(gid), t, levels, unit.shape[1]), bands[t], levels))
                    yield pd.DataFrame({"cid": cid[row], "gid": np.full(len(row), gid), "tree": np.full(len(row), t, np.int32), "slot": leaf.astype(np.int32)})

    made = rows.select("cid", "gid", "vec", "levels", "bands").mapInPandas(leaves, "cid long, gid long, tree int, slot int")
    return made.select("cid", F.xxhash64("gid", "tree", "slot").alias("leaf"))


def _split(rows: DataFrame, vectors: DataFrame, groups: DataFrame, total: int, trees: int, bar: float, spill: float) -> tuple[DataFrame, DataFrame]:
    """Split the groups ``(gid, members)`` of ``rows`` (``cid, gid``); gives new ``(cid, leaf)`` and the dense groups."""
    steps = 1 << 30
    place = F.pmod(F.xxhash64(F.lit(SEED), "cid"), F.lit(steps))
    near = hot_join(rows, groups.withColumn("rows", F.col("members")), ["gid"], "rows", total).withColumn("place", place)
    near = near.where(F.col("place") < F.lit(3.0 * steps * SAMPLE) / F.col("members"))
    fits = written(_fits(near.join(vectors, "cid").select("gid", "cid", "vec", "place", "members"), trees, bar, spill), "forest-fits")
    cuts = fits.where("NOT dense").drop("dense").join(groups, "gid")
    members = hot_join(rows, cuts, ["gid"], "members", total)
    return _assigned(members.join(vectors, "cid"), trees), fits.where("dense").select("gid")


def forest(vectors: DataFrame, bar: float = LEAST_COSINE, trees: int = TREES, spill: float = SPILL) -> DataFrame:
    """``(cid, leaf, dense)``: the leaves of all classes ``vectors`` (``cid, gid, vec``)."""
    sizes = written(vectors.groupBy("gid").agg(F.count(F.lit(1)).alias("members")), "forest-groups")
    total = vectors.count()
    rows = vectors.select("cid", "gid")
    small = rows.join(sizes.where(F.col("members") <= MAX_LEAF), "gid").select("cid", F.col("gid").alias("leaf"))
    large = sizes.where(F.col("members") > MAX_LEAF)
    done = small.withColumn("dense", F.lit(False))
    if large.isEmpty():
        return done
    opened, _ = _split(rows, vectors.select("cid", "vec"), large, total, trees, bar, spill)
    opened = written(opened, "forest-leaves")
    for _ in range(ROUNDS):
        sizes = opened.groupBy("leaf").agg(F.count(F.lit(1)).alias("members"))
        large = written(sizes.where(F.col("members") > MAX_LEAF).withColumnRenamed("leaf", "gid"), "forest-large")
        if large.isEmpty():
            break
        count = opened.count()
        full = large.select(F.col("gid").alias("leaf"), "members")
        closed = opened.join(full, "leaf", "left_anti")
        more, dense = _split(opened.withColumnRenamed("leaf", "gid"), vectors.select("cid", "vec"), large, count, 1, bar, spill)
        kept = hot_join(opened, full.join(dense.withColumnRenamed("gid", "leaf"), "leaf"), ["leaf"], "members", count)
        done = done.unionByName(closed.withColumn("dense", F.lit(False))).unionByName(kept.select("cid", "leaf", F.lit(True).alias("dense")))
        opened = written(more, "forest-leaves")
    # Whatever is still too large is compared block by block as well.
    sizes = opened.groupBy("leaf").agg(F.count(F.lit(1)).alias("members"))
    rest = opened.join(sizes, "leaf")
    return done.unionByName(rest.select("cid", "leaf", (F.col("members") > MAX_LEAF).alias("dense")))


def _leaf_links(bar: float):
    """Link counts and spanning links of one leaf, or of one pair of its blocks."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("cid")
        vectors = _vectors(rows["vec"])
        cid, copies, side = (rows[c].to_numpy() for c in ("cid", "copies", "side"))
        norm = np.linalg.norm(vectors, axis=1)
        good = (vectors @ vectors.T) / (norm[:, None] * norm[None, :]) >= bar
        np.fill_diagonal(good, False)
        if side.any():  # two different blocks: only across
            good &= side[:, None] != side[None, :]
        at = np.flatnonzero(good.any(axis=1))
        if not len(at):
            return pd.DataFrame({"cid": cid[:0], "links": copies[:0], "root": cid[:0]})
        good, cid, copies = good[np.ix_(at, at)], cid[at], copies[at]
        # A pair counts in the first leaf that both are in; ``leaves`` has those before this one.
        own = int(rows["leaf"].iat[0])
        lists = [np.frombuffer(b, np.int64) for b in rows["leaves"].iloc[at]]
        flat = np.concatenate(lists)
        row = np.repeat(np.arange(len(at)), [len(x) for x in lists])
        early = flat < own
        names, column = np.unique(flat[early], return_inverse=True)
        counted = good
        if len(names):
            together = np.zeros((len(at), len(names)), np.float32)
            together[row[early], column] = 1
            counted = good & ~(together @ together.T > 0)
        root = np.arange(len(at))
        while True:  # least position reachable
            least = np.minimum(root, np.where(good, root[None, :], len(at)).min(axis=1))
            least = least[least]
            if (least == root).all():
                break
            root = least
        return pd.DataFrame({"cid": cid, "links": counted @ copies.astype(np.int64), "root": cid[root]})

    return links


def near_duplicates(
    table: DataFrame, bar: float = LEAST_COSINE, trees: int = TREES, spill: float = SPILL, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Vectors link when their labels are equal and not null, their dimensions are
    equal and their cosine is at least ``bar``.  Null, empty and zero vectors
    and those with null, infinite or undefined components link with nothing and
    stand alone.  Equal rows link with each other; rows that repeat an id are
    counted each.  Rows with a null id link like others but name no component
    and are not kept.  Other columns are ignored; an empty table stays empty.
    """
    doubles = F.transform(vector, lambda x: x.cast("double"))
    sound = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.col(label).isNotNull()
    sound &= F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(doubles, lambda x: x != 0)
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.coalesce(sound, F.lit(False)).alias("sound"), doubles.alias("v"), F.col(label).cast("string").alias("label"))
    gid = F.xxhash64("label", F.size("v"))
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # minus zero equals zero
    rows = rows.select("vec_id", "sound", gid.alias("gid"), F.xxhash64("label", plain).alias("cid"), F.xxhash64(F.lit(1), "label", plain).alias("check"), plain.alias("v"))
    rows = written(rows, "vectors")

    def pack(batches):
        for batch in batches:
            data = [np.asarray(v, np.float64).tobytes() for v in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(data, pa.binary())], ["cid", "gid", "least", "copies", "vec"])

    classes = rows.where("sound").groupBy("cid", "check").agg(
        F.first("gid").alias("gid"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")
    )
    packed = classes.select("cid", "gid", "least", "copies", "v").mapInArrow(pack, "cid long, gid long, least long, copies long, vec binary")
    classes = written(packed, "vector-classes")
    leaves = written(forest(classes.select("cid", "gid", "vec"), bar, trees, spill), "forest")

    def listed(batches):
        for batch in batches:
            data = [np.asarray(v, np.int64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["cid", "leaves"])

    lists = leaves.groupBy("cid").agg(F.collect_set("leaf").alias("leaves")).mapInArrow(listed, "cid long, leaves binary")
    sizes = leaves.where("dense").groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("members"))
    dense = hot_join(leaves.where("dense"), sizes, ["leaf"], "members", classes.count()).select("cid", "leaf", "blocks")
    placed = leaves.where("NOT dense").select("cid", "leaf", F.lit(1).alias("blocks")).unionByName(dense)
    placed = placed.withColumn("own", F.pmod(F.xxhash64(F.lit(2), "cid"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("cid", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    full = placed.join(classes.select("cid", "vec", "copies").join(lists, "cid"), "cid")
    found = written(full.groupBy("leaf", "i", "j").applyInPandas(_leaf_links(bar), "cid long, links long, root long"), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = written(components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))), "vector-components")
    total = rows.count()
    named = comps.withColumnRenamed("node", "cid").join(classes.select("cid", "least", "copies"), "cid")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("copies").alias("rows"))
    of_class = hot_join(comps.withColumnRenamed("node", "cid"), least, ["component"], "rows", total).select("cid", "component_id")
    answer = (
        classes.join(links, "cid", "left")
        .join(of_class, "cid", "left")
        .select(
            "cid",
            "copies",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    with_links = hot_join(rows.where("sound").select("vec_id", "cid"), answer, ["cid"], "copies", total)
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return with_links.select("vec_id", "n_links", "component_id").unionByName(alone).select("vec_id", "n_links", "component_id", kept)
