"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are scaled to unit length, so the largest cosine is the least distance.
A Gaussian is stable: projected on ``DIMS`` of them, the squared distance of two
vectors at distance d is d^2 times a chi-square variable of ``DIMS`` degrees.  So
when the neighbours of a query are taken in the order of their projected
distance and have come to r, a vector nearer than the k-th best found, at d, has
been missed with a probability of at most 1 - F(r^2 / d^2), F being that
distribution.  The search stops when F reaches ``CONFIDENCE``.

* **Copies.**  Equal vectors are one class with its ``K + 1`` smallest ids; more of
  them can't be an answer.  The ids are cut map-side, before any shuffle, and
  the queries of a class are answered once.
* **Tree.**  Its upper levels are fitted on the projections of a sample of about
  ``SAMPLE`` classes and split the space into cells of about ``CELL``; every class
  goes to its cell.  The lower levels are built in the cells, down to leaves of
  ``LEAF``, and stored with bounding boxes, one row of packed arrays per cell.  A
  cell that came out large is several such blocks, each with a tree of its own.
* **Search.**  Queries move in packs of up to about ``PACK`` of one cell.  Each
  first meets the blocks of its own cell, then, as the distance found bounds the
  projected distance at which it will stop, only the cells that come nearer than
  that.  Within a block, leaves come in the order of their boxes' distance until
  the test holds; what a leaf has within that distance is verified by its cosine.

Nothing is broadcast but the upper tree, whose size the sample bounds, and the
hot keys of ``hot_join``.  A task holds some packs and blocks of bounded size.
How much the test saves depends on the data: among vectors in all directions the
fifth neighbour is hardly nearer than the rest, and most cells are visited.

Vectors of different dimension are never compared.  Null and empty vectors, zero
vectors and those with null or non-finite components take no part, nor do rows
with a null id.  A repeated row counts once; rows of one id with different vectors
are rows each, and each of them is answered.  Components may be of any size.
Equal scores go to the smaller id.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.llm.tables import hot_join, written

K = 5
#: Projections; an even number, for which the distribution has a closed form.
DIMS = 10
CONFIDENCE = 0.95
SAMPLE = 1 << 15
#: Sampled classes that a cell of the upper tree has at least, about.
_SAMPLED = 8
CELL = 4096
LEAF = 256
PACK = 256

_STEPS = 1 << 30
#: Rounding of a squared distance of unit vectors; what lies this near counts as equally near.
_SLACK = 1e-9
_PACK_DDL = "dim int, home int, pack long, cell int, members binary, keys binary, counts binary, units binary, places binary, limits binary"
_BLOCK_DDL = "dim int, cell int, block long, keys binary, ids binary, units binary, places binary, starts binary, boxes binary"
_FOUND_DDL = "dim int, home int, pack long, members binary, scores binary, found_keys binary, found_ids binary"


def chi_square(x: float, dims: int = DIMS) -> float:
    """Distribution function of the chi-square variable with an even number of degrees."""
    half = x / 2
    return 1.0 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(dims // 2))


@lru_cache
def reach(confidence: float, dims: int) -> float:
    """The ratio r^2 / d^2 from which on the stopping test holds."""
    low, high = 0.0, 1.0
    while chi_square(high, dims) < confidence:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < confidence else (low, mid)
    return high


@lru_cache(maxsize=8)
def _directions(dim: int, dims: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, dims))


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of unit length; the largest component is scaled to 1 first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


# --- trees -----------------------------------------------------------------------------------------------------------


class Tree:
    """The upper levels over one dimension's space: splits in heap order, and the boxes of the cells."""

    def __init__(self, places: np.ndarray, depth: int):
        self.depth = depth
        inner = (1 << depth) - 1
        self.axis, self.value = np.zeros(inner, np.int32), np.full(inner, np.inf)
        dims = places.shape[1]
        self.low, self.high = np.full((1 << depth, dims), -np.inf), np.full((1 << depth, dims), np.inf)
        parts = {0: (places, self.low[0].copy(), self.high[0].copy())}
        for node in range(inner):
            rows, low, high = parts.pop(node)
            axis = int(np.argmax(rows.max(axis=0) - rows.min(axis=0))) if len(rows) else 0
            cut = float(np.median(rows[:, axis])) if len(rows) else np.inf
            self.axis[node], self.value[node] = axis, cut
            left = rows[:, axis] <= cut
            below, above = high.copy(), low.copy()
            below[axis], above[axis] = min(high[axis], cut), max(low[axis], cut)
            parts[2 * node + 1], parts[2 * node + 2] = (rows[left], low, below), (rows[~left], above, high)
        for node, (_, low, high) in parts.items():
            self.low[node - inner], self.high[node - inner] = low, high

    def cells(self, places: np.ndarray) -> np.ndarray:
        node = np.zeros(len(places), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (places[np.arange(len(places)), self.axis[node]] > self.value[node])
        return (node - ((1 << self.depth) - 1)).astype(np.int32)


def _box_distance(places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances, ``places x boxes``."""
    gap = np.maximum(np.maximum(low - places[:, None], places[:, None] - high), 0)
    return np.einsum("qbd,qbd->qb", gap, gap)


def _leaves(places: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of the leaves of a kd-tree: halves along the widest axis until they are small enough."""
    done, todo = [], [np.arange(len(places))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        here = places[rows]
        order = np.argpartition(here[:, int(np.argmax(np.ptp(here, axis=0)))], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done


# --- blocks, packs and their search ----------------------------------------------------------------------------------


def _bytes(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _pad(ids: pa.Array, width: int) -> np.ndarray:
    """Id lists as rows of equal length; the last id is repeated."""
    start, flat = np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(start)[:-1]])
    return flat[first[:, None] + np.minimum(np.arange(width), start[:, None] - 1)]


def _block(group: pa.Table, k: int, leaf: int) -> pa.Table:
    """One row with the packed arrays of a block, in the order of its leaves."""
    group = group.combine_chunks()
    dim, cell, block = (group[c][0].as_py() for c in ("dim", "cell", "block"))
    n = len(group)
    places = _matrix(group["place"].chunk(0), len(group["place"][0]))
    leaves = _leaves(places, leaf)
    order = np.concatenate(leaves)
    places = places[order]
    starts = np.concatenate([[0], np.cumsum([len(rows) for rows in leaves])]).astype(np.int32)
    spans = list(zip(starts[:-1], starts[1:], strict=True))
    boxes = np.stack([np.stack([places[a:b].min(axis=0), places[a:b].max(axis=0)]) for a, b in spans])
    keys = np.stack([group["h1"].to_numpy(), group["h2"].to_numpy()], axis=1)[order]
    units = _units(_matrix(group["v"].chunk(0), dim))[order]
    ids = _pad(group["ids"].chunk(0), k + 1)[order]
    assert len(order) == n
    packed = [keys, ids, units, places, starts, boxes]
    return pa.table([[dim], [cell], [block], *[[_bytes(x)] for x in packed]], schema=_arrow(_BLOCK_DDL))


def _pack(group: pa.Table) -> pa.Table:
    """One row with the packed arrays of some queries of one cell."""
    group = group.combine_chunks()
    dim, cell, pack = (group[c][0].as_py() for c in ("dim", "cell", "block"))
    n = len(group)
    keys = np.stack([group["h1"].to_numpy(), group["h2"].to_numpy()], axis=1)
    packed = [
        np.arange(n, dtype=np.int32),
        keys,
        group["asked"].to_numpy(),
        _units(_matrix(group["v"].chunk(0), dim)),
        _matrix(group["place"].chunk(0), len(group["place"][0])),
        np.full(n, np.inf),
    ]
    return pa.table([[dim], [cell], [pack], [cell], *[[_bytes(x)] for x in packed]], schema=_arrow(_PACK_DDL))


@lru_cache
def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


class _Best:
    """The nearest classes of some queries so far: scores, keys and ids, best first; ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.keys = np.zeros((n, k, 2), np.int64)
        self.ids = np.full((n, k, k), np.iinfo(np.int64).max)

    def merge(self, rows: np.ndarray, scores: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
        """Take in ``scores`` (``rows x found``) of classes; ``keys`` and ``ids`` are per row and class."""
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        keys = np.concatenate([self.keys[rows], keys], axis=1)
        ids = np.concatenate([self.ids[rows], ids], axis=1)
        best = np.lexsort((ids[:, :, 0], -scores), axis=1)[:, : self.k]
        at = np.arange(len(rows))[:, None]
        self.scores[rows], self.keys[rows], self.ids[rows] = scores[at, best], keys[at, best], ids[at, best]

    def distances(self) -> np.ndarray:
        """Squared distance of the last of them; infinite while there are fewer."""
        return np.where(np.isfinite(self.scores[:, -1]), 2 - 2 * self.scores[:, -1], np.inf)


def _search(pack: dict, block: dict, dims: int, k: int, ratio: float) -> _Best:
    """Nearest classes of a block for each query of a pack, by leaves in the order of their projected distance."""
    units, places, limits = pack["units"], pack["places"], pack["limits"].copy()
    starts, boxes = block["starts"], block["boxes"]
    best = _Best(len(places), k)
    distance = _box_distance(places, boxes[:, 0], boxes[:, 1])
    order = np.argsort(distance, axis=1)
    everyone = np.arange(len(places))
    for step in range(len(boxes)):
        leaf = order[:, step]
        active = distance[everyone, leaf] <= (limits + _SLACK) * ratio
        if not active.any():
            break  # the test holds for all: no leaf left comes near enough
        for one in np.unique(leaf[active]):
            rows = np.flatnonzero(active & (leaf == one))
            span = slice(starts[one], starts[one + 1])
            gap = places[rows][:, None] - block["places"][span][None]
            near = np.einsum("qpd,qpd->qp", gap, gap) <= ((limits[rows] + _SLACK) * ratio)[:, None]
            some = np.flatnonzero(near.any(axis=0))
            if not len(some):
                continue
            at = some + span.start
            scores = np.where(near[:, some], units[rows] @ block["units"][at].T, -np.inf)
            top = min(k, len(some))
            if len(some) > 4 * k:  # the k best scores and all that equal the last of them
                least = np.partition(scores, -top, axis=1)[:, -top]
                keep = np.flatnonzero((scores >= np.maximum(least, best.scores[rows, -1])[:, None]).any(axis=0))
                at, scores = at[keep], scores[:, keep]
            if len(at):
                shape = (len(rows), len(at))
                best.merge(rows, scores, np.broadcast_to(block["keys"][at], (*shape, 2)), np.broadcast_to(block["ids"][at], (*shape, k)))
                limits[rows] = np.minimum(limits[rows], best.distances()[rows])
    return best


def _unpack(row: dict, dims: int, k: int, block: bool) -> dict:
    dim = row["dim"]
    kinds = {"keys": (np.int64, (-1, 2)), "units": (np.float64, (-1, dim)), "places": (np.float64, (-1, dims))}
    if block:
        kinds |= {"ids": (np.int64, (-1, k)), "starts": (np.int32, (-1,)), "boxes": (np.float64, (-1, 2, dims))}
    else:
        kinds |= {"members": (np.int32, (-1,)), "counts": (np.int64, (-1,)), "limits": (np.float64, (-1,))}
    return row | {c: np.frombuffer(row[c], kind).reshape(shape) for c, (kind, shape) in kinds.items()}


def _found(row: dict, members: np.ndarray, best: _Best) -> tuple:
    return row["dim"], row["home"], row["pack"], *map(_bytes, (members, best.scores, best.keys, best.ids))


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _arrow(ddl), strict=True)], schema=_arrow(ddl))


def _best_of(row: dict, k: int) -> tuple[np.ndarray, _Best]:
    members = np.frombuffer(row["members"], np.int32)
    best = _Best(len(members), k)
    best.scores = np.frombuffer(row["scores"]).reshape(-1, k).copy()
    best.keys = np.frombuffer(row["found_keys"], np.int64).reshape(-1, k, 2).copy()
    best.ids = np.frombuffer(row["found_ids"], np.int64).reshape(-1, k, k).copy()
    return members, best


def _merged(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[dict, _Best]]:
    """Each pack's best, from rows that come pack by pack."""
    now = None
    for batch in batches:
        for row in batch.to_pylist():
            members, best = _best_of(row, k)
            name = (row["dim"], row["home"], row["pack"])
            if now and now[0] == name:
                now[2].merge(members, best.scores, best.keys, best.ids)
                continue
            if now:
                yield now[1], now[2]
            now = (name, row, best)  # the first row of a pack holds all of its queries
    if now:
        yield now[1], now[2]


# --- the operator ----------------------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, one at least not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """Classes of equal vectors, dealt out to the cells of a tree and packed into blocks with trees of their own."""

    def __init__(self, vectors: DataFrame, k: int = K, dims: int = DIMS, cell: int = CELL, leaf: int = LEAF, sample: int = SAMPLE):
        """``vectors`` has ``vec_id`` and ``embedding``."""
        if dims % 2 or dims < 2:
            raise ValueError("the number of projections must be even")
        self.k, self.dims, self.cell = k, dims, cell
        rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        rows = rows.select(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("nearest"), "v").alias("h2"), "vec_id", "v")
        self.ids = written(rows.select("h1", "h2", "vec_id").distinct(), "nearest-ids")
        rank = F.row_number().over(W.partitionBy("h1", "h2").orderBy("vec_id"))
        least = self.ids.withColumn("rank", rank).where(F.col("rank") <= k + 1)
        least = least.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        classes = rows.groupBy("h1", "h2").agg(F.first("v").alias("v")).join(least, ["h1", "h2"])
        classes = classes.select("h1", "h2", "ids", "v", F.size("v").alias("dim")).mapInArrow(
            _project(dims), "h1 long, h2 long, ids array<long>, v array<double>, dim int, place array<double>"
        )
        classes = written(classes, "nearest-classes")
        self.size = classes.count()
        self.trees = self._fit(classes, sample)
        self.classes = written(classes.mapInArrow(_assign(self.trees), classes.schema.simpleString()[7:-1] + ", cell int"), "nearest-cells")
        build = lambda group: _block(group, k, leaf)
        self.blocks = written(_grouped(self.classes, cell, self.size).groupBy("dim", "cell", "block").applyInArrow(build, _BLOCK_DDL), "nearest-blocks")

    def _fit(self, classes: DataFrame, sample: int) -> dict[int, Tree]:
        """The upper trees, by dimension, fitted on about ``sample`` classes in all."""
        share = min(1.0, sample / max(self.size, 1))
        chosen = classes.where(F.pmod(F.xxhash64(F.lit("fit"), "h1", "h2"), F.lit(_STEPS)) < F.lit(share * _STEPS))
        places: dict[int, list] = {}
        for row in chosen.select("dim", "place").collect():  # ``sample`` rows of ``dims`` numbers, about
            places.setdefault(row["dim"], []).append(row["place"])
        trees = {}
        for dim, found in places.items():
            cells = min(len(found) / share / self.cell, len(found) / _SAMPLED)
            trees[dim] = Tree(np.array(found), max(0, math.ceil(math.log2(cells)) if cells > 1 else 0))
        return trees

    def nearest(self, queries: DataFrame, confidence: float = CONFIDENCE, pack: int = PACK) -> DataFrame:
        """``(query_id, rank, vec_id, score)`` of the ``k`` nearest others of each row of the index whose id is in ``queries``.

        ``queries`` has a column ``vec_id``.  Each row's own place is left out;
        other rows of its id with another vector are not.
        """
        k, width = self.k, self.k + 1
        asked = self.ids.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
        each = written(asked.select("h1", "h2", F.col("vec_id").alias("query_id")), "nearest-queries")
        counted = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("asked"))
        packs = self.classes.drop("ids").join(counted, ["h1", "h2"])
        packs = written(_grouped(packs, pack, self.size).groupBy("dim", "cell", "block").applyInArrow(_pack, _PACK_DDL), "nearest-packs")

        trees = packs.sparkSession.sparkContext.broadcast(self.trees)
        find = _finder(self.dims, width, reach(confidence, self.dims))
        name = ["dim", "home", "pack"]
        first = packs.join(self.blocks.withColumnsRenamed({"keys": "b_keys", "units": "b_units", "places": "b_places"}), ["dim", "cell"])
        first = written(first.mapInArrow(find, _FOUND_DDL), "nearest-first")
        first = written(first.repartition(*name).sortWithinPartitions(*name).mapInArrow(_merger(width), _FOUND_DDL), "nearest-home")

        # The best of the own cell bounds how far each query has to look; it goes to the cells that come that near.
        bounded = packs.join(first.select(*name, "scores"), name)
        routed = bounded.mapInArrow(_router(trees, self.dims, width, reach(confidence, self.dims)), _PACK_DDL)
        more = written(routed, "nearest-routes").join(
            self.blocks.withColumnsRenamed({"keys": "b_keys", "units": "b_units", "places": "b_places"}), ["dim", "cell"]
        )
        more = more.mapInArrow(find, _FOUND_DDL)
        whole = first.withColumn("late", F.lit(0)).unionByName(more.withColumn("late", F.lit(1)))
        whole = whole.repartition(*name).sortWithinPartitions(*name, "late").drop("late")
        whole = whole.mapInArrow(_merger(width), _FOUND_DDL).join(packs.select(*name, "keys", "counts"), name)
        answers = whole.mapInArrow(_answers(width), "h1 long, h2 long, asked long, found array<struct<score: double, own: boolean, ids: array<long>>>")
        answers = written(answers, "nearest-answers")

        total = each.count()
        told = hot_join(each, answers, ["h1", "h2"], "asked", total)
        one = F.flatten(F.transform("found", _candidates))
        others = F.slice(F.array_sort(F.filter(one, lambda c: ~(c["own"] & (c["vec_id"] == F.col("query_id"))))), 1, k)
        told = told.select("query_id", F.posexplode(others).alias("at", "c"))
        return told.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))


def _candidates(c: Column) -> Column:
    """The ids of a class as candidates that sort by score, best first, and id."""
    return F.transform(c["ids"], lambda i: F.struct((-c["score"]).alias("order"), i.alias("vec_id"), c["score"].alias("score"), c["own"].alias("own")))


def _grouped(rows: DataFrame, size: int, total: int) -> DataFrame:
    """``rows`` with a ``block`` that splits each cell by hash into blocks of about ``size``; hot cells stay where they are."""
    cells = rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.withColumn("_blocks", F.ceil(F.col("_n") / F.lit(size)).cast("long"))
    joined = hot_join(rows, cells, ["dim", "cell"], "_n", total)
    return joined.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "h1", "h2"), F.col("_blocks"))).drop("_blocks")


def _project(dims: int):
    def project(batches):
        for batch in batches:
            dim = batch.column(4).to_numpy()
            places = np.zeros((len(dim), dims))
            for d in np.unique(dim):
                rows = np.flatnonzero(dim == d)
                places[rows] = _units(_matrix(batch.column(3).take(pa.array(rows)), int(d))) @ _directions(int(d), dims)
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, places.size + 1, dims, dtype=np.int32)), pa.array(places.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "place"])

    return project


def _assign(trees: dict[int, Tree]):
    def assign(batches):
        for batch in batches:
            dim = batch.column(4).to_numpy()
            places = _matrix(batch.column(5), len(batch.column(5)[0]) if len(dim) else 1)
            cells = np.zeros(len(dim), np.int32)
            for d in np.unique(dim):
                if d in trees:
                    cells[dim == d] = trees[d].cells(places[dim == d])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    return assign


def _finder(dims: int, width: int, ratio: float):
    """Search of rows that hold a pack and a block each."""

    def find(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = _unpack({"dim": row["dim"], "keys": row["b_keys"], "ids": row["ids"], "units": row["b_units"], "places": row["b_places"], "starts": row["starts"], "boxes": row["boxes"]}, dims, width, True)
                pack = _unpack(row, dims, width, False)
                yield _rows([_found(row, pack["members"], _search(pack, block, dims, width, ratio))], _FOUND_DDL)

    return find


def _merger(width: int):
    def merge(batches):
        for row, best in _merged(batches, width):
            yield _rows([_found(row, np.arange(len(best.scores), dtype=np.int32), best)], _FOUND_DDL)

    return merge


def _router(trees, dims: int, width: int, ratio: float):
    """For each pack and other cell that comes near enough, the queries that have to look there."""

    def route(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tree = trees.value.get(row["dim"])
                if tree is None or tree.depth == 0:
                    continue
                pack = _unpack(row, dims, width, False)
                last = np.frombuffer(row["scores"]).reshape(-1, width)[:, -1]
                limits = np.where(np.isfinite(last), 2 - 2 * last, np.inf)
                distance = _box_distance(pack["places"], tree.low, tree.high)
                goes = distance <= ((limits + _SLACK) * ratio)[:, None]
                goes[:, row["home"]] = False
                for cell in np.flatnonzero(goes.any(axis=0)):
                    who = np.flatnonzero(goes[:, cell])
                    packed = [who.astype(np.int32), pack["keys"][who], pack["counts"][who], pack["units"][who], pack["places"][who], limits[who]]
                    yield _rows([(row["dim"], row["home"], row["pack"], int(cell), *map(_bytes, packed))], _PACK_DDL)

    return route


def _answers(width: int):
    """One row per query class with its nearest classes."""

    def answers(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.int64).reshape(-1, 2)
                _, best = _best_of(row, width)
                own = (best.keys == keys[:, None]).all(axis=2)
                found = []
                for q in range(len(keys)):
                    ranks = np.flatnonzero(np.isfinite(best.scores[q]))
                    found.append([{"score": best.scores[q, r], "own": bool(own[q, r]), "ids": list(dict.fromkeys(best.ids[q, r].tolist()))} for r in ranks])
                kind = pa.list_(pa.struct([("score", pa.float64()), ("own", pa.bool_()), ("ids", pa.list_(pa.int64()))]))
                columns = [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.frombuffer(row["counts"], np.int64)), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "asked", "found"])

    return answers


def search(vectors: DataFrame, every: int = 50, **options) -> DataFrame:
    """The nearest others of each vector whose id ``every`` divides."""
    return Index(vectors, **options).nearest(vectors.where(F.col("vec_id") % every == 0).select("vec_id"))
