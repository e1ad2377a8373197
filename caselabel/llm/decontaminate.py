"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and marks of any script, with A-Z folded, so
punctuation, blanks and line breaks of any kind make no difference.  In scripts
written without blanks every character is a word.  Every run of ``seed`` words of a benchmark item is a
seed.  A document that shares seeds with an item is tiled against it: the
longest common run of unmarked words is found by Karp-Rabin window hashes with a
binary search on the length, its words are marked on both sides, and so on until
no common run of ``seed`` words is left.  Tiles are found wherever they stand,
so passages with their parts reordered are covered like others.  A document is
contaminated by an item when the tiles cover enough of the item's words.

An item of fewer than ``seed`` words is too common a phrase to be told from
chance inside a sentence.  It is found where it stands alone, as all words of a
document or of one of its lines, and then covered whole.

The benchmark is the stated query set: it is held against all documents in
blocks of bounded size, one pass over the documents for each block.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselabel.llm import chars
from caselabel.llm import words as wd
from caselabel.llm.tables import written

SEED_WORDS = 5
COVERAGE = 0.5
#: Bytes of benchmark text that are broadcast at once.
BLOCK_BYTES = 16 << 20

#: Scripts written without blanks between words: Thai and Lao, Tibetan, Burmese, Khmer, Tai, Kana, Bopomofo, Yi, Han.
_NO_BLANKS = [
    *((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3040, 0x312F)),
    *((0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF)),
    *((0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)),
]
_BASE = np.uint64(0xD1342543DE82EF95)


@functools.cache
def _kinds() -> np.ndarray:
    """0 at code points between words, 1 at those in words, 2 at those that are words."""
    table = np.zeros(chars.POINTS, np.uint8)
    table[[c for c in range(chars.POINTS) if unicodedata.category(chr(c))[0] in "LNM"]] = 1
    for low, high in _NO_BLANKS:
        table[low : high + 1] *= 2
    return table


def _words(data: np.ndarray, offsets: np.ndarray) -> wd.Words:
    """Words of each text of UTF-8 bytes; see the module for what a word is."""
    low, high = int(offsets[0]), int(offsets[-1])
    raw = wd.fold_ascii(data[low:high])
    n = len(raw)
    kind = np.where(raw < 128, _kinds()[:256][raw], 0)
    lead = np.flatnonzero(raw >= 0xC0)  # bytes over 127 that begin a character
    if len(lead):
        size = 2 + (raw[lead] >= 0xE0).astype(np.int64) + (raw[lead] >= 0xF0)
        point = raw[lead].astype(np.int64) & (0x7F >> size)
        for j in range(1, 4):
            more = size > j
            point[more] = point[more] << 6 | raw[lead[more] + j] & 0x3F
        own = _kinds()[point]
        for j in range(4):
            kind[lead[size > j] + j] = own[size > j]
    first = (raw & 0xC0) != 0x80
    edge = np.zeros(n + 1, bool)
    edge[offsets - low] = True  # a word never crosses from one text into the next
    before = np.concatenate([np.zeros(1, np.uint8), kind])[:n]
    begins = (kind > 0) & first & ((before == 0) | (kind == 2) | (before == 2) | edge[:n])
    ends = np.zeros(n + 1, bool)
    ends[1:] = kind > 0
    ends[:n] &= (kind == 0) | begins
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return wd.Words(start + low, end + low, wd.span_hashes(raw, start, end), np.searchsorted(start, offsets - low))


def _whole(found: wd.Words, first: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Which word ranges ``first[i] to first[i + 1]`` have fewer than ``seed`` words, but some, and the hashes of those."""
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < seed))
    count, at = count[short], first[:-1][short]
    out = count.astype(np.uint64)
    for j in range(seed - 1):
        more = count > j
        out[more] = out[more] * _BASE + found.hash[at[more] + j]
    return short, wd.mix(out)


@dataclass(frozen=True)
class Block:
    """Part of the benchmark: word hashes by item, all seeds in order with their items, and the same of whole short items."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    short: np.ndarray
    short_item: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str], seed: int) -> Block:
        data, offsets = wd.buffers(pa.array(texts, pa.string()))
        found = _words(data, offsets)
        hashes, first = wd.shingles(found, seed)
        item = np.repeat(np.arange(len(ids)), np.diff(first))
        place = np.arange(len(hashes)) - first[item] if len(hashes) else np.zeros(0, np.int64)
        long_enough = np.diff(found.first)[item] >= seed
        hashes, item, place = hashes[long_enough], item[long_enough], place[long_enough]
        order = np.argsort(hashes, kind="stable")
        short_item, short = _whole(found, found.first, seed)
        by_hash = np.argsort(short, kind="stable")
        return Block(ids, found.hash, found.first, hashes[order], item[order], place[order], short[by_hash], short_item[by_hash])


def _windows(values: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``length`` values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, step, power, done = np.zeros(n, np.uint64), values, np.array([_BASE]), 0
    # Doubling: ``step`` has the hashes of windows of 1, 2, 4 ... values, joined as the bits of the length say.
    size, left = 1, length
    while left:
        if left & 1:
            out = out * power + step[done : done + n]
            done += size
        left >>= 1
        if left:
            step = step[: len(step) - size] * power + step[size:]
            power, size = power * power, 2 * size
    return out


def tile(text: np.ndarray, item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word hash sequences: ``(place in text, place in item, words)``, longest first.

    Of tiles of equal length the first in the item, then the first in the text is taken.
    """
    text, item = text.copy(), item.copy()
    fresh = np.random.default_rng(0)
    tiles, longest = [], min(len(text), len(item))
    while True:
        low, high, hit = seed - 1, longest, None
        while low < high:  # a common run of n words has one of n - 1 words in it
            length = (low + high + 1) // 2
            here, there = _windows(item, length), _windows(text, length)
            at = np.flatnonzero(np.isin(here, there))
            if len(at):
                low, hit = length, (int(at[0]), int(np.flatnonzero(there == here[at[0]])[0]))
            else:
                high = length - 1
        if hit is None:
            return tiles
        longest, (j, i) = low, hit
        tiles.append((i, j, low))
        # Marked words are replaced by values that occur nowhere else.
        text[i : i + low] = fresh.integers(0, 1 << 64, low, dtype=np.uint64)
        item[j : j + low] = fresh.integers(0, 1 << 64, low, dtype=np.uint64)


def _runs(places: np.ndarray, words: int, length: int) -> np.ndarray:
    """Word positions covered by seeds at ``places``."""
    mark = np.zeros(length + 1, np.int64)
    np.add.at(mark, places, 1)
    np.add.at(mark, np.minimum(places + words, length), -1)
    return np.flatnonzero(np.cumsum(mark[:-1]) > 0)


def _alone(data: np.ndarray, offsets: np.ndarray, found: wd.Words, block: Block, seed: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Matches of short items with all words of a text or of one of its lines, each row and item once."""
    low, high = int(offsets[0]), int(offsets[-1])
    lines = np.unique(np.concatenate([offsets, np.flatnonzero((data[low:high] == 10) | (data[low:high] == 13)) + low]))
    pairs = set()
    for bounds in (offsets, lines):
        which, hashes = _whole(found, np.searchsorted(found.start, bounds), seed)
        left, right = (np.searchsorted(block.short, hashes, side=s) for s in ("left", "right"))
        hit = np.flatnonzero(right > left)
        rows = np.searchsorted(offsets, bounds[which[hit]], side="right") - 1
        pairs |= {(int(r), int(i)) for r, h in zip(rows, hit, strict=True) for i in block.short_item[left[h] : right[h]]}
    for row, item in sorted(pairs):
        n = int(block.first[item + 1] - block.first[item])
        yield row, item, 1, n, n


def _matches(column: pa.Array, block: Block, seed: int, coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
    """``(row, item, tiles, matched words, item words)`` of every row and item with enough coverage."""
    data, offsets = wd.buffers(column)
    for a, b in wd.slices(offsets):
        found = _words(data, offsets[a : b + 1])
        if len(block.short):
            yield from ((a + r, *x) for r, *x in _alone(data, offsets[a : b + 1], found, block, seed))
        hashes, first = wd.shingles(found, seed)
        if not len(hashes) or not len(block.seeds):
            continue
        low = np.searchsorted(block.seeds, hashes, side="left")
        at = np.flatnonzero(block.seeds[np.minimum(low, len(block.seeds) - 1)] == hashes)
        if not len(at):
            continue
        row = np.searchsorted(first, at, side="right") - 1
        for r in np.unique(row):
            mine = at[row == r]
            yield from ((a + int(r), *x) for x in _tiled(found, int(r), mine - first[r], hashes[mine], block, seed, coverage))


def _tiled(found: wd.Words, row: int, places: np.ndarray, hashes: np.ndarray, block: Block, seed: int, coverage: float):
    text = found.hash[found.first[row] : found.first[row + 1]]
    if len(text) < seed:
        return
    values, back = np.unique(hashes, return_inverse=True)
    low, high = (np.searchsorted(block.seeds, values, side=s) for s in ("left", "right"))
    owners = np.concatenate([np.arange(x, y) for x, y in zip(low, high, strict=True)])
    value = np.repeat(np.arange(len(values)), high - low)
    for item in np.unique(block.item[owners]):
        mine = block.item[owners] == item
        whole = block.words[block.first[item] : block.first[item + 1]]
        # Tiles can't cover more than the shared seeds do.
        if len(_runs(block.place[owners[mine]], seed, len(whole))) < coverage * len(whole):
            continue
        shared = np.zeros(len(values), bool)
        shared[value[mine]] = True
        inside = _runs(places[shared[back]], seed, len(text))
        gaps = np.flatnonzero(np.diff(inside) > 1) + 1
        near = np.insert(text[inside], gaps, wd.mix(gaps.astype(np.uint64)))  # runs stay apart
        tiles = tile(near, whole, seed)
        matched = sum(t[2] for t in tiles)
        if matched >= coverage * len(whole):
            yield int(item), len(tiles), matched, len(whole)


def blocks(benchmark: DataFrame, seed: int, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of at most ``limit`` bytes, but one item at least; one is held at a time."""
    ids, texts, size = [], [], 0
    for item, text in benchmark.where("text IS NOT NULL").select("item_id", "text").toLocalIterator():
        if ids and size + 4 * len(text) > limit:
            yield Block.of(ids, texts, seed)
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += 4 * len(text)
    if ids:
        yield Block.of(ids, texts, seed)


def contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = SEED_WORDS, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, item_id, n_tiles, matched_words, item_words, coverage)`` of every contaminated pair.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``; other
    columns are ignored.  Whole texts are compared.  Null and empty texts match
    nothing; items of fewer than ``seed`` words match where they stand alone, as
    a document or a line of it, and items without a word nothing.  Repeated rows on either side give repeated pairs.  Without
    documents or items there are no rows.
    """
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", doc_type),
            T.StructField("item_id", item_type),
            T.StructField("n_tiles", T.LongType()),
            T.StructField("matched_words", T.LongType()),
            T.StructField("item_words", T.LongType()),
        ]
    )
    out = docs.sparkSession.createDataFrame([], schema)
    parts = 0
    for block in blocks(benchmark, seed, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches, shared=shared):
            for batch in batches:
                got = list(_matches(batch.column(1), shared.value, seed, coverage))
                if got:
                    rows, items, *numbers = zip(*got, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows)),
                            pa.array([shared.value.ids[i] for i in items]),
                            *(pa.array(x, pa.int64()) for x in numbers),
                        ],
                        schema.names,
                    )

        if parts:  # what an earlier block found is written, so that one block is held at a time
            out = written(out, "contaminated")
        found = docs.select("doc_id", "text").mapInArrow(find, schema)
        out = found if not parts else out.unionByName(found)
        parts += 1
    return out.withColumn("coverage", F.col("matched_words") / F.col("item_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, seed: int = SEED_WORDS, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without its contaminated rows; all columns stay and nothing is shuffled."""
    at = docs.columns.index("text")
    parts = 0
    for block in blocks(benchmark, seed, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, shared=shared):
            for batch in batches:
                bad = np.zeros(batch.num_rows, bool)
                bad[[m[0] for m in _matches(batch.column(at), shared.value, seed, coverage)]] = True
                yield batch.filter(pa.array(~bad))

        if parts:
            docs = written(docs, "clean")
        docs = docs.mapInArrow(clean, docs.schema)
        parts += 1
    return docs
