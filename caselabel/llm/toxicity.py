"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
A text is cut into windows of ``WINDOW`` words, each window is compressed with
either dictionary, and the difference of the two lengths says how much closer
the window is to toxic text.

* The ordinary dictionary is trained by zstandard on ordinary windows.  The
  toxic dictionary has the same content and, closest to the data, the word
  beginnings and words that toxic sample texts share and ordinary ones don't,
  chosen greedily by the bytes that they save.  So lengths differ only where
  that part helps.  It is sharpened in ``ROUNDS``: ordinary windows that come
  out as toxic join the ordinary content of both.
* A compressed length is a whole number of bytes and short inputs are stored
  raw.  Letters are therefore written as two bytes each, and every window
  stands between the same known letters, which puts it past the raw form and
  away from the last bytes, in which no matches are sought.
* Thresholds are calibrated on the sample: each difference counts with its log
  likelihood ratio, if that is at least ``LEAST_RATIO``, and a logistic curve
  over a text's sum gives its score from 0 to 1.

The model is fitted on a bounded sample, ``PER_CLASS`` labelled texts of each
class and ``WORDS_PER_TEXT`` different words of each; the curve and every score
use whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.llm import words as wd
from caselabel.llm.logistic import fit_logistic, sigmoid
from caselabel.llm.samples import fold_of, labelled_sample
from caselabel.llm.tables import written

PER_CLASS = 800
WORDS_PER_TEXT = 400
WINDOW = 2
ROUNDS = 3
LEVEL, MIN_MATCH = 3, 7
ORDINARY_BYTES = 1500
PRIMER_BYTES = 12
#: Ordinary windows that join in each round, and the difference that makes one a mistake.
MISTAKES, MISTAKE_BYTES = 400, 5
#: Word beginnings: letters, texts that must have one, and how much more frequent it must be in toxic texts.
SHORTEST, LONGEST, MOST_PARTS = 4, 12, 200
LEAST_TEXTS, LEAST_SHARE, CONTRAST = 4, 0.02, 8
LEAST_RATIO = 1.0
#: Differences are counted up to this.
BINS = 32

_SECOND = np.random.default_rng(1).permutation(256).astype(np.uint8)


def two_bytes(data: np.ndarray) -> np.ndarray:
    """Every byte followed by its partner in a fixed permutation."""
    out = np.empty(2 * len(data), np.uint8)
    out[::2] = data
    out[1::2] = _SECOND[data]
    return out


def windows(data: np.ndarray, offsets: np.ndarray, primer: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Two-byte form of the primed windows of some texts, their ``(start, length)``, and each text's first window."""
    found = wd.words(data, offsets)
    count = np.diff(found.first)
    have = -(-count // WINDOW)
    first = np.concatenate([[0], np.cumsum(have)])
    at = np.repeat(found.first[:-1] - WINDOW * first[:-1], have) + WINDOW * np.arange(first[-1])
    last = np.minimum(at + WINDOW, np.repeat(found.first[1:], have)) - 1
    start, size = found.start[at], found.end[last] - found.start[at]
    # Each window: primer, blank, its bytes, blank, primer.
    place = np.concatenate([[0], np.cumsum(size + 2 * len(primer) + 2)])
    out = np.full(place[-1], 32, np.uint8)
    lead = np.frombuffer(primer, np.uint8)
    out[(place[:-1, None] + np.arange(len(primer))).ravel()] = np.tile(lead, len(at))
    out[(place[1:, None] - len(primer) + np.arange(len(primer))).ravel()] = np.tile(lead, len(at))
    before = np.concatenate([[0], np.cumsum(size)])
    step = np.arange(before[-1])
    chars = wd.fold_ascii(data[np.repeat(start - before[:-1], size) + step])
    chars[wd.blanks(chars)] = 32
    out[np.repeat(place[:-1] + len(primer) + 1 - before[:-1], size) + step] = chars
    segments = np.stack([2 * place[:-1], 2 * np.diff(place)], axis=1).astype(np.uint64)
    return two_bytes(out).tobytes(), segments, first


class Distance:
    """Compressed lengths under the ordinary dictionary less those under the toxic one."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.compressors = []
        for content in (ordinary, toxic):
            raw = two_bytes(np.frombuffer(content, np.uint8)).tobytes()
            kept = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
            settings = zs.ZstdCompressionParameters.from_level(
                LEVEL, source_size=64, dict_size=len(raw), min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            kept.precompute_compress(compression_params=settings)
            self.compressors.append(zs.ZstdCompressor(compression_params=settings, dict_data=kept))

    def of(self, data: bytes, segments: np.ndarray) -> np.ndarray:
        if not len(segments):
            return np.zeros(0, np.int64)
        lengths = []
        for compressor in self.compressors:
            out = compressor.multi_compress_to_buffer(zs.BufferWithSegments(data, segments.tobytes()), threads=1)
            lengths.append(np.fromiter(map(len, out), np.int64, len(out)))
        return lengths[0] - lengths[1]


@dataclass
class Model:
    ordinary: bytes = b" "
    toxic: bytes = b" "
    primer: bytes = b" "
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(BINS))
    curve: np.ndarray | None = None  # None: the sample does not have both classes
    constant: float = 0.5

    def __post_init__(self) -> None:
        self._distance = None

    def __getstate__(self):
        return {**self.__dict__, "_distance": None}

    def differences(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``texts x BINS``: how many windows of each text have each difference."""
        if self._distance is None:
            self._distance = Distance(self.ordinary, self.toxic)
        raw, segments, first = windows(data, offsets, self.primer)
        gap = np.clip(self._distance.of(raw, segments), 0, BINS - 1)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        return np.bincount(row * BINS + gap, minlength=(len(first) - 1) * BINS).reshape(-1, BINS)

    def _features(self, counts: np.ndarray) -> np.ndarray:
        total, evidence = counts.sum(axis=1), counts @ self.ratio
        return np.stack([np.log1p(evidence), evidence / np.sqrt(np.maximum(total, 1)), np.log1p(total)], axis=1)

    def calibrate(self, counts: np.ndarray, label: np.ndarray, share: float) -> None:
        """Ratios and curve from the differences of labelled texts; ``share`` of all texts are toxic."""
        per_class = [counts[label == c].sum(axis=0) + 0.5 for c in (0, 1)]
        ratio = np.log(per_class[1] / per_class[1].sum()) - np.log(per_class[0] / per_class[0].sum())
        self.ratio = np.where((ratio >= LEAST_RATIO) & (np.arange(BINS) > 0), ratio, 0.0)
        weight = np.where(label == 1, share / (label == 1).mean(), (1 - share) / (label == 0).mean())
        self.curve = fit_logistic(self._features(counts), label, weight)

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = wd.buffers(column)
        if self.curve is None:
            return np.full(len(offsets) - 1, self.constant)
        parts = [self._features(self.differences(data, offsets[a : b + 1])) for a, b in wd.slices(offsets)]
        return np.concatenate([sigmoid(self.curve, p) for p in parts]) if parts else np.zeros(0)


def toxic_parts(toxic: list[set[bytes]], ordinary: list[set[bytes]]) -> list[bytes]:
    """Beginnings of words, and words, that toxic texts share and ordinary ones don't, best first."""

    def beginnings(word):
        return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)]

    texts = Counter(p for words in toxic for p in {p for w in words for p in beginnings(w)})
    need = max(LEAST_TEXTS, LEAST_SHARE * len(toxic))
    have = Counter(p for words in toxic for w in words for p in beginnings(w) if texts[p] >= need)
    other = Counter(p for words in ordinary for w in words for p in beginnings(w) if p in have)
    odds = CONTRAST * sum(map(len, toxic)) / max(sum(map(len, ordinary)), 1)
    good = {p for p, n in have.items() if n > odds * (other[p] + 1)}
    left = Counter(w for words in toxic for w in words if not good.isdisjoint(beginnings(w)))
    parts: list[bytes] = []
    while left and len(parts) < MOST_PARTS:
        saved = Counter()
        for w, n in left.items():
            for p in beginnings(w):
                if p in good:
                    saved[p] += n * (len(p) - 2.5)
        best = max(saved, key=lambda p: (saved[p], p))
        parts.append(best)
        left = Counter({w: n for w, n in left.items() if not w.startswith(best)})
        good = {p for p in good if not best.startswith(p) and not p.startswith(best)}
        left = Counter({w: n for w, n in left.items() if not good.isdisjoint(beginnings(w))})
    return parts


def aligned(content: bytes) -> bytes:
    """Filled to a multiple of three: zstandard surely finds dictionary places at such distances."""
    return content + b"\x09" * (-len(content) % 3)


def _trained(texts: list[list[bytes]]) -> bytes:
    """Content of a dictionary that zstandard trains on runs of eight words; little text stands for itself."""
    samples = [b" ".join(text[i : i + 8]) for text in texts for i in range(0, len(text), 8)]
    try:
        content = zs.train_dictionary(8192, samples, k=64, d=6).as_bytes()
    except zs.ZstdError:
        content = b" ".join(samples)
    return content[-ORDINARY_BYTES:].rjust(PRIMER_BYTES)


def train(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Model:
    """Dictionaries from the different words, in text order, of toxic and ordinary sample texts."""
    spaced = [[{b" " + w + b" " for w in text} for text in texts] for texts in (toxic, ordinary)]
    found = toxic_parts(*spaced)
    parts = b"".join(map(aligned, reversed(found)))  # the best part is closest to the data
    # What the toxic dictionary has more is matched by bytes that no text has, so that distances cost the same.
    filler = bytes(1 + 7 * i % 8 for i in range(len(parts)))
    content = aligned(_trained(ordinary))
    primer = content[-PRIMER_BYTES:]
    data, offsets = wd.buffers(pa.array([b" ".join(t) for t in ordinary], pa.binary()))
    for last in range(ROUNDS, -1, -1):
        model = Model(content + filler + primer, content + parts + primer, primer)
        if not last:
            return model
        wrong = Counter()
        for a, b in wd.slices(offsets):
            raw, segments, _ = windows(data, offsets[a : b + 1], primer)
            gap = Distance(model.ordinary, model.toxic).of(raw, segments)
            skip = 2 * (len(primer) + 1)
            for start, size in segments[gap >= MISTAKE_BYTES].astype(np.int64).tolist():
                window = raw[start + skip - 2 : start + size - skip + 2 : 2]
                if not any(part in window for part in found):
                    wrong[window[1:-1]] += 1
        mistakes = sorted(wrong, key=lambda w: (wrong[w], w))[-MISTAKES:]
        content += b"".join(aligned(b" " + w + b" ") for w in mistakes)
    raise AssertionError


def _sampled_words(piece: pa.Array) -> Iterator[list[bytes]]:
    """``WORDS_PER_TEXT`` different words of each text, by hash, in text order."""
    data, offsets = wd.buffers(piece)
    for a, b in wd.slices(offsets):
        found = wd.words(data, offsets[a : b + 1])
        for i in range(b - a):
            low, high = found.first[i], found.first[i + 1]
            _, at = np.unique(found.hash[low:high], return_index=True)
            at = np.sort(at[:WORDS_PER_TEXT]) + low
            yield [wd.fold_ascii(data[found.start[j] : found.end[j]]).tobytes() for j in at]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, per_class: int = PER_CLASS) -> Model:
    """Model from the texts of ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``) outside the held-out fold."""
    chosen, sizes = labelled_sample(docs, labels, "toxic", per_class, folds, held)
    chosen = written(chosen.select("doc_id", "text", "label"), "toxicity-sample")
    if len(sizes) < 2:
        return Model(constant=float(next(iter(sizes))) if sizes else 0.5)

    def words_of(batches):
        for batch in batches:
            got = list(_sampled_words(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.list_(pa.binary()))], ["doc_id", "label", "words"])

    # Some words of each sampled text come to the driver: at most 2 * per_class * WORDS_PER_TEXT.
    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = chosen.select("doc_id", "text", "label").mapInArrow(words_of, f"doc_id {kind}, label int, words array<binary>").collect()
    texts = {label: sorted({tuple(map(bytes, r["words"])) for r in rows if r["label"] == label}) for label in (0, 1)}
    if not (texts[0] and texts[1]):
        return Model(constant=float(bool(texts[1]))) if rows else Model()
    model = train([list(t) for t in texts[1]], [list(t) for t in texts[0]])

    def counts_of(batches):
        for batch in batches:
            data, offsets = wd.buffers(batch.column(1))
            for a, b in wd.slices(offsets):
                counts = model.differences(data, offsets[a : b + 1])
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(a, b - a), pa.array(list(counts), pa.list_(pa.int64()))], ["label", "counts"])

    rows = chosen.select("doc_id", "text", "label").mapInArrow(counts_of, "label int, counts array<long>").collect()
    rows = sorted((r["label"], r["counts"]) for r in rows)
    model.calibrate(np.array([c for _, c in rows]), np.array([label for label, _ in rows]), sizes[1] / (sizes[0] + sizes[1]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs`` (``doc_id, text``).

    Null texts count as empty; empty texts get the score of a text without
    evidence.  Long texts are scored whole, slice by slice of the table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bar: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` by a model fitted outside the held-out fold.

    ``labels`` has ``doc_id, toxic``.  One row per row of ``docs``.  With labels
    of one class only, that class is every score; without labels it is 0.5.
    """
    model = fit(docs, labels, folds, held)
    held_out = fold_of(F.col("doc_id"), folds) == held
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= bar).cast("int").alias("predicted"))
