"""Language identification with blended-spectrum string kernels.

A text is the set of its character n-grams of one to three characters (presence,
not counts), folded to lower case and hashed into a fixed number of buckets.
The kernel of two texts is the size of the common set over the geometric mean of
both sizes.  Nystroem landmarks, some texts of each language, span the space of
functions; one-versus-rest kernel ridge regression in it has a closed form:

    (K_nm' K_nm + ridge n K_mm) a = K_nm' Y

Scoring a batch of texts is a matrix product of their presence matrix with the
landmarks' presence and ``a``; the latter two are multiplied beforehand.

One-versus-rest outputs say which language is the nearest, not whether it is near
at all: a text like none of the sample is far from every landmark and gets
middling outputs.  So a text must also know its language: the share of its
n-grams that the language's sample has must reach what all but ``LOST`` of that
sample's own texts reach, each held against the others.  Short texts, whose
shares vary by chance, get an allowance.  Other texts are in no known language:
a filter (``keep_known``) drops them, a prediction names the nearest all the same.

The model is fitted on a bounded sample of labelled rows, ``PER_LANGUAGE`` of
each language and ``MAX_SAMPLE`` in all; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.llm import chars
from caselabel.llm import words as wd
from caselabel.llm.samples import bounded_sample, fold_of

PER_LANGUAGE = 300
MAX_SAMPLE = 3000
LANDMARKS = 48
MAX_LANDMARKS = 600
RIDGE = 1e-4
BUCKET_BITS = 15
SPECTRUM = 3
UNKNOWN = "und"
#: Share of a language's own sample that may fall below its bar, before the allowance for chance.
LOST = 0.005
#: Standard deviations of that allowance; a strange character spoils up to 1 + 2 + 3 n-grams together.
SLACK = 3.0
_TOGETHER = SPECTRUM * (SPECTRUM + 1) // 2

_ROWS = 128
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Presence matrix ``texts x buckets`` of their n-grams, and whether each text has a letter."""
    points, first = chars.code_points([t.lower() for t in texts], "\n")
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(first))
    buckets = 1 << BUCKET_BITS
    grid = np.zeros((len(texts), buckets), np.uint8)
    flat = grid.reshape(-1)
    inside = points != 10  # line breaks and the separator belong to no n-gram
    code = np.zeros(len(points), np.uint32)
    for p in range(SPECTRUM):
        n = len(points) - p
        if n <= 0:
            break
        code = code[:n] * np.uint32(0x01000193) + points[p:] * _FACTORS[p]
        inside = inside[:n] & (points[p:] != 10) if p else inside
        hashed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        place = row[:n] * buckets + (hashed >> np.uint32(32 - BUCKET_BITS))
        flat[place[inside]] = 1
    with_letter = np.zeros(len(texts), bool)
    with_letter[row[chars.letters()[points]]] = True
    return grid, with_letter


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    _, offsets = wd.buffers(batch.column(column))
    for a, b in wd.slices(offsets):
        for low in range(a, b, _ROWS):
            piece = batch.slice(low, min(_ROWS, b - low))
            yield piece, [t or "" for t in piece.column(column).to_pylist()]


@dataclass(frozen=True)
class Model:
    """Weights ``buckets x languages`` that landmarks and ridge solution multiply to.

    ``seen`` (``languages x buckets``) has the n-grams of each language's sample,
    ``bars`` the share of a text's n-grams that has to be among them.
    """

    languages: list[str]
    weights: np.ndarray
    seen: np.ndarray
    bars: np.ndarray

    @staticmethod
    def fit(grids: np.ndarray, labels: list[str], ridge: float = RIDGE, landmarks: int = LANDMARKS) -> Model:
        languages = sorted(set(labels))
        if not languages:
            return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros((0, 1 << BUCKET_BITS), bool), np.zeros(0))
        unit = _unit(grids)
        label = np.array([languages.index(x) for x in labels])
        each = max(1, min(landmarks, MAX_LANDMARKS // len(languages)))
        marks = np.concatenate([np.flatnonzero(label == c)[:each] for c in range(len(languages))])
        k_nm = (unit @ unit[marks].T).astype(np.float64)
        k_mm = k_nm[marks]
        target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
        # Languages weigh the same, however many rows each has.
        weight = 1.0 / np.bincount(label)[label]
        left = k_nm.T @ (weight[:, None] * k_nm) + ridge * k_mm + 1e-9 * np.eye(len(marks))
        solution = np.linalg.solve(left, k_nm.T @ (weight[:, None] * target))
        seen, bars = zip(*(_familiar(grids[label == c]) for c in range(len(languages))), strict=True)
        return Model(languages, (unit[marks].T @ solution).astype(np.float32), np.stack(seen), np.array(bars))

    def scores(self, grid: np.ndarray) -> np.ndarray:
        """One-versus-rest outputs, about -1 to 1."""
        size = np.sqrt(np.maximum(grid.sum(axis=1, dtype=np.int64), 1))
        return (grid.astype(np.float32) @ self.weights) / size[:, None]

    def known(self, grid: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether each text has enough of its n-grams in common with the sample of the language ``best``."""
        size = np.maximum(np.count_nonzero(grid, axis=1), 1)
        share = np.count_nonzero(grid.view(bool) & self.seen[best], axis=1) / size
        bar = self.bars[best]
        return share >= bar - SLACK * np.sqrt(_TOGETHER * bar * (1 - bar) / size)

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Nearest language, its score, and whether the text is in a known language at all."""
        grid, with_letter = presence(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        out = self.scores(grid)
        best = out.argmax(axis=1)
        score = np.clip((out[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, with_letter, strict=True)]
        return names, np.where(with_letter, score, 0.0), with_letter & self.known(grid, best)


def _unit(grids: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(grids.sum(axis=1, dtype=np.int64), 1))
    return grids.astype(np.float32) / size[:, None].astype(np.float32)


def _familiar(grids: np.ndarray) -> tuple[np.ndarray, float]:
    """N-grams of a language's sample, and the share of them that all but ``LOST`` of its texts have from the others."""
    holders = grids.sum(axis=0, dtype=np.int64)
    shares = [np.count_nonzero(row.view(bool) & (holders > 1)) / max(np.count_nonzero(row), 1) for row in grids]
    return holders > 0, float(np.quantile(shares, LOST))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, max_sample: int = MAX_SAMPLE) -> Model:
    """Model from ``labelled`` (``doc_id, text, lang``); rows without language or without a letter are left out."""

    def featured(batches):
        for batch in batches:
            for piece, texts in _batches(batch, 1):
                grid, with_letter = presence(texts)
                bits = [row.tobytes() for row in np.packbits(grid, axis=1)]
                out = pa.RecordBatch.from_arrays([piece.column(0), pa.array(bits, pa.binary()), piece.column(2)], ["lang", "bits", "place"])
                yield out.filter(pa.array(with_letter))

    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    chosen = bounded_sample(rows, "lang", per_language, max_sample)
    chosen = chosen.select("lang", "text", F.xxhash64("doc_id").alias("place"))
    # Packed presence bits of the sample come to the driver: rows of 4 KB, MAX_SAMPLE or one per language.
    got = sorted(map(tuple, chosen.mapInArrow(featured, "lang string, bits binary, place long").collect()), key=lambda r: (r[2], r[0], r[1]))
    grids = [np.unpackbits(np.frombuffer(bits, np.uint8)) for _, bits, _ in got]
    grids = np.stack(grids) if grids else np.zeros((0, 1 << BUCKET_BITS), np.uint8)
    return Model.fit(grids, [lang for lang, _, _ in got])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (``doc_id, text``) as ``(doc_id, lang_pred, score)``, one row per row.

    Null texts and texts without a letter get ``und`` and score 0; so does
    everything when the model has seen no language.  Long texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for piece, texts in _batches(batch, 1):
                names, values, _ = shared.value.judge(texts)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(names, pa.string()), pa.array(values, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Languages of all rows by a model that has not seen the held-out fold: ``(doc_id, held_out, lang_pred, score)``."""
    model = fit(docs.where(fold_of(F.col("doc_id"), folds) != held))
    return predict(docs, model).select("doc_id", (fold_of(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """``docs`` without the rows in no known language and those whose language scores below ``least``; columns stay, nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            for piece, texts in _batches(batch, at):
                _, values, known = shared.value.judge(texts)
                yield piece.filter(pa.array(known & (values >= least)))

    return docs.mapInArrow(keep, docs.schema)
