"""Document quality by Bradley-Terry pairwise ranking.

Every text has a vector of surface features.  From preference pairs, one text
labelled good and one labelled bad, weights are learned by logistic loss on the
difference of the two vectors, so the weighted sum is a quality score of a single
document.  A document is good when its score lies above a quantile of the
scores: the share of bad documents.

Scores are shown on a scale from 0 to 1 by their place among the scores of all
labelled documents; the quantile that separates good from bad is put at ``BAR``.

The model is fitted on all labelled texts and all pairs of a good and a bad one.
A pair's part in the loss depends on the two scores alone, so a pass over the
rows counts them, and adds up their vectors, by class and small step of the
score; the pairs of two steps are then settled together.  The quantile is found
by passes that count ever smaller steps around it.  Vectors are computed once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.llm import words as wd
from caselabel.llm.samples import fold_of, known_labels
from caselabel.llm.tables import written

BAR = 0.3
#: Penalty of the squared weights, against the mean loss of a pair.
RIDGE = 2.5e-6
#: Newton steps at most, and the mean loss of a pair that the last one may still have to gain.
STEPS, ENOUGH = 30, 1e-5
#: Steps that scores are told apart by in a pass, how many deviations they span, and passes that narrow the quantile.
BINS, SPAN, NARROWED = 1024, 8.0, 4

_CLASSES = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "blank": [0x20, 0x09, 0x0B, 0x0C, 0x0D],
    "line": [0x0A],
    "stop": [ord(c) for c in ".?"],
    "comma": [ord(c) for c in ",;:"],
    "loud": [ord("!")],
    "sign": [ord(c) for c in "#$%&*+-/<=>@\\^_`|~"],
    "other": [*range(128, 256)],
}
_KIND = np.zeros(256, np.uint8)
for _i, _codes in enumerate(_CLASSES.values(), 1):
    _KIND[_codes] = _i
_SECOND_BYTES = np.zeros(256, bool)
_SECOND_BYTES[0x80:0x9F] = True  # second bytes of accented capitals after C3
_LINE = np.zeros(256, bool)
_LINE[0x0A] = True

NAMES = [
    *(f"share_{c}" for c in _CLASSES), "accented_capitals", "word_length", "word_spread", "short_words", "long_words",
    "repeats", "distinct", "distinct_pairs", "distinct_triples", "signs_alone", "words_with_sign", "capital_words",
    "line_words", "repeated_lines", "log_words", "log_words_squared",
]


def _distinct(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Different hashes of each text."""
    marked = np.unique(wd.mix(hashes ^ wd.mix(text.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    return np.bincount(text[marked], minlength=texts)


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``texts x features`` of a few texts."""
    texts = len(offsets) - 1
    low, high = int(offsets[0]), int(offsets[-1])
    own = offsets - low
    raw = data[low:high]
    kind = _KIND[raw]
    size = np.maximum(np.diff(own), 1)

    def per_text(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mark, dtype=np.int32)])
        return total[own[1:]] - total[own[:-1]]

    columns = [per_text(kind == i) / size for i in range(1, len(_CLASSES) + 1)]
    after = np.zeros(len(raw), bool)
    after[1:] = (raw[:-1] == 0xC3) & _SECOND_BYTES[raw[1:]]
    columns.append(per_text(after) / size)
    found = wd.words(data, offsets)
    text, count = found.text, np.diff(found.first)
    some = np.maximum(count, 1)
    length = (found.end - found.start).astype(np.float64)

    def per_word(value: np.ndarray) -> np.ndarray:
        return np.bincount(text, value, minlength=texts) / some

    mean = per_word(length)
    columns += [mean / 10, np.sqrt(np.maximum(per_word(length**2) - mean**2, 0)) / 10, per_word(length <= 3), per_word(length >= 12)]
    same = np.zeros(len(text), bool)
    same[1:] = (found.hash[1:] == found.hash[:-1]) & (text[1:] == text[:-1])
    columns += [per_word(same), _distinct(found.hash, text, texts) / some]
    for k in (2, 3):
        hashes, first = wd.shingles(found, k)
        owner = np.repeat(np.arange(texts), np.diff(first))
        columns.append(_distinct(hashes, owner, texts) / np.maximum(np.diff(first), 1))
    sign = np.concatenate([[0], np.cumsum(kind == 9, dtype=np.int32)])
    signs = sign[found.end - low] - sign[found.start - low]
    columns += [per_word(signs == length), per_word(signs > 0), per_word(kind[found.start - low] == 1)]
    lines = wd.words(data, offsets, _LINE)
    n_lines = np.maximum(np.diff(lines.first), 1)
    columns += [np.log1p(count / n_lines), 1 - _distinct(lines.hash, lines.text, texts) / n_lines]
    log = np.log1p(count) / 10
    columns += [log, log**2]
    return np.stack(columns, axis=1).astype(np.float64)


def features(column: pa.Array) -> np.ndarray:
    data, offsets = wd.buffers(column)
    parts = [_features(data, offsets[a : b + 1]) for a, b in wd.slices(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))


#: Sums over all labelled rows: takes a function from blocks ``(x, label)`` to ``(keys, values)``, gives ``size x width``.
Sums = Callable[[Callable, int, int], np.ndarray]


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features on a grid of 2^-20, on which sums come out alike in any order."""
    return np.rint(np.clip((x - mean) / scale, -8, 8) * 2**20) / 2**20


def _raw(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sums, added up column by column, so that a row's does not depend on its batch."""
    total = np.zeros(len(z))
    for column, weight in zip(z.T, weights, strict=True):
        total += column * weight
    return total


def _edges(weights: np.ndarray, middle: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Edges of ``BINS`` steps of the score; what lies beyond ``SPAN`` deviations is in the first or last."""
    centre, bound = float(middle @ weights), 8 * float(np.abs(weights).sum()) + 1
    spread = SPAN * float(np.sqrt(max(weights @ second @ weights - centre**2, 0))) + 1e-9
    return np.concatenate([[-bound], np.linspace(max(centre - spread, -bound), min(centre + spread, bound), BINS - 1)[1:-1], [bound]])


def _place(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.clip(np.searchsorted(edges, raw, "right") - 1, 0, len(edges) - 2)


def _by_key(key: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(key, column, minlength=size) for column in values.T], axis=1)


def _held_in_memory(x: np.ndarray, label: np.ndarray) -> Sums:
    def sums(part, size, width):
        keys, values = part(x, label)
        return _by_key(keys, values, size)

    return sums


def _held_in_spark(train: DataFrame) -> Sums:
    """Sums over ``(label, x)``; a task gives a row per key it has, and the driver gets ``size`` rows."""

    def sums(part, size, width):
        names = [f"c{i}" for i in range(width)]

        def of_task(batches):
            total, seen = np.zeros((size, width)), np.zeros(size, bool)
            for batch in batches:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
                keys, values = part(x, batch.column(0).to_numpy(zero_copy_only=False))
                total += _by_key(keys, values, size)
                seen[keys] = True
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c) for c in total[at].T)], ["key", *names])

        parts = train.mapInArrow(of_task, ", ".join(["key int", *(f"{c} double" for c in names)]))
        out = np.zeros((size, width))
        for row in parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).collect():
            out[row[0]] = row[1:]
        return out

    return sums


def _moments(sums: Sums, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of each class, and the mean and scale of the features of all rows."""

    def part(x, label):
        ones = np.ones((len(x), 1))
        return np.concatenate([label, label + 2]), np.concatenate([np.hstack([ones, x]), np.hstack([ones, x**2])])

    total = sums(part, 4, 1 + width)
    n = total[:2, 0]
    rows = max(n.sum(), 1)
    mean = total[:2, 1:].sum(axis=0) / rows
    spread = np.sqrt(np.maximum(total[2:, 1:].sum(axis=0) / rows - mean**2, 0))
    # Any middle and unit will do: rounded, they do not show the order of the sums.
    unit = 10.0 ** np.floor(np.log10(spread + 1e-9) - 6)
    return n, np.rint(mean / unit) * unit, np.rint(spread / unit) * unit + 1e-9


def _pair_weights(sums: Sums, mean: np.ndarray, scale: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of least mean loss over all pairs by Newton steps; also mean and second moment of the scaled features."""
    width = len(mean)

    def second_moment(edges, weights, factor):
        def part(x, label):
            z = _scaled(x, mean, scale)
            own = factor[label, _place(_raw(z, weights), edges)]
            return np.arange(width + 1), np.vstack([(z * own[:, None]).T @ z, z.sum(axis=0)])

        return sums(part, width + 1, width)

    weights = np.zeros(width)
    first = second_moment(np.array([-1.0, 1.0]), weights, np.ones((2, 1)))
    middle, second = first[-1] / n.sum(), np.rint(first[:-1] / n.sum() * 2**20) / 2**20
    for _ in range(STEPS):
        edges = _edges(weights, middle, second)

        def part(x, label, edges=edges, weights=weights):
            z = _scaled(x, mean, scale)
            return label * BINS + _place(_raw(z, weights), edges), np.hstack([np.ones((len(z), 1)), z])

        total = sums(part, 2 * BINS, 1 + width).reshape(2, BINS, 1 + width)
        count, vector = total[:, :, 0], total[:, :, 1:]
        score = np.where(count > 0, vector @ weights / np.maximum(count, 1), 0)
        # Rows: steps of the bad; columns: steps of the good.  A pair is lost by the chance that the bad one is preferred.
        lost = 1 / (1 + np.exp(np.clip(score[1][None, :] - score[0][:, None], -40, 40)))
        slope = lost * (1 - lost)
        pairs = n[0] * n[1]
        pull = (count[0] @ lost) @ vector[1] - (lost @ count[1]) @ vector[0]
        factor = np.stack([slope @ count[1], count[0] @ slope])
        cross = vector[0].T @ slope @ vector[1]
        hessian = (second_moment(edges, weights, factor)[:-1] - cross - cross.T) / pairs
        top = 2.0 ** np.ceil(np.log2(np.abs(hessian).max() + 1e-300))
        hessian = np.rint(hessian / top * 2**20) / 2**20 * top + (RIDGE + 1e-5 * top) * np.eye(width)
        slant = pull / pairs - RIDGE * weights
        step = np.linalg.solve(hessian, slant)
        gain = float(slant @ step) / 2
        weights = weights + step * min(1.0, 4.0 / max(float(np.abs(step).max()), 1e-12))
        if gain < ENOUGH:
            break
    return weights, middle, second


def _quantile_places(sums: Sums, model: tuple, edges: np.ndarray, n: np.ndarray, bad_share: float) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the score that hold rows, and the share of documents up to the middle of each; finest at ``bad_share``."""
    weights, mean, scale = model
    mass_of = np.array([bad_share, 1 - bad_share]) / n
    at, before, mass = np.zeros(0), np.zeros(0), np.zeros(0)
    base = 0.0
    for level in range(NARROWED):

        def part(x, label, edges=edges):
            raw = _raw(_scaled(x, mean, scale), weights)
            inside = (raw >= edges[0]) & (raw < edges[-1])
            return _place(raw[inside], edges), np.stack([label[inside] == 0, label[inside] == 1], axis=1).astype(float)

        own = sums(part, len(edges) - 1, 2) @ mass_of
        start = base + np.cumsum(own) - own
        middle = (edges[1:] + edges[:-1]) / 2
        if level == 0:
            middle[0], middle[-1] = edges[1] - 1e-9, edges[-2] + 1e-9
        inside = np.flatnonzero(own > 0)
        split = inside[min(np.searchsorted(start[inside], bad_share, "left"), len(inside)) - 1]
        last = level == NARROWED - 1 or edges[split + 1] - edges[split] < 1e-12
        kept = inside if last else inside[inside != split]
        at, before, mass = np.append(at, middle[kept]), np.append(before, start[kept]), np.append(mass, own[kept])
        if last:
            break
        base, edges = start[split], np.linspace(edges[split], edges[split + 1], BINS + 1)
    order = np.argsort(at, kind="stable")
    return at[order], (before + mass / 2)[order]


@dataclass(frozen=True)
class Model:
    """Weights of the features, steps of the score in order, and the place of each between 0 and 1."""

    weights: np.ndarray | None  # None: the labelled texts do not have both classes
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    scores: np.ndarray | None = None
    places: np.ndarray | None = None
    constant: float = 0.5

    @staticmethod
    def fit(x: np.ndarray, label: np.ndarray, bad_share: float, bar: float = BAR) -> Model:
        """Learn from rows of both classes; ``bad_share`` of all documents are bad."""
        return Model.fit_sums(_held_in_memory(x, np.asarray(label, np.int64)), x.shape[1], bad_share, bar)

    @staticmethod
    def fit_sums(sums: Sums, width: int, bad_share: float, bar: float = BAR) -> Model:
        n, mean, scale = _moments(sums, width)
        if n.min() == 0:
            return Model(None, constant=float(n[1] > 0) if n.sum() else 0.5)
        weights, middle, second = _pair_weights(sums, mean, scale, n)
        scores, place = _quantile_places(sums, (weights, mean, scale), _edges(weights, middle, second), n, bad_share)
        # The quantile of the bad share stands at the bar; both sides are stretched to 0 and 1.
        shown = np.where(place <= bad_share, bar * place / max(bad_share, 1e-12), bar + (1 - bar) * (place - bad_share) / max(1 - bad_share, 1e-12))
        return Model(weights, mean, scale, scores, np.clip(shown, 0, 1))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        return np.interp(_raw(_scaled(x, self.mean, self.scale), self.weights), self.scores, self.places)


def vectors(docs: DataFrame) -> DataFrame:
    """``(doc_id, known, x)``: the features of every row of ``docs`` (``doc_id, text``); null texts count as empty and are not known."""

    def featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            x = features(text)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), text.is_valid(), lists], ["doc_id", "known", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(featured, f"doc_id {kind}, known boolean, x array<double>")


def fit(table: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bar: float = BAR) -> Model:
    """Model from all ``vectors`` and ``labels`` (``doc_id, quality``) outside the held-out fold.

    Of repeated ids one label and one vector are taken, the least; null texts
    are left out.
    """
    known, sizes = known_labels(labels, "quality", folds, held)
    if len(sizes) < 2:
        return Model(None, constant=float(next(iter(sizes))) if sizes else 0.5)
    own = table.where(F.col("known") & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held))
    train = own.groupBy("doc_id").agg(F.min("x").alias("x")).join(known, "doc_id").select("label", "x")
    return Model.fit_sums(_held_in_spark(written(train, "quality-train")), len(NAMES), sizes[0] / (sizes[0] + sizes[1]), bar)


def score(table: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of ``vectors``."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.predict(x), pa.float64())], ["doc_id", "score"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "x").mapInArrow(scored, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bar: float = BAR) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` by a model fitted outside the held-out fold.

    ``labels`` has ``doc_id, quality``.  One row per row of ``docs``; empty and
    null texts are scored by their features like others.  With labels of one
    class only, that class is every score; without labels it is 0.5.
    """
    table = written(vectors(docs), "quality-vectors")
    model = fit(table, labels, folds, held, bar=bar)
    held_out = fold_of(F.col("doc_id"), folds) == held
    return score(table, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= bar).cast("int").alias("predicted"))
