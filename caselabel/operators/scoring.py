"""Scoring narratives with a lexicon or with a classifier the caller plugs in."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel import vocab


class Lexicon:
    """Weighted tokens per label, written into the plan.

    A plan grows with its lexicon; from some thousands of entries on a table and
    ``score_with_lexicon_table`` are the better choice, which is the caller's.
    """

    def __init__(self, entries: Iterable[tuple[str, str, int]], default: str = vocab.OTHER):
        self.entries = tuple(entries)
        self.default = default
        if any(w <= 0 or w != int(w) for _, _, w in self.entries):
            raise ValueError("weights are positive integers, so that sums are exact")

    @property
    def tokens(self) -> list[str]:
        return sorted({t for t, _, _ in self.entries})

    def weights(self) -> dict[str, dict[int, list[str]]]:
        """Tokens by label and weight, labels in alphabetical order."""
        out: dict[str, dict[int, list[str]]] = {}
        for token, label, weight in self.entries:
            out.setdefault(label, {}).setdefault(int(weight), []).append(token)
        return dict(sorted(out.items()))


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(tokens: str, wanted: Iterable[str]) -> str:
    return f"filter({tokens}, x -> x IN ({', '.join(_literal(w) for w in wanted)}))"


def lexicon_verdict(text: str, lexicon: Lexicon) -> Column:
    """Struct ``(label, score)`` of the narrative in a column, as one expression.

    The text and its known tokens are bound to lambda variables, so that each is
    computed once per row (see ``functions.text.once``).  NULL text gives NULL.
    """
    sums = []
    for label, by_weight in lexicon.weights().items():
        total = " + ".join(f"{w} * size({_among('hits', tokens)})" for w, tokens in sorted(by_weight.items()))
        sums.append(f"named_struct('label', {_literal(label)}, 's', {total})")
    verdict = f"""aggregate(
        array({', '.join(sums)}),
        named_struct('label', {_literal(lexicon.default)}, 'best', 0, 'total', 0),
        (acc, item) -> named_struct(
            'label', if(item.s > acc.best, item.label, acc.label),
            'best', greatest(acc.best, item.s),
            'total', acc.total + item.s),
        acc -> named_struct('label', acc.label, 'score', if(acc.total > 0, acc.best / acc.total, 0D)))"""
    known = _among("split(t, ' ')", lexicon.tokens)
    bound = f"get(transform(array({known}), hits -> {verdict}), 0)"
    return F.expr(f"get(transform(array(`{text}`), t -> if(t IS NULL, NULL, {bound})), 0)")


def score_with_lexicon(
    df: DataFrame, text: str, lexicon: Lexicon, label: str, score: str, only: Column | None = None
) -> DataFrame:
    """Add the best label and its share of the total evidence.

    The whole text is read in one map-side pass: tokens are first reduced to
    those the lexicon knows, then summed per label.  No row leaves its
    partition and no Python runs.  Rows outside ``only`` are not tokenised and
    get NULL.  Ties go to the label that sorts first; a text without any known
    token gets the lexicon's default label with score 0.
    """
    verdict = lexicon_verdict(text, lexicon)
    scored = df.withColumn("_verdict", verdict if only is None else F.when(only, verdict))
    return scored.withColumns({label: F.col("_verdict.label"), score: F.col("_verdict.score")}).drop("_verdict")


def score_with_lexicon_table(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame,
    label: str,
    score: str,
    default: str = vocab.OTHER,
    salt: int = 16,
) -> DataFrame:
    """Same scores from a lexicon of any size, as ``(key, label, score)``.

    ``lexicon`` has ``token, label, weight``.  A text's different tokens are
    counted inside its row, so a token is shuffled once per text, and both
    sides carry a salt derived from the key so that one very common token
    spreads over ``salt`` partitions.  Only tokens that the lexicon knows go on
    from there, to sums per case.  Texts without one are found by a join of the
    keys alone.
    """
    # Sorted tokens: where the next one differs, a run ends; its length is the distance to the run before.
    texts = df.select(F.col(key).alias("_k"), F.array_sort(F.split(F.col(text), " ")).alias("_t"))
    places = F.sequence(F.lit(0), F.size("_t") - 1)
    texts = texts.withColumn("_e", F.filter(places, lambda i: ~F.col("_t")[i].eqNullSafe(F.get("_t", i + 1))))
    runs = F.transform(
        "_e", lambda e, j: F.struct(F.get("_t", e).alias("token"), (e - F.coalesce(F.get("_e", j - 1), F.lit(-1))).alias("copies"))
    )
    counted = texts.select("_k", F.inline(runs))
    counted = counted.withColumn("_salt", F.pmod(F.xxhash64("_k"), F.lit(salt)))
    salted = lexicon.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    sums = counted.join(salted, ["token", "_salt"]).groupBy("_k", "label").agg(F.sum(F.col("copies") * F.col("weight")).alias("s"))
    rank = F.struct((-F.col("s")).alias("neg"), F.col("label").alias("label"))
    best = sums.groupBy("_k").agg(F.min(rank).alias("best"), F.sum("s").alias("evidence"))
    keys = df.select(F.col(key).alias("_k"), F.col(text).isNotNull().alias("has"))
    keys = keys.groupBy("_k").agg(F.bool_or("has").alias("has"))
    return keys.join(best, "_k", "left").select(
        F.col("_k").alias(key),
        F.when(F.col("has"), F.coalesce("best.label", F.lit(default))).alias(label),
        F.when(F.col("has"), F.coalesce(-F.col("best.neg") / F.col("evidence"), F.lit(0.0))).alias(score),
    )


Classifier = Callable[[list[str]], list[tuple[str, float]]]


def _windows(text: str, size: int | None) -> list[str]:
    if not size:
        return [text]
    words = text.split(" ")
    return [" ".join(words[i : i + size]) for i in range(0, len(words), size)]


def _classify(texts: list[str], model: Classifier, size: int | None) -> list[tuple[str, float]]:
    """Score whole texts; a long one is the length-weighted vote of its windows."""
    cut = [_windows(t, size) for t in texts]
    answers = iter(model([w for windows in cut for w in windows])) if texts else iter(())
    out = []
    for windows in cut:
        votes: dict[str, float] = {}
        lengths = [len(w.split(" ")) for w in windows]
        for length in lengths:
            name, value = next(answers)
            votes[name] = votes.get(name, 0.0) + value * length / sum(lengths)
        best = min(votes, key=lambda name: (-votes[name], name))
        out.append((best, votes[best]))
    return out


def plug_in_score(
    df: DataFrame,
    text: str,
    load_model: Callable[[], Classifier],
    label: str,
    score: str,
    only: Column | None = None,
    window_words: int | None = None,
) -> DataFrame:
    """Score with any classifier; the model is loaded once per Python worker task.

    ``load_model`` must be picklable and returns a function from texts to
    ``(label, score)`` pairs.  Rows outside ``only`` are sent as NULL, so their
    text is not shipped.  Models with a bounded input pass ``window_words``:
    texts are scored window by window, to the end, never cut off.
    """

    @F.pandas_udf("label string, score double")
    def scorer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            wanted = batch.dropna()
            pairs = _classify(wanted.tolist(), model, window_words)
            found = pd.DataFrame(pairs, columns=["label", "score"], index=wanted.index)
            yield found.reindex(batch.index).astype({"label": object, "score": "float64"})

    masked = F.col(text) if only is None else F.when(only, F.col(text))
    scored = df.withColumn("_scored", scorer(masked))
    return scored.withColumns({label: F.col("_scored.label"), score: F.col("_scored.score")}).drop("_scored")
