"""Category labels: spelling, flags, class buckets and code lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions.text import BLANK


def normalize_label(label: Column) -> Column:
    """Trim blanks of every kind, upper-case and drop the accent of vowels; inner blanks stay."""
    bare = F.regexp_replace(label, rf"^{BLANK}+|{BLANK}+$", "")
    return F.translate(F.upper(bare), "ÁÉÍÓÚ", "AEIOU")


def agreement(left: Column, right: Column) -> Column:
    """``OK`` when both labels are known and equal, else ``CHECK``."""
    return F.when(left == right, "OK").otherwise("CHECK")


def same_length_flag(left_words: Column, right_words: Column) -> Column:
    """``IGUAL`` when two narratives have the same number of words."""
    return F.when(left_words == right_words, "IGUAL").otherwise("DIFERENTE")


def bucket_other(label: Column, keep: Iterable[str], other: str = vocab.OTHER) -> Column:
    """Labels outside ``keep`` become ``other``; NULL becomes ``other`` as well."""
    return F.when(label.isin(*keep), label).otherwise(other)


def fold_into(label: Column, minor: Iterable[str], other: str = vocab.OTHER) -> Column:
    """Only the listed minor labels become ``other``."""
    return F.when(label.isin(*minor), other).otherwise(label)


def case_text(code: Column, texts: Mapping[int, str], default: str) -> Column:
    """Text of a coded value, ``default`` for unknown codes and NULL."""
    out = None
    for value, text in texts.items():
        out = F.when(code == value, text) if out is None else out.when(code == value, text)
    return out.otherwise(default)


def stage_text(code: Column) -> Column:
    """Procedural stage of a coded stage."""
    return case_text(code, vocab.STAGES, vocab.NO_STAGE)


def state_text(state: Column) -> Column:
    """Procedural state, with the fixed text for cases that have none."""
    return F.coalesce(state, F.lit(vocab.NO_STATE))


def yes_no(flag: Column, no_value: str = "N") -> Column:
    """``No`` for the given flag value, ``Si`` for everything else."""
    return F.when(flag == no_value, "No").otherwise("Si")


def one_hot(label: Column, classes: Iterable[str], prefix: str = "is_") -> list[Column]:
    """One 0/1 column per class, in class order."""
    return [
        F.when(label == c, 1).otherwise(0).cast("int").alias(f"{prefix}{i}")
        for i, c in enumerate(classes)
    ]


def similarity(left: Column, right: Column) -> Column:
    """Edit similarity in percent, ``round(100 * (1 - distance / longer length))``."""
    longest = F.greatest(F.length(left), F.length(right))
    ratio = 1 - F.levenshtein(left, right) / longest
    return F.when(longest == 0, 100).otherwise(F.round(100 * ratio)).cast("int")


def best_match(label: Column, targets: Iterable[str], min_score: int = 85, missing: str = "No match found") -> Column:
    """Struct ``(match, score)``: most similar target, accepted above ``min_score``.

    Ties go to the target that sorts first.  The targets are a closed list held
    in the expression, so no pairs of rows are ever formed.
    """
    ranked = sorted(set(targets))
    scored = F.array(
        *[
            F.struct(similarity(label, F.lit(t)).alias("score"), F.lit(-i).alias("rank"), F.lit(t).alias("target"))
            for i, t in enumerate(ranked)
        ]
    )
    best = F.array_max(scored)
    accepted = best["score"] > min_score
    return F.struct(
        F.when(accepted, best["target"]).otherwise(missing).alias("match"),
        best["score"].alias("score"),
    )
