"""Similarity join of two columns of labels by edit distance, with an index of q-grams.

Two labels are similar when ``functions.labels.similarity`` is above a bar.  That
allows them few edits, and an edit spoils few q-grams, which gives three filters
that lose no pair:

* **Prefix.**  With at most d edits, one of the first ``q * d + 1`` q-grams of a label,
  in any order that both sides share, is among the first ones of the other.  The
  rarest come first, so the lists that meet are short.
* **Length.**  Lengths differ by d at most.
* **Position.**  The shared q-gram moves by d places at most.

What is left is compared letter by letter.  Labels are made distinct first; no
side is broadcast by hint or held in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel.functions import labels as lb

#: The lowest bar for which the prefixes of two-grams are long enough for labels of any length.
LOWEST = 67


def _distance(longest: Column, min_score: int) -> Column:
    """Most edits with which a similarity, rounded to whole percents, is still above ``min_score``.

    ``100 * (1 - d / n)`` has to reach ``min_score + 0.5``.
    """
    return F.floor(F.lit(199 - 2 * min_score) * longest / F.lit(200) + F.lit(1e-9)).cast("int")


def _longest_partner(length: Column, min_score: int) -> Column:
    """Length of the longest label that can still be similar to one of ``length``."""
    return F.floor(F.lit(200) * length / F.lit(1 + 2 * min_score)).cast("int")


def _tokens(labels: DataFrame, min_score: int) -> DataFrame:
    """``(label, size, most, gram, place)``: the q-grams of each label and the edits it may have at most."""
    q = 3 if min_score >= 75 else 2
    pad = F.lit("\u0001" * (q - 1))
    size = F.length("label")
    padded = F.concat(pad, F.col("label"), pad)
    rows = labels.select("label", size.alias("size"), _distance(_longest_partner(size, min_score), min_score).alias("most"), padded.alias("padded"))
    cut = F.transform(F.sequence(F.lit(1), F.col("size") + q - 1), lambda i: F.struct(i.alias("place"), F.substr(F.col("padded"), i, F.lit(q)).alias("gram")))
    return rows.select("label", "size", "most", F.explode(cut).alias("g")).select("label", "size", "most", "g.gram", "g.place")


def _prefixes(tokens: DataFrame, frequency: DataFrame, min_score: int) -> DataFrame:
    """The first q-grams of each label, rarest first: as many as the edits it may have can spoil, and one more.

    A q-gram that the cut would part from others of its kind in the label takes
    them along: which of them is the other label's can't be told.
    """
    q = 3 if min_score >= 75 else 2
    ranked = tokens.join(frequency, "gram").groupBy("label", "size", "most")
    first = ranked.agg(F.array_sort(F.collect_list(F.struct("n", "gram", "place"))).alias("t"))
    first = first.withColumn("last", F.get("t", F.least(F.col("most") * q, F.size("t") - 1)))
    bar = F.struct(F.col("last.n"), F.col("last.gram"))
    kept = F.filter("t", lambda x: F.struct(x["n"], x["gram"]) <= bar)
    return first.select("label", "size", F.explode(kept).alias("t")).select("label", "size", "t.gram", "t.place")


def _distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("label")).where(F.col("label").isNotNull()).distinct()


def candidate_pairs(left: DataFrame, right: DataFrame, min_score: int) -> DataFrame:
    """Distinct ``(left, right)`` labels that the filters can't rule out; ``left`` and ``right`` have a column ``label``."""
    if min_score < LOWEST or min_score > 99:
        raise ValueError(f"the bar must lie between {LOWEST} and 99")
    ours, theirs = _tokens(left, min_score), _tokens(right, min_score)
    count = F.count(F.lit(1)).alias("n")
    frequency = ours.select("gram").unionByName(theirs.select("gram")).groupBy("gram").agg(count)
    a = _prefixes(ours, frequency, min_score).select(F.col("label").alias("left"), F.col("size").alias("a"), "gram", F.col("place").alias("p"))
    b = _prefixes(theirs, frequency, min_score).select(F.col("label").alias("right"), F.col("size").alias("b"), "gram", F.col("place").alias("r"))
    most = _distance(F.greatest("a", "b"), min_score)
    near = (F.abs(F.col("a") - F.col("b")) <= most) & (F.abs(F.col("p") - F.col("r")) <= most)
    return a.join(b, "gram").where(near).select("left", "right").distinct()


def similar_pairs(left: DataFrame, left_column: str, right: DataFrame, right_column: str, min_score: int = 85) -> DataFrame:
    """``(left, right, score)`` of all pairs of distinct labels with a similarity above ``min_score``.

    NULL is similar to nothing, an empty label to an empty one only.
    """
    pairs = candidate_pairs(_distinct(left, left_column), _distinct(right, right_column), min_score)
    scored = pairs.withColumn("score", lb.similarity(F.col("left"), F.col("right")))
    return scored.where(F.col("score") > min_score)


def best_matches(left: DataFrame, left_column: str, right: DataFrame, right_column: str, min_score: int = 85, missing: str = "No match found") -> DataFrame:
    """Each distinct label of ``left`` with its most similar one of ``right``: ``(left_column, match, score)``.

    Ties go to the match that sorts first; labels without one above ``min_score``
    get ``missing`` and no score.
    """
    pairs = similar_pairs(left, left_column, right, right_column, min_score)
    best = pairs.groupBy("left").agg(F.min_by("right", F.struct(-F.col("score"), F.col("right"))).alias("match"), F.max("score").alias("score"))
    ours = _distinct(left, left_column).withColumnRenamed("label", "left").join(best, "left", "left")
    return ours.select(F.col("left").alias(left_column), F.coalesce("match", F.lit(missing)).alias("match"), "score")
