"""Counts, shares, pivots, profiles and distribution statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caselabel.operators.keys import key_difference


def category_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per known label, most frequent first: ``(label, total)``."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(label).alias("total")).where(F.col("total") > 0)
    return counts.orderBy(F.desc("total"), "label")


def category_summary(df: DataFrame, label: str) -> DataFrame:
    """Known and missing labels of a column in one row."""
    return df.agg(
        F.count(label).alias("labelled"),
        F.count_if(F.col(label).isNull()).alias("missing"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def group_count(df: DataFrame, groups: list[str], key: str) -> DataFrame:
    """Known keys per group."""
    return df.groupBy(*groups).agg(F.count(key).alias("total"))


def group_sum_sorted(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Sum per group, largest first."""
    return df.groupBy(group).agg(F.sum(measure).alias("total")).orderBy(F.desc("total"), group)


def count_distinct_keys(df: DataFrame, group: str, key: str, approximate: bool = False) -> DataFrame:
    """Distinct keys per group; a sketch instead of exact counts on request."""
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.groupBy(group).agg(count.alias("n_keys"))


def share_text(part: Column, whole: Column) -> Column:
    """Percentage with two decimals as text, like ``12.50%``."""
    percent = F.try_divide(100 * part.cast("decimal(20,0)"), whole.cast("decimal(20,0)"))
    return F.concat(F.round(percent, 2).cast("decimal(7,2)").cast("string"), F.lit("%"))


def category_share(df: DataFrame, label: str, key: str) -> DataFrame:
    """Known keys per label with their share of all, most frequent first.

    The window runs over the counted labels, one row per label.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(key).alias("total"))
    whole = F.sum("total").over(W.partitionBy())
    return counts.withColumn("percentage", share_text(F.col("total"), whole)).orderBy(F.desc("total"), "label")


def share_of_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition, and their percentage of all rows."""
    return df.agg(
        F.count_if(condition).alias("matching"),
        F.count(F.lit(1)).alias("n_rows"),
        (100.0 * F.avg(F.when(condition, 1.0).otherwise(0.0))).alias("share_pct"),
    )


def filtered_counts(df: DataFrame, source: str, text: str, words: str, threshold: int = 50) -> DataFrame:
    """Long, short and empty narratives per source in one pass."""
    return df.groupBy(source).agg(
        F.count_if(F.col(words) > threshold).alias("above"),
        F.count_if(F.col(words) < threshold).alias("below"),
        F.count_if(F.coalesce(F.col(text), F.lit("")) == "").alias("empty_text"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def pivot_counts(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Crosstab with a column per given value; absent combinations count 0."""
    return df.groupBy(rows).agg(
        *[F.count_if(F.col(columns).eqNullSafe(v)).alias(str(v)) for v in values]
    )


def pivot_margins(
    df: DataFrame, rows: str, columns: str, values: list, measures: dict[str, Column], total: str = "TOTAL"
) -> DataFrame:
    """Measures by row label and column value, with ``TOTAL`` margins on both axes.

    ``values`` is the closed list of column values.  Columns are named
    ``<measure>_<value>`` and ``<measure>_TOTAL``.  ``measures`` are sums or
    counts of expressions over the row; they are aggregated once per
    (row label, column value) and the margins are sums of those.
    """
    cells = df.groupBy(F.col(rows).alias("label"), F.col(columns).alias("_c")).agg(
        *[expr.alias(name) for name, expr in measures.items()]
    )
    wide = cells.rollup("label").agg(
        F.grouping("label").alias("_total"),
        *[
            F.coalesce(F.sum(F.when(F.col("_c") == v, F.col(m))), F.lit(0)).alias(f"{m}_{v}")
            for m in measures
            for v in values
        ],
        *[F.coalesce(F.sum(m), F.lit(0)).alias(f"{m}_{total}") for m in measures],
    )
    named = wide.withColumn("label", F.when(F.col("_total") == 1, total).otherwise(F.col("label")))
    return named.drop("_total")


def crosstab_sorted(df: DataFrame, label: str, total: str = "TOTAL") -> DataFrame:
    """Largest ``TOTAL`` first, the ``TOTAL`` row itself last."""
    return df.orderBy((F.col(label) == total).asc(), F.desc(total), label)


def min_max_dates(df: DataFrame, date: str) -> DataFrame:
    """First and last date."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def first_seen_and_cutoff(df: DataFrame, events: DataFrame, key: str, date: str) -> DataFrame:
    """First event date of each key, and the latest date of all events, as columns.

    The cutoff is a scalar subquery, so nothing is joined to get it.
    """
    first = events.groupBy(key).agg(F.min(date).alias("first_seen"))
    cutoff = events.select(F.max(date)).scalar()
    return df.join(first, key, "left").withColumn("cutoff", cutoff)


def max_text_len(df: DataFrame, group: str, words: Column) -> DataFrame:
    """Longest text per group, in words."""
    return df.groupBy(group).agg(F.max(words).alias("max_words"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, long form, with the table's row count."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column_name string, nulls bigint, n_rows bigint")
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls"), F.col("_rows").alias("n_rows"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct known values with their copies: the compact form of a distribution."""
    return df.groupBy(F.col(column).alias("x")).agg(F.count(column).alias("n")).where(F.col("n") > 0)


def _quantile(counts_column: str, at: float, approximate: bool) -> Column:
    if approximate:
        return F.percentile_approx(counts_column, at)
    return F.percentile(counts_column, at, F.col("n"))


def _ordered_bits(x: Column) -> Column:
    """A long that sorts as the double does: its bits, those below the sign turned round for negative numbers."""
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("bigint")
    return F.transform(F.array(bits), lambda b: b.bitwiseXOR(F.shiftright(b, 63).bitwiseAND(F.lit(2**63 - 1))))[0]


def exact_quantiles(df: DataFrame, column: str, at: dict[str, float]) -> DataFrame:
    """One row with a double per entry of ``at`` (name to share), interpolated between neighbours as ``percentile`` does.

    Radix selection: a rank is narrowed down by 16 bits of the ordered value at a
    time.  Each of four passes counts the rows by the next 16 bits among those
    that share the bits found so far, which Spark combines before the shuffle, and
    a running sum over these counts, 65 536 a rank at most, gives the next bits.
    No value is shuffled or sorted, so a column with as many values as rows
    needs no more memory than one with few.  All values are taken as doubles.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    values = values.select("x", _ordered_bits(F.col("x")).alias("b"))
    spots = [(name, side, share) for name, share in at.items() for side in ("low", "high")]
    total = F.col("total") - 1
    ends = [F.floor(total * share) if side == "low" else F.ceil(total * share) for _, side, share in spots]
    ranks = F.array(*[F.struct(F.lit(i).alias("spot"), e.cast("bigint").alias("rank")) for i, e in enumerate(ends)])
    # Two ranks per quantile: a scalar at first, then as many rows, whatever the table's size.
    asked = values.agg(F.count(F.lit(1)).alias("total")).select(F.struct("total", ranks.alias("ranks"))).scalar()
    wanted = None
    running = W.partitionBy("spot").orderBy("digit").rowsBetween(W.unboundedPreceding, -1)
    for level in range(4):
        shift = 48 - 16 * level
        digit = F.shiftright("b", shift) if level == 0 else F.shiftright("b", shift).bitwiseAND(F.lit(0xFFFF))
        prefix = F.lit(0).cast("bigint") if level == 0 else F.shiftright("b", shift + 16)
        rows = values.select("x", prefix.alias("bits"), digit.alias("digit"))
        if level:
            rows = rows.join(F.broadcast(wanted.select("bits").distinct()), "bits", "left_semi")
        counts = rows.groupBy("bits", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"))
        before = F.coalesce(F.sum("n").over(running), F.lit(0))
        if wanted is None:
            placed = counts.withColumn("_asked", asked).select("bits", "digit", "n", "x", "_asked.total", F.inline("_asked.ranks"))
        else:
            placed = counts.join(F.broadcast(wanted.drop("x")), "bits")
        placed = placed.withColumn("before", before)
        hit = placed.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        bits = F.col("digit") if level == 0 else F.shiftleft("bits", 16).bitwiseOR(F.col("digit"))
        wanted = hit.select("total", "spot", (F.col("rank") - F.col("before")).alias("rank"), bits.alias("bits"), "x")
    found = wanted.agg(
        F.max("total").alias("total"), *[F.max(F.when(F.col("spot") == i, F.col("x"))).alias(f"v{i}") for i in range(len(spots))]
    )
    names = list(at)
    parts = [total * at[name] - F.floor(total * at[name]) for name in names]
    return found.select(
        *[(F.col(f"v{2 * i}") + (F.col(f"v{2 * i + 1}") - F.col(f"v{2 * i}")) * parts[i]).alias(name) for i, name in enumerate(names)]
    )


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def describe(df: DataFrame, column: str, approximate: bool = False, distinct: str = "few") -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum.

    Exact quartiles of a column with ``few`` distinct values (word counts: at most
    the longest text) are taken from these with their copies, in one aggregate;
    those of a column with ``many`` come from ``exact_quantiles``, which holds no
    list of values anywhere but reads the column five times.  ``approximate``
    takes them from a sketch.
    """
    if distinct not in ("few", "many"):
        raise ValueError("distinct is few or many")
    if approximate or distinct == "many":
        basis, x = df.where(F.col(column).isNotNull()), column
        stats = [F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)]
    else:
        basis, x = value_counts(df, column), "x"
        n, s, q = F.sum("n"), F.sum(F.col("x") * F.col("n")), F.sum(F.col("x") * F.col("x") * F.col("n"))
        mean = s / n
        variance = F.try_divide(q - s * mean, n - 1)
        stats = [F.coalesce(n, F.lit(0)), mean, F.sqrt(F.greatest(variance, F.lit(0.0))), F.min("x"), F.max("x")]
    named = [s.alias(n) for s, n in zip(stats, ["n", "mean", "std", "min", "max"])]
    if distinct == "many" and not approximate:
        quarters = exact_quantiles(df, column, QUARTILES).select(F.struct(*QUARTILES).alias("q")).scalar()
        return basis.agg(*named).withColumn("_q", quarters).select("*", "_q.*").drop("_q")
    return basis.agg(*named, *[_quantile(x, q, approximate).cast("double").alias(name) for name, q in QUARTILES.items()])


def boxplot_stats(df: DataFrame, column: str, approximate: bool = False, distinct: str = "few") -> DataFrame:
    """Quartiles, spread and fences; only the lower fence is clamped to the data.

    See ``describe`` for ``approximate`` and ``distinct``.
    """
    iqr = F.col("q3") - F.col("q1")
    return describe(df, column, approximate, distinct).select(
        "q1",
        "median",
        "q3",
        iqr.alias("iqr"),
        F.greatest(F.col("q1") - 1.5 * iqr, F.col("min").cast("double")).alias("lower_fence"),
        (F.col("q3") + 1.5 * iqr).alias("upper_fence"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins ``(bin, low, high, n)``; empty bins are absent.

    The range is a scalar subquery over the counted values, not a join.
    """
    counted = value_counts(df, column).select(F.col("x").cast("double").alias("x"), F.col("n").alias("c"))
    ends = counted.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    ranged = counted.withColumn("_ends", ends).select(
        "x", "c", F.col("_ends.lo").alias("lo"), ((F.col("_ends.hi") - F.col("_ends.lo")) / bins).alias("width")
    )
    position = F.when(F.col("width") == 0, 0).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    )
    return (
        ranged.groupBy(position.cast("int").alias("bin"), "lo", "width")
        .agg(F.sum("c").alias("n"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("low"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("high"),
            "n",
        )
    )


def top_k_categories(df: DataFrame, label: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent labels."""
    return category_counts(df, label).limit(k)


def lowest_confidence(df: DataFrame, label: str, value: str, score: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` least certain cases of a class."""
    return df.where(F.col(label) == value).orderBy(score, key).limit(n)


def label_set_diff(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """Labels used on the left but not on the right."""
    return key_difference(left, right, label)
