"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without blanks at its ends and with A-Z lower-cased.
Keys of at least 20 code points count; a key is known by two 64-bit hashes.

The known keys live in sorted runs.  A new batch of keys is merged against the
runs: keys in none of them are fresh and become a run of their own at level 0,
the others are repeats.  So a key stands in one run only.  When a level holds
``fan`` runs they are compacted into one sorted run of the next level, which
keeps the number of runs to probe at the logarithm of the batches.

Documents arrive in batches from the largest id down, so the run that holds a
key also holds its owner, the largest document with that line, and later
batches only ever add repeats.  A key with repeats in ``min_docs - 1`` other
documents loses its lines everywhere but in the owner.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselabel.llm.tables import unused, written

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 3
#: A key in more than one of so many lines is hot; there are at most as many hot keys.
HOT_SHARE = 1000

_BLANKS = " \t\n\x0b\f\r"
_UPPER, _FOLDED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def text_lines(text: Column) -> Column:
    """Lines of a text, at least one; null counts as empty."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_BLANKS))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _FOLDED))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(row, doc, h1, h2, pos, is_first)`` of every line that counts.

    ``doc`` and ``row`` name the input row, by id and text; ``is_first`` marks the first
    place of a key in its row.  A row's lines are sorted by key inside the row.
    """
    hashed = F.transform(
        text_lines(F.col("text")),
        lambda line, pos: F.struct(line_key(line).alias("k"), (pos + 1).alias("pos")),
    )
    long_enough = F.filter(hashed, lambda x: F.length(x["k"]) >= min_chars)
    keys = F.array_sort(
        F.transform(
            long_enough,
            lambda x: F.struct(F.xxhash64(x["k"]).alias("h1"), F.xxhash64(F.lit(1), x["k"]).alias("h2"), x["pos"].alias("pos")),
        )
    )
    rows = docs.select(row_handle().alias("row"), F.col("doc_id").alias("doc"), keys.alias("keys"))

    def with_first(x: Column, i: Column) -> Column:
        before = F.get("keys", i - 1)
        same = (before["h1"] == x["h1"]) & (before["h2"] == x["h2"])
        return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"), (~F.coalesce(same, F.lit(False))).alias("is_first"))

    return rows.select("row", "doc", F.inline(F.transform("keys", with_first)))


def row_handle() -> Column:
    """Tells rows with the same id apart; rows with equal id and text share a handle, which treats them alike."""
    return F.xxhash64("doc_id", "text")


def _rank(doc_id: str) -> Column:
    """The id as a number; rows without one stand below all others."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))


@dataclass
class LineRuns:
    """Levelled sorted runs ``(h1, h2, owner, n_docs)`` in the shared folder."""

    fan: int = 2
    levels: list[list[DataFrame]] = field(default_factory=list)
    repeats: list[DataFrame] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Merge a batch ``(h1, h2, owner, n_docs)``, one row per key, against all runs and add its fresh keys."""
        merged = batch
        known = F.lit(None).cast("long")
        for i, run in enumerate(self.runs()):
            merged = merged.join(run.select(*KEY, F.col("owner").alias(f"owner{i}"), F.lit(True).alias(f"in{i}")), KEY, "left")
        seen = F.coalesce(*(F.col(f"in{i}") for i in range(len(self.runs()))), F.lit(False))
        for i in range(len(self.runs())):
            known = F.coalesce(known, F.col(f"owner{i}"))
        merged = merged.select(*KEY, "n_docs", F.when(seen, known).otherwise(F.col("owner")).alias("owner"), seen.alias("seen"))
        if self.runs():
            merged = written(merged, "line-merge")
            self.repeats.append(merged.where("seen").select(*KEY, "owner", "n_docs"))
        self._put(0, merged.where(~F.col("seen")))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(written(run.select(*KEY, "owner", "n_docs").sortWithinPartitions(*KEY), f"line-run-{level}"))
        if len(self.levels[level]) > self.fan:
            whole = self.levels[level][0]
            for other in self.levels[level][1:]:
                whole = whole.unionByName(other)
            self.levels[level] = []
            self._put(level + 1, whole.repartition(*KEY))

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """``(h1, h2, owner, n_docs)`` of the keys in at least ``min_docs`` documents."""
        counted = None
        for run in self.runs():  # the owner's batch alone may hold more than the owner
            part = run.where("n_docs > 1").select(*KEY, "owner", (F.col("n_docs") - 1).alias("others"))
            counted = part if counted is None else counted.unionByName(part)
        for part in self.repeats:
            counted = counted.unionByName(part.select(*KEY, "owner", F.col("n_docs").alias("others")))
        total = counted.groupBy(*KEY).agg(F.max("owner").alias("owner"), (F.sum("others") + 1).alias("n_docs"))
        return total.where(F.col("n_docs") >= min_docs)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``(doc, row, drops)``: for each row that loses lines, their positions in order, from 1; see ``_rank``."""
    keys = written(line_keys(docs, min_chars), "line-keys")
    doc = _rank("doc")
    cuts = [i / batches for i in range(batches - 1, 0, -1)]
    found = docs.agg(F.percentile_approx("doc_id", cuts).alias("cuts")).first()["cuts"] or []
    lower = sorted({c for c in found if c is not None}, reverse=True) + [-(1 << 63)]
    runs, above = LineRuns(), None
    for low in lower:  # from the largest ids down
        part = keys.where(doc >= low) if above is None else keys.where((doc >= low) & (doc < above))
        runs.add(part.groupBy(*KEY).agg(F.max(doc).alias("owner"), F.sum(F.col("is_first").cast("long")).alias("n_docs")))
        above = low
    repeated = written(runs.repeated(min_docs), "line-repeated")
    # A hot key has over 1/1000 of all lines, so at most 1000 keys are hot, whatever the size: a proven bound.
    bar = max(1, keys.count() // HOT_SHARE)
    hot = F.broadcast(repeated.where(F.col("n_docs") > bar).select(*KEY, "owner"))
    cold = repeated.where(F.col("n_docs") <= bar).select(*KEY, "owner")
    wanted = keys.select("row", doc.alias("doc"), *KEY, "pos")
    hits = wanted.join(hot, KEY).unionByName(wanted.join(hot, KEY, "left_anti").join(cold, KEY))
    return hits.where("doc <> owner").groupBy("doc", "row").agg(F.array_sort(F.collect_set("pos")).alias("drops"))


def kept_lines(lines: Column, drops: Column) -> Column:
    """The lines between the dropped positions, in one pass over both."""
    starts = F.concat(F.array(F.lit(0)), drops)
    ends = F.concat(drops, F.array(F.size(lines) + 1))
    return F.flatten(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.slice(lines, x["a"] + 1, x["b"] - x["a"] - 1)))


def _with_drops(docs: DataFrame, **options) -> tuple[DataFrame, str]:
    """``docs`` with the dropped positions in a column of the returned name, null where nothing is dropped."""
    doc, row, drops = (unused(name, docs) for name in ("doc", "row", "drops"))
    found = dropped_lines(docs, **options).select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("drops").alias(drops))
    marked = docs.withColumn(doc, _rank("doc_id")).withColumn(row, row_handle())
    return marked.join(found, [doc, row], "left").drop(doc, row), drops


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated lines cut from ``text``; all rows and columns stay.

    ``n_chars``, where there, is counted anew for changed texts.  Null texts
    stay null.  Each row counts as a document, so repeated rows make a line
    repeated; all rows with the owner's id keep it.  Rows without an id rank
    below all others.  Empty tables stay empty.
    """
    joined, drops = _with_drops(docs, **options)
    kept = F.concat_ws("\n", kept_lines(text_lines(F.col("text")), F.col(drops)))
    cut = joined.withColumn("text", F.when(F.col(drops).isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        recount = F.when(F.col(drops).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        cut = cut.withColumn("n_chars", recount.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` of every row; see ``dedup_lines``."""
    joined, drops = _with_drops(docs.select("doc_id", "text"), **options)
    lines = text_lines(F.col("text"))
    kept = F.concat_ws("\n", kept_lines(lines, F.col(drops)))
    text = F.when(F.col(drops).isNull(), F.coalesce("text", F.lit(""))).otherwise(kept)
    return joined.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(drops), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(text, 256).alias("kept_sha256"),
    )
