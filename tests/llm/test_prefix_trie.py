"""Trie of conversation prefixes against a plain one."""

import random
from collections import Counter

import pytest
from brute import prefix_trie

from caselabel.llm import prefix_trie as pt

COLUMNS = "conv_id long, turn long, role string, text string"


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(map(tuple, df.collect()))


def talks(n, seed, words="abc", longest=6):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(words)) for c in range(n) for t in range(rng.randrange(1, longest))]


@pytest.fixture
def many_shards(spark):
    """Sessions cut small tables into few shards; this makes them many."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, many_shards, seed):
    rows = talks(60, seed)
    assert found(pt.trie(spark.createDataFrame(rows, COLUMNS))) == Counter(prefix_trie(rows))


def test_one_shard(spark):
    rows = talks(30, 9)
    assert found(pt.trie(spark.createDataFrame(rows, COLUMNS).coalesce(1))) == Counter(prefix_trie(rows))


def test_equal_conversations_lie_in_many_shards(spark, many_shards):
    """A third of all conversations are one; their ids are more than a piece holds."""
    rows = [(c, t, "user", f"hot {t}") for c in range(0, 6000, 5) for t in range(2)] + talks(300, 4, "xyz")
    rows = [r for r in rows if r[0] >= 300 or r[0] % 5]
    df = spark.createDataFrame(rows, COLUMNS)
    ranged = pt.paths(df).repartitionByRange("path", "conv_id")
    assert ranged.rdd.getNumPartitions() > 1
    assert found(pt.trie(df)) == Counter(prefix_trie(rows))


def test_a_long_conversation(spark, many_shards):
    rows = [(c, t, "user", f"t{t}") for c in (5, 10, 15, 20, 7) for t in range(400)] + talks(20, 3)
    rows = list(dict.fromkeys(rows))
    seen = {(r[0], r[1]) for r in rows}
    rows = [r for r in rows if (r[0], r[1]) in seen]
    clean = {}
    for r in rows:
        clean.setdefault((r[0], r[1]), r)
    rows = list(clean.values())
    assert found(pt.trie(spark.createDataFrame(rows, COLUMNS))) == Counter(prefix_trie(rows))


def test_odd_rows(spark, many_shards):
    rows = [
        (5, None, "user", "null turn first"),
        (5, 0, None, None),
        (5, 1, "", ""),
        (6, 0, "user", "é" * 1_000_000),
        (7, 3, "user", "gap"),
        (7, 3, "user", "gap"),
        (-3, 0, "user", "negative id"),
        (None, 0, "user", "no conversation"),
        (8, 0, "ab", "c"),
        (9, 0, "a", "bc"),
    ]
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS + ", path string, shard int")
    assert found(pt.trie(extra)) == Counter(prefix_trie(rows))


def test_empty(spark):
    assert pt.trie(spark.createDataFrame([], COLUMNS)).collect() == []


def test_a_conversation_without_turns_ends_at_the_root(spark):
    ids = [c for c in range(1, 60) if c % 5]
    rows = [(c, 0, "user", "only") for c in ids]  # no family has its first conversation
    out = prefix_trie(rows)
    root = next(r for r in out if r[1] == 0)
    assert root[7] != __import__("hashlib").sha256(b"").hexdigest()
    assert found(pt.trie(spark.createDataFrame(rows, COLUMNS))) == Counter(out)


def test_shared_turns():
    a, b = bytes(range(16)) * 5, bytes(range(16)) * 3 + bytes(16)
    assert [pt.shared(a, a), pt.shared(a, b), pt.shared(a, b""), pt.shared(b, a)] == [5, 3, 0, 3]
