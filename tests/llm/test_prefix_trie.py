import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from linefit.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        base = convs.get(c - int(np.fmod(c, 5)), [])
        out[c] = base[:h] + own[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out, below = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        members, children = nodes[path], below.get(path, [])
        own = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        ends = [c for c in sorted(members) if len(convs[c]) == len(path)]
        out[path] = {
            "conv_id": min(members), "depth": len(path), "n_convs": len(members),
            "parent_conv_id": min(nodes[path[:-1]]) if path else None, "n_children": len(children),
            "n_leaves": sum(k["n_leaves"] for k in children) or 1, "saved_tokens": own + sum(k["saved_tokens"] for k in children),
            "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
        if path:
            below.setdefault(path[:-1], []).append(out[path])
    return sorted((tuple(v[c] for c in COLUMNS) for v in out.values()), key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_prefix_trie(spark, folder)) == brute(rebuilt(sequences(rows)))


def chats(seed, convs=60, most=12):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, most)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "system", rng.choice(["a", "bé", ""]) if t < 5 else "x"))
    return rows


def test_general_trie(spark):
    rows = chats(1)
    frame = spark.createDataFrame(rows, SCHEMA)
    out, _ = prefix_trie.turns(frame)
    assert found(prefix_trie.trie(out)) == brute(sequences(rows))


@pytest.mark.parametrize("shard", [3, 40])
def test_conversations_cut_between_tasks_and_shards(spark, monkeypatch, shard):
    """One conversation holds most rows, some of its prefixes belong to others, ids come in lists."""
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    monkeypatch.setattr(prefix_trie, "IDS", 2)
    monkeypatch.setattr(prefix_trie, "HEAVY", 4)
    long = [(30, t, "user", f"t{t % 3}") for t in range(150)]
    rows = chats(2, 40) + [r for r in long] + [(31, t, "user", f"t{t % 3}") for t in range(70)]
    rows = [r for r in rows if r[0] not in (30, 31) or r in long or r[3].startswith("t")]
    rows += [(100 + i, 0, "user", "hot") for i in range(30)] + [(200, t, "user", f"t{t % 3}") for t in range(110)]
    frame = spark.createDataFrame(rows, SCHEMA)
    out, _ = prefix_trie.turns(frame.repartition(5))
    assert found(prefix_trie.trie(out)) == brute(sequences(rows))
    assert found(prefix_trie.trie(queries.rebuilt(out))) == brute(rebuilt(sequences(rows)))


def test_odd_rows(spark):
    rows = [
        (-7, 0, "user", "a"), (-5, 0, "user", "b"), (-5, 1, None, None), (0, None, "user", "first"), (0, 3, "user", "z"),
        (0, 3, "assistant", "z"), (1, 0, "user", "same"), (1, 0, "user", "same"), (2, 0, "", ""), (2, 0, None, None),
        (None, 0, "user", "no id"), (4, 2, "user", "é" * 100_000), (6, 0, "user", "only"), (13, 0, "user", "only"),
        *[(20, t, "user", str(t)) for t in range(12)], *[(21, t, "user", "y") for t in range(3)],
    ]
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", depth long, `a.b` string")
    out, _ = prefix_trie.turns(frame)
    assert found(prefix_trie.trie(out)) == brute(sequences(rows))
    assert found(prefix_trie.trie(queries.rebuilt(out))) == brute(rebuilt(sequences(rows)))


def test_empty(spark):
    out, _ = prefix_trie.turns(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.trie(out).collect() == []
    out, _ = prefix_trie.turns(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))
    assert prefix_trie.trie(queries.rebuilt(out)).collect() == []


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    digests = np.unique(rng.integers(0, 2**63, (5000, 2)).astype(np.uint64), axis=0)
    slots = prefix_trie.Slots(digests)
    assert sorted(slots.find(digests)) == list(range(len(digests)))
    others = digests + np.array([1, 0], np.uint64)
    known = {tuple(d) for d in digests.tolist()}
    assert all(s < 0 for s, d in zip(slots.find(others), others.tolist()) if tuple(d) not in known)


def test_equal_digests_of_different_prefixes_end_the_job(spark):
    rows = [(1, 1, 0, 5, 6, 3), (2, 1, 0, 5, 6, 4)]  # same hashes, different lengths
    marks = [(c, 0, -1, 0, 0, 0) for c in (1, 2)]
    frame = spark.createDataFrame(marks + rows, "conv long, kind int, nth long, a long, b long, bytes long")
    with pytest.raises(Exception, match="share a digest"):
        prefix_trie.trie(frame).collect()


def test_powers():
    powers = prefix_trie.Powers(prefix_trie.STEPS[0])
    at = np.array([0, 1, 4095, 4096, 70_000, 1_000_000])
    assert [int(x) for x in powers.of(at)] == [pow(prefix_trie.STEPS[0], int(e), 1 << 64) for e in at]


def test_hot_conversations_are_counted_before_they_are_shuffled(spark):
    frame = spark.createDataFrame(chats(3), SCHEMA)
    out, _ = prefix_trie.turns(frame)
    paths, _ = prefix_trie.prefixes(out)
    ends = paths.groupBy("conv").agg(F.max_by("p1", "depth").alias("p1"), F.max_by("p2", "depth").alias("p2"), F.max("depth").alias("depth"))
    plan = prefix_trie.nodes_of(paths, ends)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
