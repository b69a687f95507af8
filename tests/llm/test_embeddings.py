import numpy as np
import pytest
from pyspark.sql import functions as F

from linefit.llm import prefix_forest, product_quantiser, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def clustered(n, width, seed, centres=40):
    random = np.random.default_rng(seed)
    near = random.standard_normal((centres, width))[random.integers(0, centres, n)]
    noise = random.choice([0.02, 0.1, 0.6], (n, 1))
    return (near + noise * random.standard_normal((n, width))).astype(np.float32)


ODD = [
    (90001, None), (90002, [0.0] * 16), (90003, [float("nan")] + [1.0] * 15), (90004, [float("inf")] + [1.0] * 15),
    (90005, [None] + [1.0] * 15), (90006, [1.0, 2.0]), (90007, []),
]


def nearest_brute(rows, chosen, k):
    ids = np.array([i for i, _ in rows])
    data = np.array([v for _, v in rows], np.float64)
    out = {}
    for i in chosen:
        d = np.sqrt(((data - data[ids == i][0]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_search_of_a_small_block_is_exact(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(400, 16, 1))]
    rows[30] = (30, rows[0][1])
    rows[31] = (31, rows[0][1])
    out = prefix_forest.nearest(frame(spark, rows + ODD), F.col("vec_id") % 100 == 0).collect()
    wanted = nearest_brute(rows, [0, 100, 200, 300], 10)
    assert len(out) == 40
    for r in out:
        found, score = wanted[r["query_id"]][r["rank"] - 1]
        assert r["vec_id"] == found and r["score"] == pytest.approx(score, abs=1e-12)


def test_recall_over_blocks_and_rounds(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(4000, 16, 2))]
    out = prefix_forest.nearest(
        frame(spark, rows), F.col("vec_id") % 50 == 0, block=1000, enough=300, queries_at_once=30
    ).collect()
    wanted = nearest_brute(rows, range(0, 4000, 50), 10)
    assert len(out) == 800
    hits = sum(r["vec_id"] in dict(wanted[r["query_id"]]) for r in out)
    assert hits / 800 >= 0.9


def test_longest_prefixes_come_first():
    data = clustered(500, 16, 3).astype(np.float64)
    forest = prefix_forest.Forest(data, trees=4)
    for i, near in zip(range(20), forest.candidates(data[:20], 30)):
        assert i in near and 30 <= len(near) <= 500
    assert all(len(x) == 500 for x in forest.candidates(data[:2], 10_000))


def test_search_of_nothing(spark):
    assert prefix_forest.nearest(frame(spark, []), F.lit(True)).collect() == []
    assert prefix_forest.nearest(frame(spark, ODD), F.lit(True)).collect() == []
    few = prefix_forest.nearest(frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]), F.lit(True)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few) == [(1, 1, 2), (2, 1, 1)]


def test_search_query_recall(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    out = queries.op2_prefix_forest(spark, folder).collect()
    wanted = nearest_brute(rows, [i for i, _ in rows if i % 100 == 0], 10)
    hits = sum(r["vec_id"] in dict(wanted[r["query_id"]]) for r in out)
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def links_brute(rows, threshold):
    ids = [i for i, _ in rows]
    data = np.array([v for _, v in rows], np.float64)
    data /= np.linalg.norm(data, axis=1)[:, None]
    near = data @ data.T >= threshold
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))
    while True:
        new = [min([root[j] for j in np.flatnonzero(near[i])] + [root[i]], key=lambda r: ids[r]) for i in range(len(ids))]
        if new == root:
            break
        root = new
    return {ids[i]: (int(near[i].sum()), ids[root[i]]) for i in range(len(ids))}


def agree(out, wanted):
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
    assert {r["vec_id"] for r in out if r["kept"]} == {i for i, (_, c) in found.items() if i == c}
    assert found == wanted


def test_links_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(product_quantiser, "MEMBERS", 64)  # a hot list is many blocks
    monkeypatch.setattr(product_quantiser, "VISITORS", 100)
    rows = [(i * 3, v.tolist()) for i, v in enumerate(clustered(600, 16, 4))]
    random = np.random.default_rng(9)
    rows += [(5000 + i, (np.ones(16) + 0.05 * random.standard_normal(16)).tolist()) for i in range(250)]
    rows += [(7000 + i, rows[0][1]) for i in range(20)]
    wanted = links_brute([(i, np.array(v, np.float32)) for i, v in rows], 0.95)
    wanted |= {i: (0, i) for i, _ in ODD}
    agree(product_quantiser.near_duplicates(frame(spark, rows + ODD)).collect(), wanted)


def test_links_of_nothing(spark):
    assert product_quantiser.near_duplicates(frame(spark, [])).collect() == []
    agree(product_quantiser.near_duplicates(frame(spark, ODD[:3])).collect(), {i: (0, i) for i, _ in ODD[:3]})
    agree(product_quantiser.near_duplicates(frame(spark, [(4, [2.0, 0.0]), (2, [1.0, 0.0])])).collect(),
          {4: (1, 2), 2: (1, 2)})


def test_link_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    agree(queries.op3_product_quantiser(spark, folder).collect(), links_brute(rows, 0.95))


def test_near_neighbours_are_found_among_few_rows(spark):
    """Groups of vectors far from each other: a small part of all rows is measured."""
    random = np.random.default_rng(11)
    centres = random.standard_normal((1500, 32))
    data = np.repeat(centres, 12, axis=0) + 0.05 * random.standard_normal((18_000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(data.astype(np.float32))]
    out = prefix_forest.nearest(frame(spark, rows), F.col("vec_id") % 200 == 0, measured=True).collect()
    wanted = nearest_brute(rows, range(0, 18_000, 200), 10)
    hits = sum(r["vec_id"] in dict(wanted[r["query_id"]]) for r in out)
    assert hits >= 0.95 * 900
    share = np.mean([r["measured"] for r in out if r["rank"] == 1]) / len(rows)
    assert share <= 0.06
