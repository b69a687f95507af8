import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from linefit.llm import queries, simhash
from linefit.llm.components import components


def reference(text):
    """The definition, word by word."""
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words, word = [], b""
    for b in data + b" ":
        if b == 0x20 or 0x09 <= b <= 0x0D:
            if word:
                words.append(word)
            word = b""
        else:
            word += bytes([b])
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps):
    """Smallest key of each key's component, from all pairs."""
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    items = sorted(fps.items())
    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            if (x ^ y).bit_count() <= 3:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: find(k) for k in fps}


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "one", "One TWO", "a b c", "a b c d e", "ÀB ä\x0bx\x1cy z q", "w " * 700,
    "x y z w", "The cat sat on the mat. " * 20,
])
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint(text) == reference(text)


def linked(spark, fps, most):
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    edges, _ = simhash.linked_fingerprints(frame, 3, most)
    nodes, _ = components(edges)
    found = {r["node"]: r["component"] for r in nodes.collect()}
    groups = defaultdict(set)
    for x in fps:
        signed = x - (1 << 64) if x >> 63 else x
        groups[found.get(signed, signed)].add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("most", [16, 512])
def test_links_equal_all_pairs_even_in_large_groups(spark, most):
    random.seed(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = random.getrandbits(64)
        fps.add(centre)
        for _ in range(8):
            x = centre
            for _ in range(random.randint(1, 5)):
                x ^= 1 << random.randrange(64)
            fps.add(x)
    hot = random.getrandbits(64)  # one half common to very many
    fps |= {hot ^ (random.getrandbits(9) << 40) for _ in range(300)}
    number = dict(enumerate(sorted(fps)))
    least, groups = brute(number), defaultdict(list)
    for k, x in number.items():
        groups[least[k]].append(x)
    assert linked(spark, sorted(fps), most) == sorted(map(sorted, groups.values()))


def test_distance_beyond_the_keys_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(spark.createDataFrame([(1,)], "fp long"), 4)


def check(rows, texts):
    fps = {k: reference(t) for k, t in texts}
    least = brute(fps)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (k, f"{fps[k]:016x}", least[k]) for k in fps
    }
    assert len(rows) == len(texts)


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check(queries.op8_simhash(spark, folder).collect(), [(r["doc_id"], r["text"]) for r in docs])


def test_odd_rows(docs_of):
    long = "the quick brown fox jumps over a lazy dog " * 400
    rows = [(7, None), (3, ""), (9, long), (8, long + "x"), (2, "a b"), (2, "a b"), (11, " ")]
    check(simhash.near_duplicates(docs_of(rows)).collect(), rows)
    nulls = simhash.near_duplicates(docs_of([(None, "q r s"), (None, "q r s"), (4, "q r s")])).collect()
    assert {r["component_id"] for r in nulls} == {4} and len(nulls) == 3
    assert simhash.near_duplicates(docs_of([])).collect() == []


def test_components_of_chains_and_hubs(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    random.shuffle(edges)
    nodes, _ = components(spark.createDataFrame(edges, "a long, b long"))
    found = {r["node"]: r["component"] for r in nodes.collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 560)}, 9: 8}
    assert components(spark.createDataFrame([], "a long, b long"))[0].collect() == []
