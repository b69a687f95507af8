import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from linefit.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def word_counts(rows):
    n = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(rows):
    n = word_counts(rows)
    holes = {}
    for w in n:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)  # one letter replaced
    near = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1:]] - {w}
            shorter = w[:i] + w[i + 1:]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def texts_of(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    wanted = brute(texts_of(spark, folder))
    assert sum(v[0] is not None for v in wanted.values()) >= 5
    assert found(queries.op11_spelling(spark, folder)) == wanted


def test_many_cells(spark, docs_of, monkeypatch):
    """Small cells, some of them dealt over parts, and a sample that is not all words."""
    monkeypatch.setattr(spelling, "SAMPLE", 600)
    monkeypatch.setattr(spelling, "CELL", 200)
    monkeypatch.setattr(spelling, "MOST", 150)
    monkeypatch.setattr(spelling, "LEAF", 8)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.choice([7, 7, 7, 8, 9]))) for _ in range(1500)]
    rows = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=400))) for i in range(60)]
    chain = "aaaaaaa " * 120 + "aaaaaab " * 11 + "aaaaabb"
    rows += [(100 + i, chain) for i in range(30)] + [(200, "aaaabbb aaaabbb")]
    wanted = brute(rows)
    assert any(v[1] != v[0] and v[0] for v in wanted.values())  # some chain is longer than one step
    assert found(spelling.variants(docs_of(rows))) == wanted


def test_odd_rows(spark):
    long_word = "ab" * 40_000
    rows = [
        (1, "Straße straße STRASSE ÉCOLES éCOLES écoles"), (1, "Straße straße STRASSE ÉCOLES éCOLES écoles"),
        (None, "letters letters letterz"), (None, None), (2, ""), (3, "×××××××÷ ×××××××÷ x"),
        (4, f"{long_word} {long_word}x {long_word}"), (5, f"{long_word}x 中文中文中文中文"),
        *[(10 + i, "correct") for i in range(25)], (40, "corrrect"), (41, "corrrect"), (42, "correkt correkt"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, `a.b` long")
    assert found(spelling.variants(frame)) == brute(rows)


def test_empty(spark, docs_of):
    assert spelling.variants(docs_of([])).collect() == []
    assert spelling.variants(docs_of([(1, "a b c")])).collect() == []


def test_tree_finds_all_pairs_one_edit_apart():
    rng = np.random.default_rng(0)
    words = sorted({"".join(rng.choice(list("abcd"), 7)) for _ in range(900)})
    longer = sorted({"".join(rng.choice(list("abcd"), 8)) for _ in range(900)})
    tree = spelling.Tree(words)
    a, b = tree.near(words)
    assert {(int(i), int(j)) for i, j in zip(a, b)} == {
        (i, j) for i, w in enumerate(words) for j, v in enumerate(words) if sum(x != y for x, y in zip(w, v)) == 1
    }
    a, b = tree.near(longer)
    at = {w: i for i, w in enumerate(words)}
    assert {(int(i), int(j)) for i, j in zip(a, b)} == {
        (i, at[w[:k] + w[k + 1:]]) for i, w in enumerate(longer) for k in range(8) if w[:k] + w[k + 1:] in at
    }
