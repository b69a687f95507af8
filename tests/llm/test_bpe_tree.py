import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linefit.llm import bpe_tree, queries, tokens

LIBRARY = tokens.load_tokenizer(tokens.DEFAULT)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def wide(text):
    (found,) = tokens.word_encoder(tokens.DEFAULT).encode([text])
    return np.frombuffer(found, "<u2").astype("<u4").tobytes()


def by_tree(text, leaf):
    nodes = [bpe_tree.leaf_of(LIBRARY, wide, text[i : i + leaf]) for i in range(0, len(text), leaf)]
    while len(nodes) > 1:
        nodes = [
            bpe_tree.join_nodes(LIBRARY, *nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i]
            for i in range(0, len(nodes), 2)
        ]
    return np.frombuffer(bpe_tree.ids_of(nodes[0]), "<u4").tolist()


@pytest.mark.parametrize("leaf", [150, 331, 1000])
@pytest.mark.parametrize("text", [
    "thationerethe" * 300, "a" * 3000, "word and words, more. " * 200, "<|endoftext|>" * 120,
    "é́x" * 500, "ab!?12'll" * 300, "한국어ᄒ" * 400, ("x" * 700 + " ") * 5, "\U0001f600" * 900,
    "aé" * 900, "'s" * 800, "x<|end" + "oftext|>" * 300,
])
def test_joined_leaves_equal_the_whole(text, leaf):
    assert by_tree(text, leaf) == expected(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(
    ["the", "tion", "é", "́", " ", "\n", "<|endoftext|>", "'s", "12", "!!", "İ", "한", "a", "zq", "\U0001f600"]
), min_size=200, max_size=500), st.integers(130, 400))
def test_any_mixture(parts, leaf):
    text = "".join(parts)
    assert by_tree(text, leaf) == expected(text)


def test_every_row_has_its_result(docs_of):
    rows = [
        (1, "long " * 3000), (1, "long " * 3000), (2, None), (3, ""), (None, "x" * 9000), (4, "y" * 20000),
        (1, "another of that id " * 800), (5, "short one"),
    ]
    encoded = bpe_tree.encode(docs_of(rows), leaf=2048)
    out = bpe_tree.decode(encoded).collect()
    found = sorted((r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in out)
    wanted = sorted(
        (k or 0, expected(t), LIBRARY.decode(expected(t), skip_special_tokens=False)) for k, t in rows
    )
    assert found == wanted


def test_empty_table(docs_of):
    assert bpe_tree.decode(bpe_tree.encode(docs_of([]))).collect() == []


def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op4_bpe_tree(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = expected(texts[r["doc_id"]])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
