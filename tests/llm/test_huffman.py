import heapq
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linefit.llm import huffman, queries, tokens

LIBRARY = tokens.load_tokenizer(tokens.DEFAULT)


def plain_cost(counts):
    """Bits of an unlimited Huffman code."""
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=2, max_size=60))
def test_lengths_are_best_and_within_the_limit(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 30)
    used = lengths[counts > 0].astype(float)
    if (counts > 0).sum() > 1:
        assert (2.0 ** -used).sum() == 1
        assert int((lengths * counts).sum()) == plain_cost(counts.tolist())
        tight = huffman.code_lengths(counts, 6)
        assert tight.max() <= 6 and (2.0 ** -tight[counts > 0].astype(float)).sum() <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=3000), st.integers(1, 50))
def test_round_trip(ids, block):
    ids = np.array(ids, np.int64)
    counts = np.bincount(ids, minlength=301)
    lengths = huffman.code_lengths(counts, 12)
    data = huffman.to_bytes([5, 6], [len(ids), 0], ids, lengths, huffman.canonical_codes(lengths), 3, block)
    keys, sizes, found, header = huffman.from_bytes(data)
    assert keys.tolist() == [5, 6] and sizes.tolist() == [len(ids), 0] and header["start"] == 3
    assert found.tolist() == ids.tolist()


def test_codes_are_canonical():
    lengths = np.array([2, 0, 1, 3, 3], np.uint8)
    assert huffman.canonical_codes(lengths).tolist() == [0b10, 0, 0b0, 0b110, 0b111]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        huffman.from_bytes(b"something else")


def check(rows, texts):
    wanted, start = [], 0
    for key, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        wanted.append((key, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(((r[0], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=lambda r: r[1]) == wanted


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check(queries.op7_huffman(spark, folder).collect(), [(r["doc_id"], r["text"]) for r in docs])


def test_odd_rows_and_small_files(spark, docs_of, monkeypatch):
    monkeypatch.setattr(huffman, "FILE_IDS", 100)
    rows = [(3, "c d"), (1, None), (2, "word " * 700), (None, "no key"), (1, "again"), (1, "again"), (-5, "")]
    archive = huffman.write(docs_of(rows))
    out = huffman.read(spark, archive).collect()
    check(out, rows)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in out)


def test_empty_table(spark, docs_of):
    assert huffman.read(spark, huffman.write(docs_of([]))).collect() == []
