import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linefit.llm import packing, queries, tokens
from linefit.llm.common import staged

LIBRARY = tokens.load_tokenizer(tokens.DEFAULT)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fullest_equals_brute_force(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    chosen = packing.fullest(counts, room)
    assert all(n <= counts[x] for x, n in chosen.items())
    assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room)


def test_plan_uses_every_piece_and_leaves_little():
    random.seed(1)
    counts = Counter(random.randint(1, 4095) for _ in range(5000))
    counts[7] += 3000
    counts[4096] = 40
    bins = packing.plan(counts)
    used = Counter()
    for pattern, times in bins:
        assert 0 < sum(x * n for x, n in pattern.items()) <= 4096
        for x, n in pattern.items():
            used[x] += n * times
    assert used == counts
    number = sum(t for _, t in bins)
    assert number - sum(x * n for x, n in counts.items()) / 4096 < 0.01 * number + 1


def check(rows, texts):
    """``texts`` is a list of (key, text); every id must lie in exactly one piece."""
    wanted = Counter()
    for key, text in texts:
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        for s in range(0, len(ids), 4096):
            part = ids[s : s + 4096]
            wanted[key, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == wanted
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    full = 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
        full += at
    return full / (4096 * len(by_sequence)) if by_sequence else 1


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = queries.op6_bin_slack(spark, folder).collect()
    assert check(rows, [(r["doc_id"], r["text"]) for r in docs]) > 0.97


def test_odd_rows(docs_of):
    rows = [(1, "a"), (1, "a"), (None, None), (2, ""), (3, "word " * 9000), (4, "a")] + [(9, "same text")] * 30
    check(packing.pack_documents(docs_of(rows)).collect(), rows)
    assert packing.pack_documents(docs_of([])).collect() == []


def test_sequences_hold_the_ids(docs_of):
    rows = [(i, "word " * (i * 37 % 500)) for i in range(60)]
    pieces, _ = staged(packing.token_pieces(docs_of(rows), with_ids=True), "pieces")
    packed = packing.pack(pieces)
    where = {(r["sequence_id"], r["offset"]): r["ids"] for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        ids = r["ids"]
        n = len(ids) // 4
        assert n == 4096 or n & (n - 1) == 0
        for (s, offset), part in where.items():
            if s == r["sequence_id"]:
                assert ids[4 * offset : 4 * offset + len(part)] == part
