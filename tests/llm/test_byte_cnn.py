import zlib

import numpy as np
from pyspark.sql import functions as F

from linefit.llm import byte_cnn, queries


def test_tables_give_the_networks_own_answer():
    random = np.random.default_rng(0)
    windows = random.integers(0, 256, (40, byte_cnn.WINDOW)).astype(np.uint8)
    labels = random.integers(0, 3, 40)
    net = byte_cnn.train(windows, labels, ["a", "b", "c"])
    embedded = net.embedding[windows]
    pooled = []
    for width in byte_cnn.WIDTHS:
        last = byte_cnn.WINDOW - width + 1
        seen = np.concatenate([embedded[:, k : k + last] for k in range(width)], axis=2)
        pooled.append((seen @ net.filters[width]).max(axis=1) + net.offsets[width])
    plain = byte_cnn.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ net.weights + net.bias)
    assert np.allclose(net.shares(windows, net.tables()), plain, atol=1e-4)


def test_gradients_equal_differences():
    random = np.random.default_rng(1)
    windows = random.integers(97, 123, (8, byte_cnn.WINDOW)).astype(np.uint8)
    labels = random.integers(0, 2, 8)
    net = byte_cnn.train(windows, labels, ["a", "b"])
    for value in (net.embedding, *net.filters.values(), net.weights, net.bias):
        value[...] = value.astype(np.float32)

    def loss():
        share = net.shares(windows, net.tables())
        return -np.log(share[np.arange(8), labels]).mean()

    grads = byte_cnn._gradients(net, windows, labels)
    for value, grad in ((net.weights, grads[-2]), (net.filters[2], grads[1])):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        before = value[at]
        value[at] = before + 1e-2
        up = loss()
        value[at] = before - 1e-2
        down = loss()
        value[at] = before
        assert abs((up - down) / 2e-2 - grad[at]) < 0.05 * abs(grad[at]) + 1e-3


def test_query_is_right_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op5_byte_cnn(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert sorted(rows) == sorted(d["doc_id"] for d in docs)
    right = total = 0
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if r["held_out"] and d["lang"]:
            total += 1
            right += r["lang_pred"] == d["lang"]
    assert total > 100 and right / total > 0.95


def test_odd_rows(docs_of):
    rows = [(i, "the cat and the dog were here", "en") for i in range(20)]
    rows += [(100 + i, "der Hund und die Katze wären hier", "de") for i in range(20)]
    docs = docs_of(rows + [(200, None, "en"), (201, "", "de"), (202, "12 %% !", None), (None, "the dog and", "en"),
                           (203, "the cat and the dog " * 5000, None)])
    net = byte_cnn.learn(docs, F.col("doc_id").isNotNull())
    out = byte_cnn.predict(docs, net, carry=["doc_id"]).collect()
    found = {r["doc_id"]: (r["_language"], r["_share"]) for r in out}
    assert len(out) == 45
    assert found[200] == found[201] == found[202] == ("und", 0.0)
    assert found[None][0] == found[203][0] == "en" and found[100][0] == "de"


def test_without_labels_or_rows(docs_of):
    docs = docs_of([(1, "some text", None)])
    net = byte_cnn.learn(docs, F.lit(True))
    assert net is None
    assert [r["_language"] for r in byte_cnn.predict(docs, net).collect()] == ["und"]
    assert byte_cnn.predict(docs_of([]), byte_cnn.learn(docs_of([]), F.lit(True))).collect() == []
