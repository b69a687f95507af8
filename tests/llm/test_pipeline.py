import re

import corpus_pipeline
from linefit.llm import byte_cnn, queries
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute, reference


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near-duplicates", "personal data", "packing"]
    spoken = corpus_pipeline.identify_language(spark, docs, folder)
    assert spoken.columns == columns
    kept = {r["doc_id"]: r["text"] for r in spoken.collect()}
    lettered = {r["doc_id"] for r in docs.collect() if r["text"] and re.search(r"[^\W\d_]", r["text"])}
    assert set(kept) <= lettered and len(kept) > 0.97 * len(lettered)
    single = corpus_pipeline.drop_near_duplicates(spark, spoken, folder)
    assert single.columns == columns
    least = brute({k: reference(t) for k, t in kept.items()})
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(least.values()))
    private = corpus_pipeline.replace_personal_data(spark, single, folder)
    assert private.columns == columns
    texts = [(r["doc_id"], r["text"]) for r in private.collect()]
    assert len(texts) == len(set(least.values()))
    rows = corpus_pipeline.run(spark, folder).collect()
    check(rows, texts)


def test_odd_documents(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "123 !"), (None, "the cat and the dog were here again", "en"), (4, "the cat and the dog were here", "en"),
            (4, "the cat and the dog were here", "en"), (5, "the cat and the dog were here", "en")]
    docs = docs_of(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r["doc_id"] or 0) for r in docs.collect()) == [0, 4]
    assert len(corpus_pipeline.pack(spark, docs, "").collect()) == 2
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.collect() == []


def test_query_is_the_run(spark, folder):
    assert queries.pipeline(spark, folder).count() == corpus_pipeline.run(spark, folder).count()
    assert byte_cnn.UNKNOWN == "und"
