import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from linefit.llm import queries, warc

SCHEMA = "page_id long, url string, html string"


@given(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text()), st.binary(max_size=200),
       st.one_of(st.none(), st.integers(0, 9)))
def test_records_are_read_back(page, url, payload, refers):
    data, target = warc.record_of(page, url, payload, refers)
    headers, http, found = warc.parse(data)
    assert headers["WARC-Target-URI"] == target and "\n" not in target
    assert found == (payload if refers is None else b"")
    assert int(http["Content-Length"]) == len(payload)


def expected(rows):
    groups = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            groups[data] = max(groups.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        top = groups.get(data, page) if page is not None else None
        revisit = page is not None and top != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    top if revisit else None))
    return sorted(out, key=str)


def found(rows):
    return sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows),
        key=str,
    )


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(queries.op10_warc(spark, folder).collect()) == expected(rows)


@pytest.mark.parametrize("size", [1 << 28, 2000])
def test_odd_rows_and_selection(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "ARCHIVE", size)
    long, short = "<p>é" * 700, "x" * 999
    rows = [
        (1, "http://a/", long), (2, "http://b/ c\r\nX: y", long), (3, None, short), (4, "u", short), (5, "u", None),
        (6, "", ""), (None, "n", long), (7, "http://z/", "y" * 1000), (8, "http://y/", "y" * 1000),
        (9, "big", "z" * 3_000_000), (10, "w", "HTTP/1.1\r\n\r\nx\x00"),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", digest string")
    index = warc.write(pages)
    assert found(warc.read(index).collect()) == expected(rows)
    some = warc.read(index.where("page in (2, 9, 10)"), with_payload=True).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in some} == {2: long, 9: "z" * 3_000_000, 10: rows[-1][2]}


def test_repeated_ids_and_empty_table(spark):
    rows = [(1, "a", "q" * 1500), (1, "a", "q" * 1500), (2, "b", "r")]
    assert len(warc.read(warc.write(spark.createDataFrame(rows, SCHEMA))).collect()) == 3
    assert warc.read(warc.write(spark.createDataFrame([], SCHEMA))).collect() == []
