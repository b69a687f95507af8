"""Addresses of lines and rows, and records that run over lines, however files are cut."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from linefit.operators.split import fold_number, with_part
from linefit.plans import bank, programs
from linefit.plans import testviews as T
from linefit.sources import delimited, multiline, splits

PARTS = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]


@pytest.fixture(params=["64", "1000", "128m"])
def cut(spark, request):
    """Sizes of splits, from a few lines to whole files."""
    for name, value in zip(PARTS, (request.param, "1", "1")):
        spark.conf.set(name, value)
    yield request.param
    for name in PARTS:
        spark.conf.unset(name)


def text_of(rows, separator=","):
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=separator, lineterminator="\n").writerows(rows)
    return out.getvalue()


def records(seed, n):
    draw = random.Random(seed)
    pieces = ["plain", "a\nb", 'say ""x"" "', "x,y", "", "\n\n\n", "é\r\nü", '"', "  spaced ", 'q"\n"q']
    return [[str(i), draw.choice(pieces) + draw.choice(pieces), str(2 * i)] for i in range(n)]


def test_records_over_lines_equal_the_csv_module(spark, tmp_path, cut):
    wanted = []
    for number in range(3):
        rows = records(number, 120)
        (tmp_path / f"part-{number}.csv").write_bytes(text_of([["id", "na\nme", "v"], *rows]).encode())
        wanted += rows
    found = multiline.read_delimited(spark, str(tmp_path))
    assert found.columns == ["id", "na\nme", "v"]
    got = sorted([[f or "" for f in r] for r in found.collect()])
    assert got == sorted(wanted)
    if cut == "64":
        assert splits.raw_lines(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 20


def test_a_field_may_fill_whole_splits(spark, tmp_path, cut):
    long = "\n".join(f"line {i}" for i in range(300))
    rows = [["1", long, "x"], ["2", "short", "y"], ["3", long + '"', "z"]]
    (tmp_path / "a.csv").write_text(text_of(rows))
    found = multiline.read_delimited(spark, str(tmp_path), ["a", "b", "c"], header=False)
    assert sorted(map(list, found.collect())) == rows


def test_malformed_records_and_blank_lines(spark, tmp_path, cut):
    lines = 'a;b\n1;"x\n\ny"\n\n  \n2\n3;"p";q\n4;"end\r\n"\r\n'
    (tmp_path / "a.csv").write_bytes(lines.encode())
    good = multiline.read_delimited(spark, str(tmp_path), separator=";").collect()
    assert sorted(map(tuple, good)) == [("1", "x\n\ny"), ("4", "end\r\n")]
    bad = multiline.rejected_records(spark, str(tmp_path), separator=";").collect()
    assert sorted(r["record"] for r in bad) == ["2", '3;"p";q']


def test_a_quote_that_is_never_closed_ends_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"open\n' + "more\n" * 200)
    with pytest.raises(Exception, match="not closed"):
        multiline.read_records(spark, str(tmp_path), longest=100).collect()


def test_empty_file_and_folder_without_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert multiline.read_records(spark, str(tmp_path)).collect() == []
    assert splits.addressed_lines(spark, str(tmp_path)).collect() == []
    with pytest.raises(ValueError, match="no header"):
        multiline.column_names(spark, str(tmp_path))


def test_multiline_reader_agrees_with_the_line_reader_where_both_apply(spark, tmp_path, cut):
    rows = [["age", "job", "m", "e", "d", "balance"]] + [[str(20 + i % 50), f"j;{i}", "m", "e", "no", str(i)] for i in range(200)]
    rows[7] = rows[7][:4]
    rows[9][0] = "old"
    (tmp_path / "a.csv").write_text(text_of(rows, ";"))
    path = str(tmp_path)
    for use in (bank.read_bank, bank.rejected_records):
        a, b = (sorted(map(str, use(spark, path, reader).collect())) for reader in (delimited, multiline))
        assert a == b
    ages = programs.PROGRAMS["bank-ages"](spark, path, reader=multiline)["ages"].collect()
    assert ages == programs.PROGRAMS["bank-ages"](spark, path)["ages"].collect()


def test_addresses_are_byte_offsets(spark, tmp_path, cut):
    whole = {}
    for name in ("b/x.txt", "c/x.txt"):
        lines = [f"{'é' * (i % 7)}line {i % 3}" for i in range(150)] + [""]
        data = "\n".join(lines).encode()
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(data)
        at = 0
        for line in lines[:-1]:
            whole["/" + name, at] = line
            at += len(line.encode()) + 1
    found = splits.addressed_lines(spark, str(tmp_path) + "/*").collect()
    assert len(found) == len(whole)
    assert {r["offset"] for r in found} == {k[1] for k in whole}
    found = {(r["file"].rsplit("/", 2)[-2], r["offset"]): r["value"] for r in found}
    assert found == {(k[0].split("/")[1], k[1]): v for k, v in whole.items()}


def test_equal_lines_are_drawn_one_by_one_and_alike_however_files_are_cut(spark, tmp_path):
    lines = ["2001.0,0.5,0.25,0.1" + ",0" * 9] * 4000 + [f"2001.0,{i / 2000},0.3,0.2" + ",0" * 9 for i in range(2000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    drawn = []
    for size in ("30000", "128m"):
        spark.conf.set(PARTS[0], size)
        try:
            rows = splits.addressed_lines(spark, str(tmp_path))
            parted = with_part(rows, [0.7, 0.3], [splits.FILE, splits.OFFSET], 3)
            fold = fold_number([splits.FILE, splits.OFFSET], 3, 3)
            drawn.append(sorted(map(tuple, parted.select("offset", "part", fold.alias("fold")).collect())))
        finally:
            spark.conf.unset(PARTS[0])
    assert drawn[0] == drawn[1] and len(drawn[0]) == 6000
    assert sum(d[1] == 0 for d in drawn[0]) / 6000 == pytest.approx(0.7, abs=0.02)
    equal = [d for d in drawn[0] if d[0] < 4000 * len(lines[0]) + 4000]
    assert sum(d[1] == 0 for d in equal) / 4000 == pytest.approx(0.7, abs=0.02)
    assert programs.PROGRAMS["descent"](spark, str(tmp_path), keys=None)["errors"].count() == 2


def test_rows_of_a_table_are_drawn_alike_however_it_is_cut(spark, folder):
    counts = []
    for size in ("20000", "128m"):
        spark.conf.set(PARTS[0], size)
        try:
            rows = splits.addressed_rows(T.table(spark, folder, "lineitem"))
            assert rows.select(splits.FILE, splits.OFFSET).distinct().count() == rows.count()
            parted = with_part(rows, [0.7, 0.3], [splits.FILE, splits.OFFSET], 1)
            counts.append(sorted(map(tuple, parted.groupBy("part").agg(F.count("*"), F.sum("l_partkey")).collect())))
        finally:
            spark.conf.unset(PARTS[0])
    assert counts[0] == counts[1]
