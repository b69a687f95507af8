import pytest

from linefit.plans import bank, regression
from linefit.plans import fixed_values as K
from linefit.sources import delimited, staging


def written(spark, header, rows):
    table = spark.createDataFrame([(r,) for r in rows], "value string").coalesce(2)
    return staging.write_lines(table, "csv", header)


@pytest.fixture(scope="module")
def seven(spark):
    """Seven records, one of them too short and one too long."""
    rows = ["1,a,x", "2,b,y", "3,c", "4,d,z,extra", "5,e,w", "6,f,v", "7,g,u"]
    return written(spark, "id,name,tag", rows)


def test_malformed_does_not_depend_on_the_columns_used(spark, seven):
    df = delimited.read_delimited(spark, seven)
    assert df.count() == 5
    assert len(df.collect()) == 5
    assert sorted(r.id for r in df.select("id").collect()) == ["1", "2", "5", "6", "7"]


def test_rejected_records(spark, seven):
    rejects = delimited.rejected_records(spark, seven)
    assert sorted(r.record for r in rejects.collect()) == ["3,c", "4,d,z,extra"]
    assert rejects.count() == 2


def test_names_that_do_not_match_the_header(spark, seven):
    with pytest.raises(Exception, match="does not conform"):
        delimited.read_delimited(spark, seven, ["id", "tag", "name"]).collect()


def test_headerless(spark):
    path = written(spark, None, ["1,2", "3,4"])
    df = delimited.read_delimited(spark, path, header=False)
    assert df.columns == ["_c0", "_c1"]
    assert df.count() == 2


def test_delimiter_inside_quotes(spark):
    path = written(spark, '"a";"b";"c"', ['"2004";"6";"q;q"'])
    rows = delimited.read_delimited(spark, path, separator=";").collect()
    assert [tuple(r) for r in rows] == [("2004", "6", "q;q")]


def test_bank(spark):
    header = '"age";"job";"marital";"education";"default";"balance";"housing"'
    rows = [
        '30;"unemp;loyed";"married";"primary";"no";1787;"no"',
        '80;"services";"married";"secondary";"no";-5;"yes"',
        '30;"services";"single";"secondary";"no";x;"yes"',
    ]
    table = bank.read_bank(spark, written(spark, header, rows))
    found = sorted(tuple(r) for r in table.fillna(0, ["balance"]).collect())
    assert found[0] == (30, "services", "single", "secondary", 0)
    assert found[1] == (30, "unemp;loyed", "married", "primary", 1787)
    ages = bank.customers_per_age(table)
    assert [tuple(r) for r in ages.collect()] == [(30, 2)]
    assert bank.customers_per_age_sql(spark, table).collect() == ages.collect()


def test_wide_rows_keep_known_years_only(spark):
    def record(year, duration="200"):
        return [year if c == "Year" else duration if c == "Duration" else "1"
                for c in K.CSV_COLUMNS]

    rows = [record(y) for y in ("", "0", "2000.5", "x", "1999")] + [record("2001", "long")]
    records = spark.createDataFrame(rows, delimited.text_schema(K.CSV_COLUMNS))
    packed = regression.packed_songs(records)
    assert packed.columns == ["values"]
    assert sorted(r["values"][0] for r in packed.collect()) == ["1999", "2000.5", "2001"]
    prepared = regression.wide_csv_rows(records).collect()
    assert sorted(r.label for r in prepared) == [77.0, 78.5]
    assert all(r.features == [200.0, 1.0, 1.0, 1.0, 1.0, 1.0] for r in prepared)
