import pytest

from clickloom.session import scratch_dir
from clickloom.sources import impressions as src


def test_hour_keeps_leading_zero(spark):
    df = spark.createDataFrame([(14102100,), (14102109,), (14102123,), (None,)], "hour int")
    assert [r.hr for r in src.derive_hour(df).collect()] == ["00", "09", "23", None]


def test_cross_joins_texts_and_keeps_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "s string, i int")
    out = src.cross(df, [("s", "i"), ("i", "s")])
    assert out.columns == ["s", "i", "s-i", "i-s"]
    assert [(r[2], r[3]) for r in out.collect()] == [("a1", "1a"), (None, None), (None, None)]


def test_separator_tells_pairs_apart(spark):
    df = spark.createDataFrame([("1", "12"), ("11", "2")], "a string, b string")
    assert len({r[2] for r in src.cross(df, [("a", "b")]).collect()}) == 1
    assert len({r[2] for r in src.cross(df, [("a", "b")], sep="|").collect()}) == 2


def test_header_csv_with_unnamed_first_column(spark):
    path = scratch_dir(spark)
    spark.createDataFrame(
        [(",hour,click",), ("0,14102100,1",), ("1,14102109,0",)], "value string"
    ).coalesce(1).write.text(path)
    df = src.read_impressions(spark, path)
    assert df.columns == ["_c0", "hour", "click"]
    assert df.dtypes[1:] == [("hour", "int"), ("click", "int")]
    assert src.drop_tolerant(df, "_c0").columns == ["hour", "click"]
    assert src.drop_tolerant(df, "_c0", "_c0", "no_such").columns == ["hour", "click"]


def test_explicit_schema_takes_ids_past_64_bits(spark):
    path = scratch_dir(spark)
    header = ",".join(src.IMPRESSION_SCHEMA.names)
    line = "18446744073709551610,1,14102100,1005,0" + ",x" * 9 + ",1,0" + ",7" * 8
    spark.createDataFrame([(header,), (line,)], "value string").coalesce(1).write.text(path)
    row = src.read_impressions(spark, path, src.IMPRESSION_SCHEMA).first()
    assert int(row.id) == 18446744073709551610 and row.C21 == 7 and row.device_model == "x"
    inferred = src.read_impressions(spark, path)
    assert dict(inferred.dtypes)["id"] == "decimal(20,0)"


def raw_file(spark, *lines):
    path = scratch_dir(spark)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


VALUES = "7,1,14102100,1005,0" + ",x" * 9 + ",1,0" + ",7" * 8
NAMES = ",".join(src.IMPRESSION_SCHEMA.names)


def test_schema_is_applied_by_name(spark):
    row = src.read_impressions(spark, raw_file(spark, "," + NAMES, "0," + VALUES), src.IMPRESSION_SCHEMA).first()
    assert row.asDict()["hour"] == 14102100 and row.click == 1 and int(row.id) == 7 and len(row) == 24
    moved = raw_file(spark, ",".join(reversed(NAMES.split(","))), ",".join(reversed(VALUES.split(","))))
    assert src.read_impressions(spark, moved, src.IMPRESSION_SCHEMA).first() == row
    with pytest.raises(ValueError, match="click"):
        src.read_impressions(spark, raw_file(spark, "id,hour", "1,2"), src.IMPRESSION_SCHEMA)


@pytest.mark.parametrize("line", [VALUES + ",9", VALUES.rsplit(",", 1)[0], VALUES.replace("14102100", "noon")])
def test_lines_that_do_not_fit_are_refused(spark, line):
    df = src.read_impressions(spark, raw_file(spark, NAMES, VALUES, line), src.IMPRESSION_SCHEMA)
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ"):
        df.collect()


def test_enrich_adds_hour_and_six_crosses(spark):
    df = spark.createDataFrame(
        [(14102109, "app", "site", 1, 2)],
        "hour int, app_category string, site_category string, device_type int, banner_pos int",
    )
    row = src.enrich(df).first()
    assert row["hr-app_category"] == "09app" and row["banner_pos-device_type"] == "21"
    assert row["device_type-site_category"] == "1site" and len(row) == 12


@pytest.mark.parametrize("n", [0, 1])
def test_enrich_of_few_rows(spark, n):
    df = spark.createDataFrame(
        [(14102109, "app", "site", 1, 2)] * n,
        "hour int, app_category string, site_category string, device_type int, banner_pos int",
    )
    assert src.enrich(df).count() == n
