from urllib.parse import urlparse

import pytest

from clickloom.session import freeze, scratch_dir
from clickloom.sources import features_io as io


def test_only_csv_files_are_read(spark):
    path = scratch_dir(spark)
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    io.write_features(df, path)
    df.write.mode("append").json(path)
    got = io.read_features(spark, path, ["x", "y"])
    assert sorted(map(tuple, got.collect())) == [(1.0, 2.0), (3.0, 4.0)]
    assert got.columns == ["x", "y"]


@pytest.mark.parametrize("line", ["1.0", "1.0,2.0,3.0", "1.0,text"])
def test_lines_that_do_not_fit_are_refused(spark, line):
    path = scratch_dir(spark)
    spark.createDataFrame([("1.0,2.0",), (line,)], "value string").coalesce(1).write.text(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in files.listStatus(hadoop):
        if f.getPath().getName().endswith(".txt"):
            files.rename(f.getPath(), f.getPath().suffix(".csv"))
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ"):
        io.read_features(spark, path, ["x", "y"]).collect()


def test_write_replaces_and_counts_files(spark):
    path = scratch_dir(spark)
    io.write_features(spark.range(1000), path)
    io.write_features(spark.range(10), path, n_files=3)
    got = io.read_features(spark, path, ["id"])
    assert sorted(r.id for r in got.collect()) == [float(i) for i in range(10)]
    assert got.select("_metadata.file_path").distinct().count() == 3


def test_parameters_round_trip(spark):
    df = spark.createDataFrame(
        [("a", 0, [1.5, 2.0]), ("b", 1, [])], io.PARAMETER_SCHEMA
    )
    path = scratch_dir(spark)
    io.save_parameters(df, path)
    io.save_parameters(df, path)
    assert sorted(map(tuple, io.load_parameters(spark, path).collect())) == [
        ("a", 0, [1.5, 2.0]), ("b", 1, []),
    ]


def test_frozen_tables_lie_in_the_shared_folder(spark):
    df = freeze(spark.range(3))
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = urlparse(root).path
    files = df.inputFiles()
    assert files and all(urlparse(f).path.startswith(folder) for f in files)


def test_numbers_are_written_as_spark_prints_them(spark, tmp_path):
    odd = [0.0, -0.0, 1.0, -1.0, None, float("nan"), float("inf"), float("-inf"), 1e-7, 1e22, 5e-324, 0.1]
    df = spark.createDataFrame([(v, i, 'a,"b') for i, v in enumerate(odd)], "`a.b` double, n int, t string")
    texts = [r[0] for r in df.select(io.number_text("a.b"), "n").orderBy("n").collect()]
    assert texts[:5] == ["0.0", "-0.0", "1.0", "-1.0", None]
    io.write_features(df, f"{tmp_path}/ours")
    df.write.csv(f"{tmp_path}/plain")
    ours, plain = (sorted(r.value for r in spark.read.text(f"{tmp_path}/{k}").collect()) for k in ("ours", "plain"))
    assert ours == plain
