import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from clickloom.plans.oracle import ORACLE
from clickloom.plans.queries import QUERIES
from tools.check import rows_of

SF = "/root/testdata/sf0.01"

ROWS_ONLY = {"train_rounds", "loss_history", "gbt_baseline"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql_but_training():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(contract.queries()) and ORACLE.items() <= contract.oracle_sql().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    table = contract.queries()[name](spark, SF).toArrow()
    assert table.num_rows > 0
    if name in ROWS_ONLY:
        return
    got, want = rows_of(table), rows_of(con.execute(contract.oracle_sql()[name]).to_arrow_table())
    assert [n for n, _ in got[0]] == [n for n, _ in want[0]]
    assert got[1] == want[1]


def test_entry(spark):
    assert contract.entry(spark).count() == 1000


@pytest.mark.parametrize(
    "name", ["embed_index", "string_index", "one_hot", "assemble_vector", "vector_array", "gbt_baseline"]
)
def test_query_holds_no_labels_on_the_driver(spark, monkeypatch, name):
    from clickloom.operators import encode

    monkeypatch.setattr(encode, "MAX_LABELS", 3)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_trees_know_nominal_columns(spark, monkeypatch):
    from clickloom.plans import queries

    class Seen(Exception):
        pass

    def look(df, **settings):
        raise Seen(df.schema["features"].metadata["ml_attr"]["attrs"])

    monkeypatch.setattr(queries.tr, "gbt_baseline", look)
    with pytest.raises(Seen) as seen:
        QUERIES["gbt_baseline"](spark, "/root/testdata/sf0.001")
    assert set(seen.value.args[0]) == {"nominal"}


def test_entry_works_without_the_text_operators(tmp_path):
    root = Path(contract.__file__).parent
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(root / name, tmp_path)
    shutil.copytree(root / "clickloom", tmp_path / "clickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as c; print(sorted(c.queries()) == sorted(c.QUERIES), set(c.oracle_sql()) == set(c.ORACLE))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert ran.stdout.split() == ["True", "True"], ran.stderr


def test_lines_of_many_columns_are_not_one_method(spark):
    from clickloom.plans.queries import told

    columns = [((F.col("id") + i) % 3).cast("double").alias(f"c{i}") for i in range(300)]
    lines = told(spark.range(20).select("id", *columns), ["id"])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in plan.splitlines() if "*(" in p and "array_join" in p]
    assert lines.where("id = 4").first().line == ",".join(str((4 + i) % 3) for i in range(300))
