import corpus_pipeline
import pytest

from clickloom.llm import classifier, mixing, rules
from clickloom.session import freeze
from test_jaccard import plain_components

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = freeze(stages[0](spark, docs, SF))
    model = classifier.fit_quality(docs, labels)
    assert ids(good) == ids(classifier.score_quality(docs, model).where("predicted = 1"))
    ruled = freeze(stages[1](spark, good, SF))
    assert ids(ruled) == ids(rules.quality_rules(good, rules.fit_rules(docs, labels)).where("kept"))
    single = freeze(stages[2](spark, ruled, SF))
    rows = [(r.doc_id, r.text) for r in ruled.select("doc_id", "text").collect()]
    assert ids(single) == sorted({c for _, _, c in plain_components(rows)})
    mixed = freeze(stages[3](spark, single, SF))
    assert ids(mixed) == ids(single)
    for kept in (good, ruled, single, mixed):
        assert kept.columns == docs.columns
    pieces = stages[4](spark, mixed, SF)
    assert sorted({r.doc_id for r in pieces.collect()}) == ids(mixed)
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == pieces.columns and ids(whole) == ids(pieces)


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize(
    "name",
    ["op1_pfair_mix", "op4_backoff_scores", "op7_jaccard_components", "op12_merkle_manifest", "op13_ball_codes"],
)
def test_sql_gives_the_same(spark, name):
    import duckdb

    import __spark_entry__ as contract
    from tools.check import rows_of

    con = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '/root/testdata/sf0.01/{name_}.parquet'")
    got = rows_of(contract.queries()[name](spark, "/root/testdata/sf0.01").toArrow())
    want = rows_of(con.execute(contract.oracle_sql()[name]).to_arrow_table())
    assert [n for n, _ in got[0]] == [n for n, _ in want[0]]
    assert got[1] == want[1]


def test_every_operator_has_its_query():
    import __spark_entry__ as contract

    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_packing_keeps_the_mix(spark):
    docs = spark.range(10_000).selectExpr("id as doc_id", "if(id % 9 = 0, 'b', 'a') as source", "'w ' || id as text")
    slots = mixing.schedule(docs).select("row.doc_id", "slot").toPandas().set_index("doc_id").slot
    pieces = corpus_pipeline.packing_stage(spark, docs.orderBy("source"), SF).toPandas()
    runs = pieces.doc_id.map(slots).groupby(pieces.sequence_id // 2**32).agg(["min", "max"]).sort_index()
    assert len(runs) == 3 and len(pieces) == 10_000
    assert (runs["min"].to_numpy()[1:] > runs["max"].to_numpy()[:-1]).all()
