import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import network as nw
from clickloom.operators import train as tr
from clickloom.operators.encode import Deep

SPEC = [Deep("a", 7, 3), Deep("b", 5, 2)]
WIDE, HIDDEN = 6, (4, 3)


def make_rows(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    rows = [
        (
            i, sorted(rng.choice(WIDE, rng.integers(0, 4), replace=False).tolist()),
            [int(rng.integers(7)), int(rng.integers(5))], float(rng.integers(2)),
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id bigint, slots array<int>, deep array<int>, label double")
    return rows, df.repartition(3)


def brute_logit(p, slots, deep):
    x = np.concatenate([p["emb:a"][deep[0]], p["emb:b"][deep[1]]]).astype(float)
    for k in (1, 2):
        x = np.maximum(p[f"dense_{k}.weight"] @ x + p[f"dense_{k}.bias"][0], 0)
    wide = np.zeros(WIDE)
    wide[slots] = 1
    return float(p["out.weight"][0] @ np.concatenate([wide, x]) + p["out.bias"][0, 0])


def brute_loss(p, rows):
    x = np.array([brute_logit(p, r[1], r[2]) for r in rows])
    y = np.array([r[3] for r in rows])
    return float(np.sum(np.maximum(x, 0) - x * y + np.log1p(np.exp(-np.abs(x)))))


@pytest.fixture(scope="module")
def params():
    return nw.init_parameters(SPEC, WIDE, HIDDEN, seed=5)


def test_parameter_counts_at_reference_widths():
    spec = [Deep(n, v, d) for n, v, d in (
        ("device_model", 8251, 256), ("app_id", 8552, 256), ("site_id", 4737, 256),
        ("site_domain", 7745, 256), ("app_domain", 559, 128),
    )]
    params = nw.init_parameters(spec, 453)
    assert sum(v.size for v in params.values()) == 8_323_654
    assert nw.embedding_bytes(spec) == 4 * 7_568_512


def test_tables_and_arrays_are_the_same(spark, params):
    back = nw.collect_parameters(nw.parameter_table(spark, params).repartition(4))
    assert back.keys() == params.keys()
    assert all(np.array_equal(back[k], params[k]) for k in params)
    with pytest.raises(ValueError, match="exceed"):
        nw.collect_parameters(nw.parameter_table(spark, params), max_bytes=100)


@pytest.mark.parametrize("max_bytes", [1 << 20, 10])
def test_scores_equal_row_by_row(spark, params, max_bytes):
    rows, df = make_rows(spark)
    table = nw.parameter_table(spark, params)
    got = {r.id: r for r in nw.score_table(df, table, SPEC, max_bytes=max_bytes).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = brute_logit(params, r[1], r[2])
        assert got[r[0]].logit == pytest.approx(want, abs=1e-5)
        assert got[r[0]].probability == pytest.approx(1 / (1 + np.exp(-want)), abs=1e-5)


def test_scoring_within_the_bound_has_no_shuffle(spark, params):
    _, df = make_rows(spark)
    scored = nw.score_table(df.coalesce(1), params, SPEC)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ArrowEvalPython" in plan


def test_scores_of_no_rows(spark, params):
    _, df = make_rows(spark, 5)
    assert nw.score_table(df.where("id < 0"), params, SPEC).collect() == []


@pytest.mark.parametrize("max_bytes", [1 << 20, 10])
def test_gradient_equals_numeric_difference(spark, params, max_bytes):
    p = {k: v.astype(np.float64) for k, v in params.items()}
    rows, df = make_rows(spark, 60)
    table = nw.parameter_table(spark, params)
    sums = tr.batch_gradient(df, table, SPEC, max_bytes=max_bytes).collect()
    got = {(r.tensor, r.row): r["values"] for r in sums}
    assert got["total", 0][1] == 60
    assert got["total", 0][0] == pytest.approx(brute_loss(p, rows), rel=1e-5)
    touched = {("emb:a", r[2][0]) for r in rows} | {("emb:b", r[2][1]) for r in rows}
    assert {k for k in got if k[0].startswith("emb:")} == touched
    rng = np.random.default_rng(1)
    for (tensor, row), values in got.items():
        if tensor == "total":
            continue
        j = int(rng.integers(len(values)))
        step = 1e-5
        p[tensor][row, j] += step
        up = brute_loss(p, rows)
        p[tensor][row, j] -= 2 * step
        down = brute_loss(p, rows)
        p[tensor][row, j] += step
        assert values[j] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_gradient_does_not_depend_on_tasks(spark, params):
    _, df = make_rows(spark)
    table = nw.parameter_table(spark, params)
    key = lambda d: {(r.tensor, r.row): np.array(r["values"]) for r in d.collect()}
    one, many = key(tr.batch_gradient(df, table, SPEC, 1)), key(tr.batch_gradient(df, table, SPEC, 3))
    assert one.keys() == many.keys()
    assert all(np.allclose(one[k], many[k], atol=1e-3) for k in one)


def test_weights_held_by_the_driver_are_scored_beyond_the_bound(spark):
    from clickloom.plans.formula_network import formula_parameters, formula_table

    spec = [Deep("a", 1500, 8), Deep("b", 3, 4)]
    df = spark.range(50).selectExpr(
        "id", "1.0D as label", "array(cast(id % 7 as int)) as slots", "array(cast(id * 29 as int), cast(id % 3 as int)) as deep"
    )
    params = formula_parameters(spec, 7)
    made = nw.collect_parameters(formula_table(spark, spec, 7))
    assert made.keys() == params.keys() and all((made[t] == params[t]).all() for t in params)
    near = {r.id: r.logit for r in nw.score_table(df, params, spec).collect()}
    far = {r.id: r.logit for r in nw.score_table(df, params, spec, max_bytes=1).collect()}
    assert near == far and len(near) == 50
