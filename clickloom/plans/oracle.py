"""The same results in SQL for DuckDB, over the same tables."""

from __future__ import annotations

IM = """im AS (
SELECT e.event_id AS id,
       CAST(e.event_type = 'click' AS INT) AS click,
       CAST(strftime(e.ts, '%y%m%d%H') AS INT) AS hour,
       CAST(e.event_id % 7 AS INT) AS banner_pos,
       CAST(e.user_id % 5 AS INT) AS device_type,
       CAST(e.event_id % 4 AS INT) AS device_conn_type,
       coalesce(c.c_mktsegment, 'none') AS site_category,
       coalesce(n.n_name, 'none') AS app_category,
       json_extract_string(e.props, '$.k') AS site_id,
       concat('d', CAST(CAST(floor(e.value) AS INT) % 60 AS VARCHAR)) AS site_domain,
       coalesce(c.c_name, 'none') AS app_id,
       concat('n', coalesce(CAST(c.c_nationkey AS VARCHAR), 'x')) AS app_domain,
       CAST(e.user_id AS VARCHAR) AS device_model
FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

# The crossed pairs.
CROSSES = [
    ("hr", "app_category"), ("hr", "site_category"), ("hr", "device_type"),
    ("banner_pos", "device_type"), ("device_type", "app_category"),
    ("device_type", "site_category"),
]
CANDIDATES = [
    *[(n, "int") for n in ("click", "hour", "banner_pos", "device_type", "device_conn_type")],
    *[
        (n, "string")
        for n in (
            "site_category", "app_category", "site_id", "site_domain", "app_id", "app_domain",
            "device_model", "hr", *(f"{a}-{b}" for a, b in CROSSES),
        )
    ],
]
# Deep columns with their widths, units of the layers.
DEEP = [
    ("device_model", 256), ("app_id", 256), ("site_id", 256), ("site_domain", 256), ("app_domain", 128),
]
HIDDEN = [512, 256, 128]
INPUTS = sum(d for _, d in DEEP)

# Impressions with hour and crosses.
EN = (
    IM
    + """,
h AS (SELECT *, substr(CAST(hour AS VARCHAR), 7) AS hr FROM im),
en AS (SELECT *, """
    + ", ".join(
        f'CAST({a} AS VARCHAR) || CAST({b} AS VARCHAR) AS "{a}-{b}"' for a, b in CROSSES
    )
    + " FROM h)"
)


def values(rows) -> str:
    show = lambda v: "'" + v + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(show(v) for v in r) + ")" for r in rows)


# One row per impression and column; frequencies, profile, wide selection, indexes and slots.
LONG = (
    EN
    + """,
l AS (SELECT id, name, value FROM (SELECT id, """
    + ", ".join(f'CAST("{n}" AS VARCHAR) AS "{n}"' for n, _ in CANDIDATES)
    + " FROM en) UNPIVOT (value FOR name IN ("
    + ", ".join(f'"{n}"' for n, _ in CANDIDATES)
    + """))),
cols AS (SELECT * FROM (VALUES """
    + values((i + 1, n, t) for i, (n, t) in enumerate(CANDIDATES))
    + """) AS t(pos, name, type)),
counts AS (SELECT name, value, count(*) AS n FROM l GROUP BY name, value),
prof AS (SELECT pos, name, type, count(*) AS ndv FROM cols JOIN counts USING (name)
         GROUP BY pos, name, type),
sel AS (SELECT row_number() OVER (ORDER BY CAST(type = 'int' AS INT), ndv DESC, pos) - 1 AS rank, *
        FROM prof WHERE ndv <= 100 AND ndv > 1 AND name <> 'click'),
starts AS (SELECT name, rank, ndv, sum(ndv - 1) OVER (ORDER BY rank) - (ndv - 1) AS start FROM sel),
vocab AS (SELECT name, value, n,
                 row_number() OVER (PARTITION BY name ORDER BY n DESC, value) - 1 AS idx FROM counts),
slots AS (SELECT l.id, s.name, CAST(s.start + v.idx AS INT) AS slot
          FROM l JOIN starts s USING (name) JOIN vocab v USING (name, value)
          WHERE v.idx < s.ndv - 1),
dims AS (SELECT * FROM (VALUES """
    + values((i, n, d) for i, (n, d) in enumerate(DEEP))
    + """) AS t(pos, name, dim)),
deep AS (SELECT l.id, d.pos, d.name, d.dim, v.idx
         FROM l JOIN dims d USING (name) JOIN vocab v USING (name, value)),
lab AS (SELECT l.id, CAST(v.idx AS DOUBLE) AS label
        FROM l JOIN vocab v USING (name, value) WHERE name = 'click'),
width AS (SELECT sum(ndv - 1) AS w FROM sel),
slot_text AS (SELECT id, string_agg(slot, ',' ORDER BY slot) AS slots FROM slots GROUP BY id),
deep_text AS (SELECT id, string_agg(idx, ',' ORDER BY pos) AS deep FROM deep GROUP BY id)"""
)


# The network by formula consists of two equal halves, so one of them is enough. A unit reads four
# inputs; those of the first layer are numbered over the first halves of all embeddings.
def read(o: str, j: int, inputs: int) -> str:
    return f"(({o} * 5 + {j * 37}) % {inputs // 2})"


def weight(o: str, j: int, k: int) -> str:
    return f"(((({o} * 3 + {j * 5 + k}) % 5) - 2) / 2e0)"


def layer(k: int, inputs: int, source: str) -> str:
    place = lambda q: f"({q} // 128 * 256 + {q} % 128)" if k == 1 else q
    dot = " + ".join(f"x[{place(read('o', j, inputs))} + 1] * {weight('o', j, k)}" for j in range(4))
    return (
        f"h{k} AS MATERIALIZED (SELECT id, list_transform(range(0, {HIDDEN[k - 1] // 2}), "
        f"lambda o: greatest({dot} + (((o + {k}) % 3) - 1) / 2e0, 0e0)) AS x FROM {source})"
    )


LAYERS = (
    LONG
    + """,
e0 AS (SELECT pos, idx, list_transform(range(0, dim), lambda j: (((idx * 7 + j % (dim // 2) * 3 + pos) % 5) - 2) / 2e0) AS e
       FROM (SELECT DISTINCT pos, idx, dim FROM deep)),
x0 AS MATERIALIZED (SELECT id, flatten(list(e ORDER BY pos)) AS x FROM deep JOIN e0 USING (pos, idx) GROUP BY id),
"""
    + ",\n".join([layer(1, INPUTS, "x0"), layer(2, HIDDEN[0], "h1"), layer(3, HIDDEN[1], "h2")])
)
TOP = HIDDEN[2] // 2

# Scores of the network by formula.
NET = (
    LAYERS
    + f""",
wide AS (SELECT id, sum((((slot * 5) % 9) - 4) / 8e0) AS w FROM slots GROUP BY id),
logits AS (SELECT h3.id, coalesce(wide.w, 0e0) + list_sum(list_transform(h3.x, lambda v, i:
      v * (((((i - 1) * 5) % 9) - 4) + ((((i - 1 + {TOP}) * 5) % 9) - 4)) / 64e0)) + 0.125e0 AS logit
  FROM h3 LEFT JOIN wide USING (id)),
scored AS (SELECT id, label, CAST(logit AS DOUBLE) AS logit, 1e0 / (1e0 + exp(-logit)) AS probability
           FROM logits JOIN lab USING (id))"""
)


def gradient_sql() -> str:
    """Gradients of the network whose logits are all 0, each row of a tensor as one weighted sum.

    The halves get opposite gradients, so the first one is enough; values of both halves are equal.
    """
    times = lambda c: f"({c} % 5 + 1)"
    both = lambda half: f"list_sum(list_transform(x, lambda v, i: v * ({times('(i - 1)')} + {times(f'(i - 1 + {half})')})))"
    halves = [INPUTS // 2, *(h // 2 for h in HIDDEN)]
    ctes = [
        "d AS (SELECT id, 0.5e0 - label AS d FROM lab)",
        f"g3 AS (SELECT id, o, d * ((o % 3) - 1) / 2e0 AS g FROM h3 JOIN d USING (id), (SELECT unnest(range(0, {TOP})) AS o) WHERE x[o + 1] > 0)",
    ]
    for k in (3, 2, 1):
        inputs = INPUTS if k == 1 else HIDDEN[k - 2]
        edges = " UNION ALL ".join(
            f"SELECT o, {read('o', j, inputs)} AS i, {weight('o', j, k)} AS w FROM (SELECT unnest(range(0, {HIDDEN[k - 1] // 2})) AS o)"
            for j in range(4)
        )
        ctes.append(f"edges{k} AS ({edges})")
        mask = "" if k == 1 else f" JOIN h{k - 1} USING (id) WHERE x[i + 1] > 0"
        ctes.append(
            f"g{k - 1} AS MATERIALIZED (SELECT id, i AS o, g FROM (SELECT id, i, sum(g * w) AS g FROM g{k} JOIN edges{k} USING (o) GROUP BY id, i){mask})"
        )
    sums = ["s0 AS (SELECT id, list_sum(list_transform(x, lambda v, i: v * (%s))) AS s FROM x0)" % times("(i - 1)")]
    sums += [f"s{k} AS (SELECT id, {both(halves[k])} AS s FROM h{k})" for k in (1, 2, 3)]
    rows = []
    for k in (1, 2, 3):
        inputs = INPUTS if k == 1 else HIDDEN[k - 2]
        rows.append(f"""SELECT 'dense_{k}.weight' AS tensor, o AS row, {inputs} AS width, sum(g * s) AS weighted
  FROM g{k} JOIN s{k - 1} USING (id) GROUP BY o""")
        rows.append(f"""SELECT 'dense_{k}.weight', o + {HIDDEN[k - 1] // 2}, {inputs}, -sum(g * s) FROM g{k} JOIN s{k - 1} USING (id) GROUP BY o""")
        rows.append(f"""SELECT 'dense_{k}.bias', 0, {HIDDEN[k - 1]}, sum(g * ({times('o')} - {times(f'(o + {HIDDEN[k - 1] // 2})')})) FROM g{k}""")
    # output: wide slots, then the top units of both halves, which follow the wide ones
    rows.append(f"""SELECT 'out.weight', 0, w::INT + {HIDDEN[2]},
  (SELECT coalesce(sum(d * {times('slot')}), 0) FROM slots JOIN d USING (id))
  + (SELECT sum(d * list_sum(list_transform(x, lambda v, i: v * ({times('(w::INT + i - 1)')} + {times(f'(w::INT + i - 1 + {TOP})')})))) FROM h3 JOIN d USING (id), width)
  FROM width""")
    rows.append("SELECT 'out.bias', 0, 1, sum(d) FROM d")
    # embeddings: the first half of a tensor's columns stands at 128 * pos among all first halves
    rows.append(f"""SELECT 'emb:' || name, idx, dim, sum(g * ({times('(o - 128 * pos)')} - {times('(o - 128 * pos + dim // 2)')}))
  FROM g0 JOIN deep USING (id) WHERE o // 128 = pos GROUP BY name, idx, dim""")
    every = " UNION ALL ".join(
        [f"SELECT 'dense_{k}.weight' AS tensor, unnest(range(0, {h})) AS row, {i} AS width" for k, h, i in zip((1, 2, 3), HIDDEN, [INPUTS, *HIDDEN])]
        + [f"SELECT 'dense_{k}.bias', 0, {h}" for k, h in zip((1, 2, 3), HIDDEN)]
        + [f"SELECT 'out.weight', 0, w::INT + {HIDDEN[2]} FROM width", "SELECT 'out.bias', 0, 1",
           "SELECT DISTINCT 'emb:' || name, idx, dim FROM deep"]
    )
    return f"""WITH {LAYERS}, {', '.join([*ctes, *sums])},
found AS ({' UNION ALL '.join(rows)}),
every AS ({every})
SELECT tensor, CAST(row AS INT) AS row, CAST(e.width AS INT) AS width, CAST(coalesce(weighted, 0) AS DOUBLE) + 0e0 AS weighted
FROM every e LEFT JOIN found USING (tensor, row)"""


LOSS = "greatest({x}, 0e0) - {x} * {y} + ln(1e0 + exp(-abs({x})))"
FORMULA = "(((id * 37 + banner_pos * 11) % 101) - 50) / 10e0"
BUCKET = "(CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 100)"
SPLIT = f"CASE WHEN {BUCKET} < 70 THEN 'train' ELSE 'validation' END"

# Rows by id, three workers, chunks of 128.
SHARDS = """,
r AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS row_index, count(*) OVER () AS total FROM im),
p AS (SELECT *, CAST(ceil(total / 3e0) AS BIGINT) AS share FROM r),
s AS (SELECT *, CAST(row_index // share AS INT) AS worker, row_index % share AS worker_row FROM p),
b AS (SELECT *, worker_row // 128 AS batch FROM s)"""

# Feature files: names of all columns, and the values of a row as one text.
DENSE = LONG + """,
lists AS (SELECT im.id, label, coalesce(list(slot) FILTER (slot IS NOT NULL), []) AS slots
          FROM im JOIN lab USING (id) LEFT JOIN slots USING (id) GROUP BY im.id, label),
dense AS (SELECT id, array_to_string(list_transform(range(0, CAST(w AS BIGINT)), lambda i: CAST(list_contains(slots, i) AS INT)), ',') AS wide,
                 CAST(label AS INT) AS label, deep FROM lists JOIN deep_text USING (id), width),
heads AS (SELECT array_to_string(list_transform(range(0, CAST(w AS BIGINT)), lambda i: 'wide_feature_' || i), ',') AS wide_names,
                 (SELECT string_agg(concat_ws('SEP', name, ndv, dim), ',' ORDER BY d.pos) FROM dims d JOIN prof USING (name)) AS deep_names
          FROM width)"""
FEATURES = f"""WITH {DENSE} SELECT {{keep}}wide_names || ',label,' || deep_names AS names, '{{type}}' AS types,
    wide || ',' || label || ',' || deep AS line FROM dense, heads"""
FEATURE_ROW = FEATURES.format(keep="", type="double")
SCORES = f"WITH {NET} SELECT id, label, logit, round(probability, 10) AS probability FROM scored"
NUMBERS = "CAST(id AS DOUBLE) AS id, CAST(click AS DOUBLE) AS click, CAST(hour AS DOUBLE) AS hour"

DAILY = f""",
d AS (SELECT hour // 100 AS epoch, round(avg({LOSS.format(x=FORMULA, y="click")}), 8) AS val_loss
      FROM im GROUP BY hour // 100)"""

# Swap or not, round by round: the partner of a number, and the bit that both agree on.
HASHED = "CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"
OTHER = "((" + HASHED.format(x="concat_ws('/', '42', epoch, 'k', r)") + " - x) % n + n) % n"

ORACLE: dict[str, str] = {
    "scan_csv_header": f"""WITH {IM} SELECT * REPLACE (CAST(id AS INT) AS id,
        CAST(site_id AS INT) AS site_id, CAST(device_model AS INT) AS device_model) FROM im""",
    "scan_csv_positional": FEATURE_ROW,
    "scan_csv_glob": f"WITH {IM} SELECT {SPLIT} AS split, {NUMBERS}, true AS is_csv FROM im",
    "sink_csv_overwrite": f"WITH {IM} SELECT {NUMBERS} FROM im",
    "model_roundtrip": SCORES,
    "derive_hour": f"WITH {EN} SELECT id, hour, hr FROM en",
    "drop_tolerant": f"WITH {IM} SELECT * FROM im",
    "cross_features": f"WITH {EN} SELECT id, "
    + ", ".join(f'"{a}-{b}"' for a, b in CROSSES)
    + " FROM en",
    "select_by_type": f"""WITH {LONG} SELECT CAST(pos AS INT) AS pos, name, type,
        count(value) AS filled FROM cols JOIN l USING (name) GROUP BY pos, name, type""",
    "select_by_cardinality": f"""WITH {LONG} SELECT CAST(rank AS INT) AS rank, CAST(pos AS INT) AS pos,
        name, type, ndv, false AS has_null FROM sel""",
    "wide_columns": f"WITH {DENSE} SELECT id, wide_names AS names, 'double' AS types, wide AS line FROM dense, heads",
    "training_row": FEATURE_ROW,
    "rename_positional": FEATURE_ROW,
    "cast_float_features": FEATURES.format(keep="id, ", type="float"),
    "group_feature_arrays": f"WITH {DENSE} SELECT id, wide, deep, CAST(label AS DOUBLE) AS label FROM dense",
    "sigmoid_probability": f"""WITH {IM}, f AS (SELECT id, {FORMULA} AS logit FROM im)
SELECT id, logit, round(1e0 / (1e0 + exp(-logit)), 10) AS probability FROM f""",
    "cardinality_profile": f"""WITH {LONG} SELECT CAST(pos AS INT) AS pos, name, type, ndv,
        false AS has_null FROM prof""",
    "vocab_size": f"""WITH {LONG} SELECT CAST(d.pos AS INT) AS pos, name, p.ndv AS vocab
        FROM dims d JOIN prof p USING (name)""",
    "wide_dim": f"WITH {LONG} SELECT CAST(w AS BIGINT) AS wide_dim FROM width",
    "row_count": f"WITH {IM} SELECT {SPLIT} AS split, count(*) AS rows FROM im GROUP BY 1",
    "running_loss": f"""WITH {IM}{SHARDS},
g AS (SELECT worker AS epoch, 'train' AS split, batch, count(*) AS rows,
             avg({LOSS.format(x=FORMULA, y="click")}) AS loss FROM b GROUP BY worker, batch)
SELECT epoch, split, batch, rows, round(loss, 8) AS loss,
       round(sum(loss * rows) OVER o / sum(rows) OVER o, 8) AS running_loss
FROM g WINDOW o AS (PARTITION BY epoch, split ORDER BY batch)""",
    "best_epoch": f"""WITH {IM}{DAILY}
SELECT CAST(epoch AS BIGINT) AS epoch, val_loss FROM d ORDER BY val_loss, epoch LIMIT 1""",
    "batch_plan": f"""WITH {IM}{SHARDS},
w AS (SELECT worker, count(*) AS rows, count(DISTINCT batch) AS batches FROM b GROUP BY worker),
t AS (SELECT CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(batches) AS BIGINT) AS batches FROM w)
SELECT rows, CAST(ceil(ceil(rows / 3e0) / 128e0) AS BIGINT) AS per_worker,
       CAST(ceil(ceil(rows / 3e0) / 128e0) * 3 AS BIGINT) AS total, batches FROM t""",
    "rank_by_cardinality": f"""WITH {LONG} SELECT type,
        CAST(row_number() OVER (PARTITION BY type ORDER BY ndv DESC, pos) - 1 AS INT) AS rank, name, ndv
        FROM prof""",
    "shuffle_batches": f"""WITH {IM}{SHARDS},
g AS (SELECT worker, batch, count(*) AS rows FROM b GROUP BY worker, batch),
n AS (SELECT epoch, worker, batch, rows, worker * (max(batch) OVER () + 1) + batch AS number, count(*) OVER (PARTITION BY epoch) AS n
      FROM g, (SELECT unnest(range(1, 4)) AS epoch))
SELECT CAST(epoch AS INT) AS epoch, worker, batch, rows, list_reduce(list_prepend(number, range(0, 40)), lambda x, r:
    CASE WHEN {HASHED.format(x="concat_ws('/', '42', epoch, 'b', r, greatest(x, " + OTHER + "))")} % 2 = 1 THEN {OTHER} ELSE x END) AS position
FROM n""",
    "string_index": f"""WITH {LONG} SELECT l.id, name, CAST(v.idx AS DOUBLE) AS idx
        FROM l JOIN sel USING (name) JOIN vocab v USING (name, value)""",
    "embed_index": f"""WITH {LONG} SELECT id, concat_ws('SEP', d.name, p.ndv, dim) AS feature,
        CAST(idx AS DOUBLE) AS idx FROM deep d JOIN prof p USING (name)""",
    "label_index": f"WITH {LONG} SELECT id, click, label FROM im JOIN lab USING (id)",
    "one_hot": f"""WITH {LONG} SELECT l.id, name, CAST(s.ndv - 1 AS INT) AS width,
        CASE WHEN v.idx < s.ndv - 1 THEN v.idx ELSE -1 END AS position
        FROM l JOIN sel s USING (name) JOIN vocab v USING (name, value)""",
    "assemble_vector": f"""WITH {LONG} SELECT id, CAST(w AS INT) AS width, coalesce(slots, '') AS slots
        FROM im LEFT JOIN slot_text USING (id), width""",
    "fit_transform": f"""WITH {LONG} SELECT id, coalesce(slots, '') AS slots, deep, label
        FROM deep_text JOIN lab USING (id) LEFT JOIN slot_text USING (id)""",
    "vector_array": f"""WITH {LONG} SELECT im.id, CAST(w AS INT) AS width,
        CAST(coalesce(sum(slot), 0) AS DOUBLE) AS weighted
        FROM width, im LEFT JOIN slots ON slots.id = im.id GROUP BY im.id, w""",
    "feature_spec": f"""WITH {LONG} SELECT CAST(d.pos AS INT) AS pos, name, CAST(p.ndv AS INT) AS vocab,
        CAST(dim AS INT) AS dim FROM dims d JOIN prof p USING (name)""",
    "random_split": f"""WITH {IM} SELECT count(*) AS rows, count(DISTINCT id) AS ids,
        true AS near_share FROM im""",
    "file_batches": f"""WITH {IM} SELECT (count(*) + 2047) // 2048 AS batches, CAST(0 AS BIGINT) AS first,
        (count(*) + 2047) // 2048 - 1 AS last, count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids FROM im""",
    "hash_split": f"WITH {IM} SELECT id, {SPLIT} AS split FROM im",
    "repartition_files": f"""WITH {IM} SELECT (count(*) + 2047) // 2048 AS files, count(*) AS rows,
        CAST(sum(id) AS BIGINT) AS ids FROM im""",
    "shard_rows": f"WITH {IM}{SHARDS} SELECT id, row_index, worker, worker_row FROM b",
    "batch_rows": f"WITH {IM}{SHARDS} SELECT id, worker, batch FROM b",
    "embedding_lookup": f"""WITH {LAYERS} SELECT id,
        array_to_string(list_transform(x, lambda v: CAST(v * 2 AS INT)), ',') AS halves FROM x0""",
    "deep_tower": f"""WITH {LAYERS} SELECT id, array_to_string(list_transform(list_concat(x, x),
        lambda v: CAST(v * 16 AS INT)), ',') AS sixteenths FROM h3""",
    "wide_deep_logit": f"WITH {NET} SELECT id, logit FROM scored",
    "score_table": SCORES,
    "log_loss": f"WITH {IM} SELECT round(avg({LOSS.format(x=FORMULA, y='click')}), 9) AS log_loss FROM im",
    "roc_auc": f"""WITH {IM}, f AS (SELECT {FORMULA} AS score, click FROM im),
g AS (SELECT score, sum(click) AS pos, count(*) - sum(click) AS neg FROM f GROUP BY score),
o AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
SELECT round(CAST(sum(pos * (below + neg / 2e0)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE), 9)
       AS roc_auc FROM o""",
    "batch_gradient": gradient_sql(),
    "validate": f"""WITH {NET} SELECT round(avg({LOSS.format(x='logit', y='label')}), 9) AS log_loss
        FROM scored WHERE {BUCKET} >= 70""",
    "lr_schedule": f"""WITH {IM}, d AS (SELECT hour // 100 AS day, count(*) AS rows FROM im GROUP BY 1),
n AS (SELECT *, row_number() OVER (ORDER BY day) - 1 AS epoch FROM d)
SELECT CAST(day AS BIGINT) AS day, rows, epoch, round(0.001e0 * power(0.1e0, epoch // 5), 12) AS lr FROM n""",
}
