"""One query per operator, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.scalar import logistic_loss, sigmoid
from clickloom.operators import batches as bt
from clickloom.operators import encode as en
from clickloom.operators import evaluate as ev
from clickloom.operators import network as nw
from clickloom.operators import profile as pf
from clickloom.operators import split as sp
from clickloom.operators import train as tr
from clickloom.operators.ordering import with_row_index
from clickloom.plans.feature_job import DEEP_DIMS, Features, featurize
from clickloom.plans.formula_network import CYCLE, formula_table
from clickloom.plans.impression_view import enriched, impressions
from clickloom.session import col, freeze, scratch_dir
from clickloom.sources import features_io as io
from clickloom.sources import impressions as src
from clickloom.sources import model_io

WORKERS, CHUNK = 3, 128
# Rows of a written file; a file is one batch.
FILE_ROWS = 2048

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def file_number(df: DataFrame) -> int:
    return max(1, -(-df.count() // FILE_ROWS))


def features(spark: SparkSession, folder: str) -> Features:
    return featurize(enriched(spark, folder))


def formula(spark: SparkSession, f: Features, balanced: bool = False) -> DataFrame:
    return formula_table(spark, f.encoding.spec, f.encoding.wide_dim, balanced)


def formula_logit() -> Column:
    """A score with many ties, computed from the row."""
    return ((F.col("id") * 37 + F.col("banner_pos") * 11) % 101 - 50) / F.lit(10).cast("double")


def numbered(spark: SparkSession, folder: str, *cols: str) -> DataFrame:
    rows = impressions(spark, folder).select("id", *cols)
    return bt.shard_rows(with_row_index(rows, ["id"]), WORKERS)


def dense_features(spark: SparkSession, folder: str) -> tuple[DataFrame, Features]:
    """Rows with one column per wide slot, the label and the deep indexes, in the order of the
    feature files, after ``id``."""
    f = features(spark, folder)
    return en.dense_rows(f.rows, f.encoding.wide_dim, f.encoding.spec, keep=["id"]), f


def names_of(f: Features) -> list[str]:
    return en.feature_names(f.encoding.wide_dim, f.encoding.spec)


def line(cols: Sequence[str]) -> Column:
    """Columns that hold whole numbers, as one text."""
    return F.array_join(en.gathered(cols, "int").cast("array<string>"), ",")


def told(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of many columns as (keep, names, types, line): all names, the types met, all values."""
    cols = [c for c in df.columns if c not in keep]
    types = sorted({t for n, t in df.dtypes if n in cols})
    return df.select(
        *[col(c) for c in keep], F.lit(",".join(cols)).alias("names"), F.lit(",".join(types)).alias("types"),
        line(cols).alias("line"),
    )


def wide_encoding(spark: SparkSession, folder: str) -> tuple[DataFrame, en.Encoding]:
    """The rows and the fitted encoding of all wide columns, from one counting scan."""
    df = enriched(spark, folder)
    return df, featurize(df, ()).encoding


def wide_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with the assembled vector of all wide columns."""
    df, encoding = wide_encoding(spark, folder)
    return en.slot_vector(encoding.transform(df), encoding.wide_dim)


def text(array: str) -> Column:
    return F.array_join(col(array).cast("array<string>"), ",")


# --- scans, sources, sinks ---------------------------------------------------------------


@query
def scan_csv_header(spark, folder):
    path = scratch_dir(spark)
    impressions(spark, folder).write.option("header", True).csv(path)
    return src.read_impressions(spark, path)


@query
def scan_csv_positional(spark, folder):
    rows, f = dense_features(spark, folder)
    path = scratch_dir(spark)
    io.write_features(rows.drop("id"), path)
    return told(io.read_features(spark, path, names_of(f)))


@query
def scan_csv_glob(spark, folder):
    root = scratch_dir(spark)
    rows = sp.hash_split(impressions(spark, folder), "id").select("id", "click", "hour", "split")
    parts = []
    for name in ("train", "validation"):
        part = rows.where(F.col("split") == name).drop("split")
        io.write_features(part, f"{root}/{name}")
        part.write.mode("append").json(f"{root}/{name}")
        read = io.read_features(spark, f"{root}/{name}", ["id", "click", "hour"])
        parts.append(read.select(F.lit(name).alias("split"), "*", "_metadata.file_path"))
    return reduce(DataFrame.unionByName, parts).select(
        "split", "id", "click", "hour", F.col("file_path").endswith(".csv").alias("is_csv")
    )


@query
def sink_csv_overwrite(spark, folder):
    path = scratch_dir(spark)
    df = impressions(spark, folder)
    io.write_features(df.select("hour", "hour", "hour"), path)
    io.write_features(df.select("id", "click", "hour"), path, n_files=file_number(df))
    return io.read_features(spark, path, ["id", "click", "hour"])


@query
def model_roundtrip(spark, folder):
    """Encoders and parameters saved by one session; another one scores raw rows."""
    f, path = features(spark, folder), scratch_dir(spark)
    model_io.save_model(f.encoding, formula(spark, f), path)
    other = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        other.conf.set(name, spark.conf.get(name))
    return _scores(model_io.load_model(other, path).score(enriched(other, folder)))


# --- projections and scalar expressions --------------------------------------------------


@query
def derive_hour(spark, folder):
    return src.derive_hour(impressions(spark, folder)).select("id", "hour", "hr")


@query
def drop_tolerant(spark, folder):
    df = impressions(spark, folder).withColumn("_c0", F.col("id"))
    return src.drop_tolerant(df, "_c0", "no_such_column")


@query
def cross_features(spark, folder):
    names = [f"{a}-{b}" for a, b in src.CROSSES]
    return enriched(spark, folder).select("id", *[col(n) for n in names])


@query
def select_by_type(spark, folder):
    df = enriched(spark, folder)
    filled = df.agg(*[F.count(col(c)).alias(c) for c in pf.candidates(df)])
    filled = filled.unpivot([], [col(c) for c in filled.columns], "name", "filled")
    return pf.columns_by_type(df).join(filled, "name")


@query
def select_by_cardinality(spark, folder):
    return featurize(enriched(spark, folder), ()).selected


@query
def wide_columns(spark, folder):
    f = features(spark, folder)
    vectors = en.vector_array(en.slot_vector(f.rows.select("id", "slots"), f.encoding.wide_dim))
    return told(en.wide_columns(vectors.select("id", "wide_features"), f.encoding.wide_dim), ["id"])


@query
def training_row(spark, folder):
    return told(dense_features(spark, folder)[0].drop("id"))


@query
def rename_positional(spark, folder):
    rows, f = dense_features(spark, folder)
    rows = rows.drop("id")
    raw = rows.toDF(*[f"_c{i}" for i in range(len(rows.columns))])
    return told(en.rename_positional(raw, names_of(f)))


@query
def cast_float_features(spark, folder):
    return told(en.cast_float(dense_features(spark, folder)[0], keep=["id"]), ["id"])


@query
def group_feature_arrays(spark, folder):
    rows, f = dense_features(spark, folder)
    names = [d.feature for d in f.encoding.spec]
    arrays = en.group_arrays(rows, f.encoding.wide_dim, names, keep=["id"])
    whole = arrays.withColumn("wide", F.col("wide").cast("array<int>"))
    return whole.select("id", text("wide").alias("wide"), text("deep").alias("deep"), "label")


@query
def sigmoid_probability(spark, folder):
    df = impressions(spark, folder).select("id", formula_logit().alias("logit"))
    return ev.probability(df).withColumn("probability", F.round("probability", 10))


# --- aggregations ------------------------------------------------------------------------


@query
def cardinality_profile(spark, folder):
    return pf.profile(enriched(spark, folder))


@query
def vocab_size(spark, folder):
    return pf.vocab_sizes(impressions(spark, folder), [n for n, _ in DEEP_DIMS])


@query
def wide_dim(spark, folder):
    return pf.wide_dim(featurize(enriched(spark, folder), ()).selected)


@query
def row_count(spark, folder):
    return sp.row_counts(sp.hash_split(impressions(spark, folder), "id"))


def batch_losses(spark, folder) -> DataFrame:
    rows = bt.batch_rows(numbered(spark, folder, "banner_pos", "click"), CHUNK)
    loss = logistic_loss(formula_logit(), F.col("click"))
    return rows.groupBy(F.col("worker").alias("epoch"), F.lit("train").alias("split"), "batch").agg(
        F.avg(loss).alias("loss"), F.count("*").alias("rows")
    )


@query
def running_loss(spark, folder):
    return ev.running_loss(batch_losses(spark, folder)).select(
        "epoch", "split", "batch", "rows", F.round("loss", 8).alias("loss"),
        F.round("running_loss", 8).alias("running_loss"),
    )


def daily_losses(spark, folder) -> DataFrame:
    """(epoch, val_loss): the loss of each day, days standing in for epochs."""
    df = impressions(spark, folder)
    loss = logistic_loss(formula_logit(), F.col("click"))
    return df.groupBy(F.expr("hour div 100").alias("epoch")).agg(
        F.round(F.avg(loss), 8).alias("val_loss")
    )


@query
def best_epoch(spark, folder):
    return tr.best_epoch(daily_losses(spark, folder))


@query
def batch_plan(spark, folder):
    return bt.batch_plan(numbered(spark, folder), WORKERS, CHUNK)


# --- sorts -------------------------------------------------------------------------------


@query
def rank_by_cardinality(spark, folder):
    return pf.rank_columns(pf.profile(enriched(spark, folder))).select("type", "rank", "name", "ndv")


@query
def shuffle_batches(spark, folder):
    sizes = bt.batch_sizes(bt.batch_rows(numbered(spark, folder), CHUNK))
    return bt.shuffle_batches(sizes, epochs=3)


# --- feature encoders --------------------------------------------------------------------


@query
def string_index(spark, folder):
    df, encoding = wide_encoding(spark, folder)
    wide = encoding.wide
    table = encoding.index(df).select("id", *[col(f"{c}__idx").cast("double").alias(c) for c in wide])
    return table.unpivot("id", [col(c) for c in wide], "name", "idx")


@query
def embed_index(spark, folder):
    df, names = impressions(spark, folder), [n for n, _ in DEEP_DIMS]
    counts = freeze(pf.value_counts(df, [*names, "click"]))
    encoding = en.fit_encoding(counts, [], list(DEEP_DIMS))
    found = [col(f"{d.name}__idx").cast("double").alias(d.feature) for d in encoding.spec]
    rows = encoding.index(df).select("id", *found)
    return rows.unpivot("id", [d.feature for d in encoding.spec], "feature", "idx")


@query
def label_index(spark, folder):
    rows = en.fit_transform(impressions(spark, folder), en.build_pipeline(["banner_pos"], []))
    return rows.select("id", "click", "label")


@query
def one_hot(spark, folder):
    df, encoding = wide_encoding(spark, folder)
    # Position of the one, -1 where the last value is left to all zeros.
    arrays = [
        F.struct(
            F.lit(c).alias("name"), F.lit(width).alias("width"),
            F.when(col(f"{c}__idx") < width, col(f"{c}__idx")).otherwise(-1).cast("bigint").alias("position"),
        )
        for c, width in zip(encoding.wide, encoding.widths)
    ]
    return encoding.index(df).select("id", F.inline(F.array(*arrays)))


@query
def assemble_vector(spark, folder):
    # the text of a sparse vector: (size,[positions],[values])
    vector = wide_vectors(spark, folder).select("id", F.col("wide_features_v").cast("string").alias("v"))
    return vector.select(
        "id", F.regexp_extract("v", r"^\((\d+),", 1).cast("int").alias("width"),
        F.regexp_extract("v", r"\[([\d,]*)\],\[[1.0,]*\]\)$", 1).alias("slots"),
    )


@query
def fit_transform(spark, folder):
    f = features(spark, folder)
    return f.rows.select("id", text("slots").alias("slots"), text("deep").alias("deep"), "label")


@query
def vector_array(spark, folder):
    rows = en.vector_array(wide_vectors(spark, folder))
    weighted = F.aggregate(
        F.transform("wide_features", lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x
    )
    return rows.select("id", F.size("wide_features").alias("width"), weighted.alias("weighted"))


@query
def feature_spec(spark, folder):
    sizes = pf.vocab_sizes(impressions(spark, folder), [n for n, _ in DEEP_DIMS])
    dims = F.element_at(F.create_map(*[F.lit(x) for pair in DEEP_DIMS for x in pair]), F.col("name"))
    names = sizes.select("pos", F.concat_ws(en.SEP, "name", "vocab", dims).alias("feature"))
    return en.feature_spec(names)


# --- split, partitioning, batching -------------------------------------------------------


@query
def random_split(spark, folder):
    """Row totals of both parts together: no row lost, none in both, shares as asked for."""
    parts = sp.random_split(freeze(impressions(spark, folder).select("id")))
    named = [p.select("id", F.lit(n).alias("split")) for p, n in zip(parts, ("train", "validation"))]
    share = F.avg((F.col("split") == "train").cast("double"))
    per_id = named[0].unionByName(named[1])
    return per_id.agg(
        F.count("*").alias("rows"),
        F.countDistinct("id").alias("ids"),
        (F.abs(share - 0.7) < 0.03).alias("near_share"),
    )


@query
def hash_split(spark, folder):
    return sp.hash_split(impressions(spark, folder).select("id"), "id")


@query
def repartition_files(spark, folder):
    path = scratch_dir(spark)
    df = impressions(spark, folder).select("id", "click", "hour")
    io.write_features(df, path, n_files=file_number(df))
    read = io.read_features(spark, path, ["id", "click", "hour"])
    files = read.groupBy("_metadata.file_path").agg(
        F.count("*").alias("rows"), F.sum("id").cast("bigint").alias("ids")
    )
    return files.agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("ids").alias("ids")
    )


@query
def shard_rows(spark, folder):
    return numbered(spark, folder).select("id", "row_index", "worker", "worker_row")


@query
def batch_rows(spark, folder):
    return bt.batch_rows(numbered(spark, folder), CHUNK).select("id", "worker", "batch")


@query
def file_batches(spark, folder):
    path = scratch_dir(spark)
    df = impressions(spark, folder).select("id", "click", "hour")
    io.write_features(df, path, n_files=file_number(df))
    read = bt.file_batches(io.read_features(spark, path, ["id", "click", "hour"]))
    batches = read.groupBy("batch").agg(
        F.count("*").alias("rows"), F.sum("id").cast("bigint").alias("ids")
    )
    return batches.agg(
        F.count("*").alias("batches"), F.min("batch").alias("first"), F.max("batch").alias("last"),
        F.sum("rows").alias("rows"), F.sum("ids").alias("ids"),
    )


# --- model -------------------------------------------------------------------------------


def _scores(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability", F.round("probability", 10))


@query
def embedding_lookup(spark, folder):
    f = features(spark, folder)
    found = nw.embedding_lookup(f.rows.select("id", "deep"), formula(spark, f), f.encoding.spec)
    halves = F.transform("embedded", lambda x: (x * 2).cast("int"))
    return found.select("id", F.array_join(halves.cast("array<string>"), ",").alias("halves"))


@query
def deep_tower(spark, folder):
    f = features(spark, folder)
    params = formula(spark, f)
    found = nw.embedding_lookup(f.rows.select("id", "deep"), params, f.encoding.spec)
    units = F.transform("tower", lambda x: (x * 16).cast("int"))
    return nw.deep_tower(found, params).select(
        "id", F.array_join(units.cast("array<string>"), ",").alias("sixteenths")
    )


@query
def wide_deep_logit(spark, folder):
    f = features(spark, folder)
    params = formula(spark, f)
    found = nw.embedding_lookup(f.rows.select("id", "slots", "deep"), params, f.encoding.spec)
    return nw.logit(nw.deep_tower(found, params), params).select("id", "logit")


@query
def score_table(spark, folder):
    f = features(spark, folder)
    return _scores(nw.score_table(f.rows, formula(spark, f), f.encoding.spec))


@query
def log_loss(spark, folder):
    df = impressions(spark, folder).select(formula_logit().alias("logit"), "click")
    return ev.log_loss(df, label="click").select(F.round("log_loss", 9).alias("log_loss"))


@query
def roc_auc(spark, folder):
    df = impressions(spark, folder).select(formula_logit().alias("logit"), "click")
    return ev.roc_auc(df, "logit", "click").select(F.round("roc_auc", 9).alias("roc_auc"))


@query
def batch_gradient(spark, folder):
    """All tensors of the network at its published widths; a row of a tensor as one weighted sum."""
    f = features(spark, folder)
    sums = tr.batch_gradient(f.rows, formula(spark, f, balanced=True), f.encoding.spec)
    weight = lambda x, i: x.cast("double") * (i % CYCLE + 1)
    total = F.aggregate(F.transform("values", weight), F.lit(0.0), lambda a, x: a + x)
    return sums.where(F.col("tensor") != tr.TOTAL).select(
        "tensor", "row", F.size("values").alias("width"), total.alias("weighted")
    )


def _split_rows(spark, folder) -> tuple[Features, DataFrame, DataFrame]:
    f = features(spark, folder)
    rows = sp.hash_split(f.rows.select("id", "slots", "deep", "label"), "id")
    return f, rows.where(F.col("split") == "train"), rows.where(F.col("split") == "validation")


@query
def train_rounds(spark, folder):
    """The network at full widths."""
    f, train, _ = _split_rows(spark, folder)
    fitted = tr.fit(train, f.encoding.spec, f.encoding.wide_dim, epochs=1, workers=4, key="id")
    norm = F.sqrt(F.sum(F.aggregate("values", F.lit(0.0), lambda a, x: a + x * x)))
    return fitted.params.groupBy("tensor").agg(F.count("*").alias("rows"), norm.alias("norm"))


@query
def validate(spark, folder):
    f, _, held_out = _split_rows(spark, folder)
    return tr.validate(held_out, formula(spark, f), f.encoding.spec).select(F.round("log_loss", 9).alias("log_loss"))


@query
def lr_schedule(spark, folder):
    days = impressions(spark, folder).groupBy(F.expr("hour div 100").alias("day")).agg(
        F.count("*").alias("rows")
    )
    epochs = with_row_index(days, ["day"], "epoch")
    return tr.lr_schedule(epochs).withColumn("lr", F.round("lr", 12))


@query
def loss_history(spark, folder):
    f, train, validation = _split_rows(spark, folder)
    return tr.fit(
        train, f.encoding.spec, f.encoding.wide_dim, validation, epochs=3, workers=4, key="id"
    ).history


@query
def gbt_baseline(spark, folder):
    df, encoding = wide_encoding(spark, folder)
    rows = sp.hash_split(encoding.index(df), "id")
    # Trees split the values of nominal columns into sets; only doubles can be marked as such.
    nominal = {
        f"{c}__idx": col(f"{c}__idx").cast("double").alias(
            f"{c}__idx", metadata={"ml_attr": {"type": "nominal", "num_vals": encoding.sizes[c]}}
        )
        for c in encoding.wide
    }
    table = VectorAssembler(inputCols=list(nominal), outputCol="features").transform(
        rows.select("id", "split", col("click__idx").cast("double").alias("label"), *nominal.values())
    )
    model = tr.gbt_baseline(
        table.where(F.col("split") == "train").select("features", "label")
    )
    scored = model.transform(table.where(F.col("split") == "validation"))
    return scored.select(
        "id", "label", F.element_at(en.vector_to_array("probability"), 2).alias("probability")
    )
