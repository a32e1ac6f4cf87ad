"""Models, text, vectors, streaming and whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ...constants import LIFT_MAX, LIFT_MIN, MOVE_FEATURES, PLANOGRAM_COLUMNS
from ...functions.numbers import half_up
from ...operators import inventory as I, knowledge as KB, layout as L, learning as ML
from ...operators import replies as RE, vector_cells as VC, vectors as V
from ...operators.enrich import batch_rows
from ...session import shared_dir, written
from ...sources import readers, sinks
from ...streaming.ingest import stream_ingest
from .. import jobs, tables as T
from . import sql as S
from .knowledge import _DOC, _NAME, _with_text
from .sales import _features


def _samples(spark, d):
    """Written training and test moves of the planogram."""
    return jobs.lift_samples(written(T.planogram(spark, d)), min_products=3)


def _facts(spark, *facts):
    """Rows of ``fact, holds``; each ``holds`` is a DataFrame of one boolean."""
    return reduce(DataFrame.unionByName, [
        df.toDF("holds").select(F.lit(name).alias("fact"), "holds") for name, df in facts])


def _beats_mean(metrics):
    """Whether a model errs less than the mean of the test rows would."""
    return metrics.select((F.col("r2") > 0) & (F.col("mae") >= 0))


def _linear_fit(spark, d):
    """What must hold for a least squares fit: its residuals leave nothing to any feature.

    A fit on fewer rows than asked for must fail.
    """
    train, test = _samples(spark, d)
    model, metrics = ML.fit_lift(train, test, "linear")
    try:
        ML.fit_lift(train.limit(50), test, "linear")
        refused = False
    except ML.NotEnoughRows:
        refused = True
    rest = model.transform(train).withColumn("rest", F.col("profit_lift") - F.col("prediction"))

    def left_to(x):
        """Cosine between the residuals and a centred feature."""
        size = F.sqrt(F.sum(F.col("rest") ** 2) * F.count(F.lit(1)) * F.var_pop(x))
        return F.try_divide(F.sum("rest") * F.avg(x) - F.sum(F.col("rest") * F.col(x)), size)

    cosines = rest.agg(*[left_to(x).alias(x) for x in MOVE_FEATURES],
                       F.try_divide(F.sum("rest"), F.sum(F.abs("rest"))).alias("mean"))
    orthogonal = cosines.select(F.explode(F.create_map(*[
        e for x in (*MOVE_FEATURES, "mean") for e in (F.lit(x), F.col(x))])).alias("fact", "c")).select(
        "fact", (F.abs("c") < 1e-6).alias("holds"))
    return orthogonal.unionByName(_facts(
        spark, ("beats the mean", _beats_mean(metrics)),
        ("refuses few rows", spark.range(1).select(F.lit(refused)))))


def _tree_fit(spark, d):
    train, test = _samples(spark, d)
    model, metrics = ML.fit_lift(train, test, "gbt")
    return _facts(spark, ("beats the mean", _beats_mean(metrics)), (
        "importances add up", ML.feature_importances(model).agg(
            F.abs(F.sum("importance") - 1) < 1e-6)))


def _planogram_model(spark, d):
    """Boosted trees, saved and loaded again: facts that hold whatever the trees are."""
    path = shared_dir(spark)
    data = written(I.with_lift(_features(spark, d)))
    model, metrics = ML.fit_planogram_lift(data)
    ML.save_model(model, path)
    loaded = ML.load_model(path)
    once = ML.predict_planogram_lift(model, data).withColumnRenamed("prediction", "a")
    both = ML.predict_planogram_lift(loaded, once.drop("features")).select(
        "a", F.col("prediction").alias("b"))
    checked = written(both.agg(F.min("b").alias("least"), F.max("b").alias("most"),
                               F.max(F.abs(F.col("a") - F.col("b"))).alias("apart")))
    return _facts(
        spark, ("beats the mean", _beats_mean(metrics)),
        ("importances add up", ML.feature_importances(loaded).agg(F.abs(F.sum("importance") - 1) < 1e-6)),
        ("within the bounds", checked.select(
            (F.col("least") >= LIFT_MIN) & (F.col("most") <= LIFT_MAX))),
        ("the same after loading", checked.select(F.col("apart") == 0)))


def _model_layout(spark, d):
    """Racks under a layout by model scores: rows kept, no shelf filled beyond its width."""
    df = written(T.planogram(spark, d))
    model, _ = ML.fit_lift(*_samples(spark, d), "linear")
    layout = written(L.scored_layout(ML.model_scores(model, df)))
    moved = df.select("month_key", "rack_id", "product_id", F.col("shelf_level").alias("_from")).join(
        layout, ["month_key", "rack_id", "product_id"])
    received = moved.groupBy("month_key", "rack_id", "shelf_level").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("shelf_level") != F.col("_from")).alias("got"),
        F.sum("product_width_cm").alias("w"))
    return received.groupBy("month_key", "rack_id").agg(
        F.sum("n").alias("n_products"),
        F.max(F.col("got") & (F.col("w") > 300.0001)).alias("overfilled"))


def _layout_score(spark, d):
    """Scores of racks, and whether they are the model's formula summed up."""
    df = written(T.planogram(spark, d))
    model, _ = ML.fit_lift(*_samples(spark, d), "linear")
    fitted = model.stages[-1]
    formula = sum((F.col(c) * float(w) for c, w in zip(MOVE_FEATURES, fitted.coefficients)),
                  F.lit(float(fitted.intercept)))
    plain = ML.layout_features(df).groupBy("month_key", "rack_id").agg(
        F.count(F.lit(1)).alias("n_products"), F.sum(formula).alias("plain"))
    same = F.abs(F.col("score") - F.col("plain")) <= 1e-6 * (1 + F.abs("plain"))
    return ML.layout_score(model, df).join(plain, ["month_key", "rack_id"]).select(
        "month_key", "rack_id", "n_products", same.alias("as_formula"))


def _chunks(spark, d):
    """The ten features of every product where it stands, ten products of a rack each."""
    chunks = ML.chunk_rows(ML.layout_features(T.planogram(spark, d)))
    text = F.transform("rows", lambda r: F.array_join(F.array(
        *[F.format_string("%.2f", half_up(r[c].cast("double"), 2)) for c in MOVE_FEATURES]), "|"))
    return chunks.select("month_key", "rack_id", "chunk_id", F.array_join(text, ",").alias("rows"))


def _nearest(spark, d):
    vectors = T.table(spark, d, "embeddings")
    queries = V.centroids(vectors).withColumnRenamed("label", "query_id")
    top = V.cosine_topk(queries, vectors, 5)
    return top.select("query_id", "vec_id", "rank", half_up("similarity", 6).alias("similarity"))


def _all_nearest(spark, d):
    """The nearest vectors of every vector, itself included."""
    vectors = T.table(spark, d, "embeddings")
    top = V.cosine_topk(vectors.withColumnRenamed("vec_id", "query_id"), vectors, 3)
    return top.select("query_id", "vec_id", "rank", half_up("similarity", 6).alias("similarity"))


def _nearest_in_cells(spark, d):
    """The nearest vectors of every vector, from cells that were stored before."""
    path, vectors = shared_dir(spark), T.table(spark, d, "embeddings")
    VC.store_cells(vectors, path, cells=32)
    top = VC.cells_topk(vectors.withColumnRenamed("vec_id", "query_id"), path, 3)
    return top.select("query_id", "vec_id", "rank", half_up("similarity", 6).alias("similarity"))


def _vector_problems(spark, d):
    """Every tenth vector lacks its last entry, every seventh is all zero."""
    k, e = F.col("vec_id"), F.col("embedding")
    broken = T.table(spark, d, "embeddings").withColumn("embedding", F.when(
        k % 10 == 0, F.slice(e, 1, F.size(e) - 1)).when(
        k % 7 == 0, F.transform(e, lambda x: F.lit(0.0).cast("float"))).otherwise(e))
    return V.vector_problems(broken)


# --- replies ----------------------------------------------------------------------------

def _batches(spark, d):
    """Batches of thirty products per month, written once."""
    return written(batch_rows(T.planogram(spark, d), 30))


def _estimate_replies(batches):
    """One reply per batch, written from the products themselves.

    By ``batch_id % 5``: plain, fenced, without the first key in every element,
    with an element too many, and cut off.
    """
    k = F.col("product_id")
    item = F.struct(
        F.col("item_no"), F.to_json(F.struct(
            (k % 40).alias("estimated_monthly_sales"),
            ((k % 80) + 0.5).alias("profit_margin_percentage"),
            ((k % 70) + 0.25).alias("product_width_cm"))).alias("full"),
        F.to_json(F.struct(
            ((k % 80) + 0.5).alias("profit_margin_percentage"),
            ((k % 70) + 0.25).alias("product_width_cm"))).alias("partial"))
    grouped = batches.groupBy("month_key", "batch_id").agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    full = F.array_join(F.transform("items", lambda i: i["full"]), ", ")
    partial = F.array_join(F.transform("items", lambda i: i["partial"]), ", ")
    form = F.col("batch_id") % 5
    text = (F.when(form == 0, F.concat(F.lit("["), full, F.lit("]")))
            .when(form == 1, F.concat(F.lit("```json\n["), full, F.lit("]\n```")))
            .when(form == 2, F.concat(F.lit("["), partial, F.lit("]")))
            .when(form == 3, F.concat(F.lit("Here: ["), full, F.lit(", {}]")))
            .otherwise(F.concat(F.lit("["), full, F.lit(", {\"esti]"))))
    return grouped.select("month_key", "batch_id", text.alias("reply_text"))


def _estimates(spark, d):
    batches = _batches(spark, d)
    return RE.parse_estimates(_estimate_replies(batches), batches.select(
        "month_key", "batch_id", "item_no", "product_id"))


def _multiplier_replies(spark, d):
    """One reply per month: category -> mean margin / 35, some of them unreadable."""
    means = T.planogram(spark, d).groupBy("month_key", "category").agg(
        (F.sum("estimated_monthly_sales") % 400 / 100).alias("m"))
    json = F.to_json(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("category", "m")))))
    form = F.substring("month_key", 6, 2).cast("int") % 4
    return means.groupBy("month_key").agg(json.alias("json")).select(
        "month_key", F.when(form == 0, F.col("json"))
        .when(form == 1, F.concat(F.lit("```json\n"), F.col("json"), F.lit("\n```")))
        .when(form == 2, F.concat(F.lit("The answer is "), F.col("json"), F.lit(" as asked")))
        .otherwise(F.concat(F.lit("{\"a\": \"high\", "), F.substring_index("json", "{", -1)))
        .alias("reply_text"))


def _forecast_prompt(spark, d):
    df = T.planogram(spark, d)
    context = KB.retrieve_context(KB.kb_chunks(df), 2000, 3)
    return RE.forecast_prompt(context, KB.latest_month(df), 2000, 3, lines=20)


def _prompt_lines(spark, d):
    sample = RE.prompt_sample(KB.latest_month(T.planogram(spark, d)))
    return sample.select("line_no", "product_id", RE.product_line().alias("line"))


# --- files and streams --------------------------------------------------------------------

def _in_parts(df, folder, parts=3):
    """Monthly files of several parts each; Spark cuts them, no task holds all months."""
    rows = df.withColumn("source_file", sinks.month_file())
    for k in range(parts):
        part = rows.filter(F.col("product_id") % parts == k)
        (part.select(*sinks._planogram_columns(part), "source_file").hint("rebalance", "source_file").write
         .mode("append").partitionBy("source_file").option("header", True).csv(folder))


def _two_files(spark, d):
    """Two files of every month; the one that sorts last has shelf 3 only."""
    base = shared_dir(spark)
    df = _with_text(spark, d)
    df = df.withColumn("name", F.concat_ws("-", "name", F.col("product_id")))
    for tail, part in (("_a", df), ("_b", df.filter(F.col("shelf_level") == 3))):
        out = part.withColumn("source_file", F.regexp_replace(
            sinks.month_file(), r"\.csv$", f"{tail}.csv"))
        (out.select(*sinks._planogram_columns(out), "source_file").write.mode("append")
         .partitionBy("source_file").option("header", True).csv(f"{base}/monthly"))
    jobs.build_knowledge_base(spark, f"{base}/monthly", f"{base}/kb")
    return spark.read.parquet(f"{base}/kb")


def _streamed(spark, d):
    """Months arrive in two runs; the second one also replaces the months of 1998.

    The months of 1998 are written in several parts, which micro-batches of a few files
    tear apart.
    """
    base = shared_dir(spark)
    folder, kb, done = f"{base}/monthly", f"{base}/kb", f"{base}/checkpoint"
    df = _with_text(spark, d).withColumn("name", F.concat_ws("-", "name", F.col("product_id")))
    first = df.filter(F.col("month_key") < "1999_01")
    sinks.write_monthly(first.filter(~F.col("month_key").startswith("1998")), folder)
    _in_parts(first.filter(F.col("month_key").startswith("1998")), folder)
    stream_ingest(spark, folder, kb, done, by_folder=True, max_files=25).awaitTermination()
    later = df.filter((F.col("month_key") >= "1999_01")
                      | (F.col("month_key").startswith("1998") & (F.col("shelf_level") > 2)))
    sinks.write_monthly(later, folder)
    stream_ingest(spark, folder, kb, done, by_folder=True).awaitTermination()
    return spark.read.parquet(kb).select(
        "month_key", "category", "n_products", half_up("total_sales", 2).alias("total_sales"))


def _layout_files(spark, d):
    """Layouts of two models, written one folder per model and read back."""
    path = shared_dir(spark)
    df = _with_text(spark, d).withColumnRenamed("category", "Category")
    cols = PLANOGRAM_COLUMNS
    layouts = df.select(*cols).withColumn("model", F.lit("original")).unionByName(
        df.withColumn("shelf_level", F.lit(4)).select(*cols).withColumn(
            "model", F.lit("greedy")))
    sinks.write_layouts(layouts, path)
    return readers.read_layouts(spark, path).groupBy("model", "shelf_level").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("estimated_monthly_sales").cast("bigint").alias("sales"))


def _prediction_files(spark, d):
    """Layout and multipliers of a target month, written and read back."""
    df = KB.latest_month(T.planogram(spark, d))
    mult = df.select("category").distinct().withColumn(
        "multiplier", F.length("category") / 5.0)
    layout, forecast = sinks.write_prediction(df, mult, shared_dir(spark), 2001, 12)
    rows = spark.read.option("header", True).csv(layout).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"))
    return rows.join(spark.read.schema("category string, multiplier double").json(forecast),
                     "category")


def _results_json(spark, d):
    """Results per brand as one JSON object, written and read back."""
    path = shared_dir(spark)
    part = T.table(spark, d, "part")
    numbers = part.groupBy("p_brand").agg(F.struct(
        F.lit(None).cast("double").alias("mse"),
        F.sum("p_size").cast("double").alias("original_profit"),
        F.max("p_retailprice").alias("optimized_profit")).alias("r"))
    text = numbers.agg(F.to_json(F.map_from_entries(
        F.collect_list(F.struct("p_brand", "r")))).alias("value"))
    text.write.text(path)
    return readers.read_results(spark, path)


def _category_seed(spark, d):
    """A category seed written from the nations, read with its schema."""
    path = shared_dir(spark)
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    rows = T.table(spark, d, "nation").select(F.struct(
        k.alias("id"), F.col("n_name").alias("name"),
        (k / 8).alias("base_demand_mean_per_day"), (r / 16).alias("seasonality_amp"),
        F.lit(0.25).alias("margin_avg"), (k + 0.5).alias("facing_width_avg_cm"),
        (k * 3).alias("products_per_category"),
        F.create_map(F.concat(F.lit("NATION_"), ((k + 1) % 25).cast("string")), r / 32)
        .alias("adjacency_bonus")).alias("c"))
    rows.agg(F.to_json(F.collect_list("c")).alias("value")).write.text(path)
    seed = readers.read_categories(spark, path)
    return seed.select("id", "name", "base_demand_mean_per_day", "seasonality_amp",
                       "products_per_category", F.explode("adjacency_bonus")
                       .alias("neighbour", "bonus"))


def _season(spark, d):
    """Units sold per day of year with the season wave."""
    sold = T.table(spark, d, "lineitem").groupBy(F.dayofyear("l_shipdate").alias("day_of_year")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
    return sold.join(readers.calendar(spark, 366), "day_of_year", "left")


def _required(spark, d):
    return readers.require_columns(T.planogram(spark, d), KB.KB_REQUIRED).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("n"))


def _catalog_csv(spark, d):
    """The catalogue written as CSV, read back, with parsed prices."""
    path = shared_dir(spark)
    catalog = T.catalog(spark, d).select(
        F.col("category").alias("Category"), "name",
        F.col("product_id").cast("string").alias("subtitle"), "price",
        F.lit(None).cast("string").alias("discount_price"))
    catalog.write.option("header", True).csv(path)
    rows = jobs.enrich.with_prices(readers.read_catalog(spark, path))
    return rows.select(F.col("subtitle").cast("bigint").alias("product_id"),
                       F.col("Category").alias("category"), "price_numeric",
                       "discount_price_numeric")


def _predict(spark, d):
    """Profit of the base month's racks as it was, and what the optimised layout must keep:
    shelves that are too full after the repair have got no product."""
    base = written(KB.latest_month(T.planogram(spark, d)))
    result = jobs.predict_month(base, 1)
    keys = ["month_key", "rack_id", "product_id"]
    moved = base.select(*keys, F.col("shelf_level").alias("_from")).join(result.layout, keys).filter(
        F.col("_from") != F.col("shelf_level"))
    spoiled = moved.join(result.violations.select("month_key", "rack_id", "shelf_level"),
                         ["month_key", "rack_id", "shelf_level"], "left_semi").select(
        "month_key", "rack_id").distinct().withColumn("_bad", F.lit(True))
    return result.racks.join(spoiled, ["month_key", "rack_id"], "left").select(
        "month_key", "rack_id", half_up("orig_profit", 2).alias("orig_profit"),
        (F.col("opt_profit") > 0).alias("has_profit"),
        (F.abs(F.col("opt_profit") - F.col("orig_profit") - F.col("lift")) < 1e-6).alias("adds_up"),
        F.col("_bad").isNotNull().alias("spoiled"))


QUERIES = {
    "m3_f5_fit_lift_linear": _linear_fit,
    "m3_fit_lift_gbt": _tree_fit,
    "m4_planogram_lift_model": _planogram_model,
    "m5_sequences": _chunks,
    "m7_layout_features": lambda s, d: ML.layout_features(T.planogram(s, d)),
    "m7_layout_score": _layout_score,
    "a4_model_layout": _model_layout,
    "r2_cosine_topk": _nearest,
    "r2_all_vectors": _all_nearest,
    "r2_stored_cells": _nearest_in_cells,
    "r2_vector_problems": _vector_problems,
    "r3_batch_prompts": lambda s, d: RE.batch_prompts(
        batch_rows(_with_text(s, d), 30), task="-"),
    "r3_forecast_prompt": _forecast_prompt,
    "t4_prompt_sample": _prompt_lines,
    "r5_parse_estimates": _estimates,
    "r6_parse_multipliers": lambda s, d: RE.parse_multipliers(_multiplier_replies(s, d)),
    "st1_stream_ingest": _streamed,
    "k3_two_files_of_a_month": lambda s, d: _two_files(s, d).select(
        "month_key", "category", "n_products", half_up("total_sales", 2).alias("total_sales")),
    "k3_source_file": lambda s, d: _two_files(s, d).select(
        "id", "year", "month", "month_name", "source_file"),
    "k6_s8_layout_files": _layout_files,
    "k5_prediction_files": _prediction_files,
    "s7_read_results": _results_json,
    "s9_category_seed": _category_seed,
    "p25_s9_season_calendar": _season,
    "s5_require_columns": _required,
    "s1_read_catalog": _catalog_csv,
    "job_predict_month": _predict,
}

_ALL_NEAREST = f"""SELECT query_id, vec_id, CAST(rk AS INTEGER) AS rank,
  {S.half_up('sim', 6)} AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rk
      FROM (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(
              CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS sim
            FROM embeddings a CROSS JOIN embeddings b) c) t WHERE rk <= 3"""

_BATCHED = """batched AS (
  SELECT *, (rn - 1) // 30 AS batch_id, CAST((rn - 1) % 30 + 1 AS INTEGER) AS item_no
  FROM (SELECT *, row_number() OVER (PARTITION BY month_key ORDER BY product_id) AS rn FROM retail) t)"""
_LINE = f"""'  ' || category || ' | ' || name || ' | €' || printf('%.2f', {S.half_up('price_numeric', 2)})
  || ' | Sales: ' || estimated_monthly_sales || ' | Margin: '
  || printf('%.1f', {S.half_up('profit_margin_percentage', 1)}) || '%'"""
_LATEST = """latest AS (SELECT * FROM retail WHERE month_key = (SELECT max(month_key) FROM retail))"""
_LINES = f"""lines AS (
  SELECT row_number() OVER (ORDER BY category, rk) AS line_no, product_id, line
  FROM (SELECT product_id, category, {_LINE} AS line, row_number() OVER (
          PARTITION BY category ORDER BY estimated_monthly_sales DESC, product_id) AS rk FROM latest) a
  WHERE rk <= 5)"""
_CENTROIDS = """means AS (
  SELECT label, i, avg(CAST(x AS DOUBLE)) AS x
  FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) e
  GROUP BY 1, 2),
centre AS (SELECT label, list(x ORDER BY i) AS c FROM means GROUP BY 1)"""
_HAS = "batch_id % 5 <> 4"
_FEATURES = """SELECT month_key, rack_id, product_id, price_numeric,
  profit_margin_percentage, estimated_monthly_sales, product_width_cm,
  shelf_level AS original_shelf, shelf_level AS new_shelf,
  count(*) OVER s AS n_products_on_original_shelf, count(*) OVER s AS n_products_on_new_shelf,
  used AS n_shelves_used, count(*) OVER r AS rack_product_count
FROM retail JOIN (SELECT month_key, rack_id, count(DISTINCT shelf_level) AS used FROM retail GROUP BY 1, 2) u
USING (month_key, rack_id)
WINDOW s AS (PARTITION BY month_key, rack_id, shelf_level), r AS (PARTITION BY month_key, rack_id)"""
_TEN = " || '|' || ".join(
    f"printf('%.2f', {S.half_up(f'CAST({c} AS DOUBLE)', 2)})" for c in MOVE_FEATURES)

def _fact_rows(*names: str) -> str:
    return "SELECT fact, true AS holds FROM (VALUES " + ", ".join(f"('{n}')" for n in names) + ") t(fact)"


ORACLES = {
    "m3_f5_fit_lift_linear": _fact_rows(*MOVE_FEATURES, "mean", "beats the mean", "refuses few rows"),
    "m3_fit_lift_gbt": _fact_rows("beats the mean", "importances add up"),
    "m4_planogram_lift_model": _fact_rows("beats the mean", "importances add up", "within the bounds",
                                          "the same after loading"),
    "m7_layout_score": S.query("""SELECT month_key, rack_id, count(*) AS n_products, true AS as_formula
FROM retail GROUP BY 1, 2""", S.PLANOGRAM),
    "a4_model_layout": S.query("""SELECT month_key, rack_id, count(*) AS n_products, false AS overfilled
FROM retail GROUP BY 1, 2""", S.PLANOGRAM),
    "job_predict_month": S.query(f"""SELECT month_key, rack_id, {S.half_up('profit', 2)} AS orig_profit,
  true AS has_profit, true AS adds_up, false AS spoiled FROM profits""", S.PLANOGRAM, _LATEST,
                                 S.rack_profit_cte("latest", "month_key, rack_id")),
    "m5_sequences": S.query(f"""SELECT month_key, rack_id, (rn - 1) // 10 AS chunk_id,
  string_agg({_TEN}, ',' ORDER BY product_id) AS rows
FROM (SELECT *, row_number() OVER (PARTITION BY month_key, rack_id ORDER BY product_id) AS rn FROM features) t
GROUP BY 1, 2, 3 HAVING count(*) = 10""", S.PLANOGRAM, f"features AS ({_FEATURES})"),
    "m7_layout_features": S.query(_FEATURES, S.PLANOGRAM),
    "r2_cosine_topk": S.query(f"""SELECT CAST(label AS BIGINT) AS query_id, vec_id,
  CAST(rk AS INTEGER) AS rank, {S.half_up('sim', 6)} AS similarity
FROM (SELECT c.label, vec_id, sim, row_number() OVER (PARTITION BY c.label ORDER BY sim DESC, vec_id) AS rk
      FROM (SELECT c.label, e.vec_id,
                   list_cosine_similarity(c.c, CAST(e.embedding AS DOUBLE[])) AS sim
            FROM centre c CROSS JOIN embeddings e) c) t WHERE rk <= 5""", _CENTROIDS),
    "r2_all_vectors": _ALL_NEAREST,
    "r2_stored_cells": _ALL_NEAREST,
    "r2_vector_problems": """SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN 'length ' || (len(embedding) - 1)
  ELSE 'all zero' END AS problem FROM embeddings WHERE vec_id % 10 = 0 OR vec_id % 7 = 0""",
    "r3_batch_prompts": S.query("""SELECT month_key, batch_id, count(*) AS n_items,
  string_agg(item_no || '. Category: ' || category || ' | Name: ' || name || ' | Subtitle: - | Price: 1,00 €',
             chr(10) ORDER BY item_no) || chr(10) || chr(10) || '-' AS prompt
FROM batched GROUP BY 1, 2""", S.PLANOGRAM, _BATCHED),
    "r3_forecast_prompt": S.query("""SELECT (line_no - 1) // 20 + 1 AS part_no,
  'Target month: March 2000, part ' || ((line_no - 1) // 20 + 1) || chr(10) || chr(10)
  || (SELECT string_agg('### Data from ' || month_key || chr(10) || l, chr(10) ORDER BY month_key)
      FROM (SELECT month_key, string_agg('- ' || document, chr(10) ORDER BY category) AS l FROM docs
            WHERE month_key IN ('1999_03', '2000_01', '2000_02') GROUP BY 1) x)
  || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY line_no)
  || chr(10) || chr(10) || '""" + RE.FORECAST_TASK + "' AS prompt FROM lines GROUP BY 1, (line_no - 1) // 20",
        S.PLANOGRAM, "source AS (SELECT * FROM retail)", _DOC, _LATEST, _LINES),
    "t4_prompt_sample": S.query("SELECT * FROM lines", S.PLANOGRAM, _LATEST, _LINES),
    "r5_parse_estimates": S.query(f"""SELECT month_key, batch_id, item_no, product_id,
  CASE WHEN {_HAS} AND batch_id % 5 <> 2 THEN greatest(1, product_id % 40) ELSE 50 END AS estimated_monthly_sales,
  CASE WHEN {_HAS} THEN least(greatest(product_id % 80 + 0.5e0, 1e0), 70e0) ELSE 30e0 END AS profit_margin_percentage,
  CASE WHEN {_HAS} THEN least(greatest(product_id % 70 + 0.25e0, 2e0), 60e0) ELSE 12e0 END AS product_width_cm
FROM batched""", S.PLANOGRAM, _BATCHED),
    "r6_parse_multipliers": S.query("""SELECT month_key, category,
  least(greatest(sum(estimated_monthly_sales) % 400 / 100e0, 0.3e0), 2.5e0) AS multiplier
FROM retail WHERE CAST(substr(month_key, 6, 2) AS INTEGER) % 4 <> 3 GROUP BY 1, 2""", S.PLANOGRAM),
    "st1_stream_ingest": S.query("""SELECT month_key, category, count(*) AS n_products,
  CAST(sum(estimated_monthly_sales) AS DOUBLE) AS total_sales FROM retail
WHERE substr(month_key, 1, 4) <> '1998' OR shelf_level > 2 GROUP BY 1, 2""", S.PLANOGRAM),
    "k3_two_files_of_a_month": S.query("""SELECT month_key, category, count(*) AS n_products,
  CAST(sum(estimated_monthly_sales) AS DOUBLE) AS total_sales FROM retail
WHERE shelf_level = 3 GROUP BY 1, 2""", S.PLANOGRAM),
    "k3_source_file": S.query(f"""SELECT month_key || '_' || category AS id,
  CAST(substr(month_key, 1, 4) AS INTEGER) AS year, CAST(substr(month_key, 6, 2) AS INTEGER) AS month,
  {_NAME} || '_b' AS month_name, 'sales_' || month_key || '_' || {_NAME} || '_b.csv' AS source_file
FROM (SELECT DISTINCT month_key, category FROM retail
      WHERE shelf_level = 3) t""", S.PLANOGRAM),
    "k6_s8_layout_files": S.query("""SELECT 'Original' AS model, shelf_level, count(*) AS n,
  CAST(sum(estimated_monthly_sales) AS BIGINT) AS sales FROM retail GROUP BY 2
UNION ALL SELECT 'GREEDY', 4, count(*), CAST(sum(estimated_monthly_sales) AS BIGINT) FROM retail""",
                                  S.PLANOGRAM),
    "k5_prediction_files": S.query("""SELECT category, count(*) AS n, length(category) / 5e0 AS multiplier
FROM latest GROUP BY 1""", S.PLANOGRAM, _LATEST),
    "s7_read_results": """SELECT p_brand AS model, CAST(NULL AS DOUBLE) AS mse,
  CAST(sum(p_size) AS DOUBLE) AS original_profit, max(p_retailprice) AS optimized_profit
FROM part GROUP BY 1""",
    "s9_category_seed": """SELECT n_nationkey AS id, n_name AS name, n_nationkey / 8e0 AS base_demand_mean_per_day,
  n_regionkey / 16e0 AS seasonality_amp, n_nationkey * 3 AS products_per_category,
  'NATION_' || ((n_nationkey + 1) % 25) AS neighbour, n_regionkey / 32e0 AS bonus FROM nation""",
    "p25_s9_season_calendar": """SELECT day_of_year, units, round(sin(2e0 * pi() * day_of_year / 365e0), 6) AS season_sin,
  round(cos(2e0 * pi() * day_of_year / 365e0), 6) AS season_cos
FROM (SELECT CAST(dayofyear(l_shipdate) AS INTEGER) AS day_of_year,
             CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units FROM lineitem GROUP BY 1) t""",
    "s5_require_columns": S.query("SELECT month_key, count(*) AS n FROM retail GROUP BY 1", S.PLANOGRAM),
    "s1_read_catalog": """SELECT p_partkey AS product_id, category,
  CASE WHEN p_size % 5 IN (0, 2) THEN cents / 100e0 WHEN p_size % 5 = 1 THEN (100000 + cents) / 100e0
       ELSE 0e0 END AS price_numeric, 0e0 AS discount_price_numeric
FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
             [""" + ", ".join(f"'{w}'" for w in T.CATEGORY_WORDS) + """][CAST(p_partkey % 12 AS INTEGER) + 1] AS category
      FROM part) t""",
}
