"""Files, enrichment, knowledge base, replies, vectors, streams and jobs."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from gondola import constants as K
from gondola.operators import (enrich as E, forecast as FC, inventory as I, knowledge as KB,
                               learning as ML, quality as Q, replies as RE, report as RP,
                               sales as SA, store as ST, vectors as V, whatif as W)
from gondola.plans import jobs
from gondola.plans.queries.models import _in_parts, _two_files
from gondola.plans.tables import planogram
from gondola.sources import readers as RD, sinks as SK
from gondola.streaming.ingest import stream_ingest
from tests import racks as X

HEAD = ",".join(K.PLANOGRAM_COLUMNS)


def planogram_csv(folder, name, rows):
    """rows: (category, name, sales, shelf)."""
    lines = [HEAD] + [f'{c},{n},-,"1,00 €",,1.0,0.0,{s},30.0,10.0,0,{shelf}'
                      for c, n, s, shelf in rows]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def monthly(tmp_path):
    folder = tmp_path / "monthly"
    folder.mkdir()
    planogram_csv(folder, "sales_2025_07_july.csv", [("Fruta", "pera", 10, 1),
                                                     ("Fruta", "kiwi", 20, 2), ("Pan", "pan", 5, 3)])
    planogram_csv(folder, "sales_2025_08_august.csv", [("Fruta", "pera", 12, 1)])
    return folder


def test_month_of_file_names(spark):
    rows = spark.createDataFrame([("sales_2025_07_july.csv",), ("sales_2025_7_july.csv",),
                                  ("xsales_2025_07_july.csv",), ("sales_2025_07_july.csv.bak",)],
                                 "f string")
    got = {r["f"]: r["m"] for r in rows.select("f", RD.file_month("f").alias("m")).collect()}
    assert tuple(got["sales_2025_07_july.csv"]) == (2025, 7, "july", "2025_07")
    assert got["sales_2025_7_july.csv"] is None and got["xsales_2025_07_july.csv"] is None
    assert got["sales_2025_07_july.csv.bak"]["month"] == 7
    with pytest.raises(Exception, match="cannot read a month"):
        rows.select(RD.file_month("f", strict=True).alias("m")).collect()


def test_read_monthly_files(spark, monthly):
    (monthly / "other.csv").write_text("a\n1\n")
    df = RD.read_monthly(spark, str(monthly))
    assert df.count() == 4
    assert {r["month_key"] for r in df.collect()} == {"2025_07", "2025_08"}
    latest = RD.read_latest(spark, str(monthly), "Fruta").collect()
    assert [(r["name"], r["estimated_monthly_sales"]) for r in latest] == [("pera", 12.0)]
    summary = RD.load_summary(df).first()
    assert tuple(summary) == (4, 2, 2, 2)


def test_missing_columns_are_named(spark):
    df = spark.range(1).withColumn("Category", F.lit("x"))
    assert RD.require_columns(df, ["category", "id"]) is df
    with pytest.raises(RD.MissingColumns, match="price"):
        RD.require_columns(df, ["category", "price"])


def test_product_ids_are_stable_and_unique(spark, monthly):
    planogram_csv(monthly, "sales_2025_09_september.csv", [("Pan", "pan", 5, 3), ("Pan", "pan", 5, 3)])
    rows = RD.with_product_id(RD.read_monthly(spark, str(monthly)))
    ids = [(r["month_key"], r["product_id"]) for r in rows.collect()]
    assert len(set(ids)) == len(ids) == 6
    again = RD.with_product_id(RD.read_monthly(spark, str(monthly)).repartition(5))
    assert sorted(ids) == sorted((r["month_key"], r["product_id"]) for r in again.collect())


def test_results_and_layout_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({
        "MLP": {"mse": 2.0, "original_profit": 10.0, "optimized_profit": 14.0},
        "PPO": {"original_profit": 10.0, "optimized_profit": 15.0}}))
    results = RD.read_results(spark, str(tmp_path / "r.json"))
    got = {r["model"]: r for r in RP.compare_models(results).collect()}
    assert got["MLP"]["lift"] == 4.0 and got["MLP"]["lowest_mse"]
    assert got["PPO"]["mse"] is None and got["PPO"]["highest_profit"]
    assert not got["PPO"]["lowest_mse"]
    for name in ("original", "greedy"):
        planogram_csv(tmp_path, f"rack_layout_{name}.csv", [("Fruta", "pera", 1, 1)])
    models = {r["model"] for r in RD.read_layouts(spark, str(tmp_path)).collect()}
    assert models == {"Original", "GREEDY"}


def test_seed_files(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([
        {"id": 1, "name": "A", "base_demand_mean_per_day": 2.5, "seasonality_amp": 0.1,
         "margin_avg": 0.2, "facing_width_avg_cm": 10.0, "products_per_category": 3,
         "adjacency_bonus": {"B": 0.15}},
        {"id": 2, "name": "B", "base_demand_mean_per_day": 1.0, "seasonality_amp": 0.1,
         "margin_avg": 0.2, "facing_width_avg_cm": 10.0, "products_per_category": 3,
         "adjacency_bonus": {}}]))
    categories = RD.read_categories(spark, str(tmp_path / "c.json"))
    pairs = spark.createDataFrame([("A", "B"), ("B", "A")], "name string, neighbour string")
    got = {r["name"]: r["factor"] for r in ST.adjacency_bonus(categories, pairs).collect()}
    assert got == {"A": 1.15, "B": 1.0}
    calendar = RD.calendar(spark).orderBy("day_of_year").collect()
    assert len(calendar) == 365
    assert (calendar[0]["season_sin"], calendar[0]["season_cos"]) == (0.017213, 0.999852)
    assert (calendar[1]["season_sin"], calendar[1]["season_cos"]) == (0.034422, 0.999407)


def test_other_files(spark, tmp_path):
    (tmp_path / "cal.json").write_text(json.dumps(
        [{"day_of_year": 1, "season_sin": 0.017213, "season_cos": 0.999852}]))
    assert RD.read_calendar(spark, str(tmp_path / "cal.json")).first()["day_of_year"] == 1
    (tmp_path / "grid.json").write_text(json.dumps({
        "height": 10, "width": 12, "door": [0, 0],
        "shelves": [{"id": 1, "grid_pos": [1, 0], "balda_capacity": [8, 10],
                     "facing_width_total": 120}],
        "adjacencies": [{"shelf_id": 1, "neighbors": [2, 6]}]}))
    grid = RD.read_grid(spark, str(tmp_path / "grid.json")).first()
    assert grid["shelves"][0]["grid_pos"] == [1, 0] and grid["adjacencies"][0]["neighbors"] == [2, 6]
    (tmp_path / "top.csv").write_text(
        "product_id,name,category,price,margin,popularity,shelf_id,rack_level,total_units,"
        "total_revenue,total_profit,sim_id,seed\n"
        + "".join(f"{p},{n},c,2.0,0.2,0.5,S1,3,10,20.0,4.0,{r},{99 + r}\n"
                  for r in (1, 2) for p, n in ((1, "a"), (r + 1, "bc"[r - 1]))))
    top = RD.read_top_products(spark, str(tmp_path / "top.csv"))
    assert [r["name"] for r in SA.in_all_runs(top, 2).collect()] == ["a"]


@pytest.mark.parametrize("year, month, n, keys", [
    (2026, 1, 2, ["2025_01", "2025_11", "2025_12"]),
    (2026, 3, 2, ["2025_03", "2026_01", "2026_02"]),
    (2026, 2, 0, ["2025_02"])])
def test_wanted_months(year, month, n, keys):
    assert KB.wanted_months(year, month, n) == keys


def test_wanted_months_without_repeats():
    assert len(KB.wanted_months(2026, 3, 12)) == 12


def test_documents(spark, monthly):
    df = RD.read_monthly(spark, str(monthly))
    docs = {(r["month_key"], r["category"]): r["document"]
            for r in KB.category_documents(df, "name").collect()}
    assert docs["2025_07", "Fruta"] == (
        "Category: Fruta | Month: 07/2025 | Products: 2 | Total sales: 30 units | "
        "Avg sales/product: 15 | Avg price: €1.00 | Avg margin: 30.0% | Avg width: 10.0cm | "
        "Shelf distribution: [S1: 1, S2: 1] | Top sellers: kiwi (20 units), pera (10 units)")


def test_upsert_replaces_a_month_and_is_idempotent(spark, monthly, tmp_path):
    kb = str(tmp_path / "kb")
    stats = jobs.build_knowledge_base(spark, str(monthly), kb).first()
    assert tuple(stats) == (3, ["2025_07", "2025_08"], 2, 2)
    before = {r["id"]: r["document"] for r in spark.read.parquet(kb).collect()}
    jobs.build_knowledge_base(spark, str(monthly), kb)
    assert before == {r["id"]: r["document"] for r in spark.read.parquet(kb).collect()}
    planogram_csv(monthly, "sales_2025_07_july.csv", [("Leche", "leche", 3, 4)])
    jobs.build_knowledge_base(spark, str(monthly), kb)
    ids = {r["id"] for r in spark.read.parquet(kb).collect()}
    assert ids == {"2025_07_Leche", "2025_08_Fruta"}


def test_stream_takes_new_files_once_and_the_last_of_a_month(spark, monthly, tmp_path):
    kb, done = str(tmp_path / "kb"), str(tmp_path / "done")

    def run():
        stream_ingest(spark, str(monthly), kb, done).awaitTermination()
        return {r["id"]: r["n_products"] for r in spark.read.parquet(kb).collect()}

    assert run() == {"2025_07_Fruta": 2, "2025_07_Pan": 1, "2025_08_Fruta": 1}
    planogram_csv(monthly, "sales_2025_07_july_b.csv", [("Pan", "pan", 1, 1)] * 3)
    planogram_csv(monthly, "sales_2025_07_july_a.csv", [("Fruta", "pera", 1, 1)])
    assert run() == {"2025_07_Pan": 3, "2025_08_Fruta": 1}
    assert run() == {"2025_07_Pan": 3, "2025_08_Fruta": 1}


def test_stream_takes_all_parts_of_a_month(spark, tmp_path):
    """Parts that fall into different micro-batches."""
    folder = tmp_path / "m" / "source_file=sales_2025_07_july.csv"
    folder.mkdir(parents=True)
    for k in range(3):
        planogram_csv(folder, f"part-{k}.csv", [("Pan", f"p{k}{i}", 1, 1) for i in range(4)])
    kb, done = str(tmp_path / "kb"), str(tmp_path / "done")
    stream_ingest(spark, str(tmp_path / "m"), kb, done, by_folder=True, max_files=1).awaitTermination()
    assert [r["n_products"] for r in spark.read.parquet(kb).collect()] == [12]


def test_parts_of_months_are_written_by_several_tasks(spark, tmp_path):
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(merged)
    rows = [(f"2025_{m:02d}", i, "Pan", f"p{i}", float(i), 1 + i % 7) for m in range(1, 13) for i in range(60)]
    df = spark.createDataFrame(rows, "month_key string, product_id bigint, category string, "
                                     "name string, estimated_monthly_sales double, shelf_level int")
    spark.conf.set(merged, "100")
    try:
        _in_parts(df, str(tmp_path / "m"))
    finally:
        spark.conf.set(merged, before)
    files = list((tmp_path / "m").glob("source_file=*/part-*.csv"))
    assert len({f.name.split("-")[1] for f in files}) > 1
    per_month = [len(list(f.glob("part-*.csv"))) for f in (tmp_path / "m").glob("source_file=*")]
    assert len(per_month) == 12 and min(per_month) >= 3
    assert RD.read_monthly(spark, str(tmp_path / "m")).count() == len(rows)


def test_stream_opens_new_parts_only(spark, tmp_path):
    """Parts that were taken in are listed, not read again: what they hold by now has no effect."""
    folder = tmp_path / "m" / "source_file=sales_2025_07_july.csv"
    folder.mkdir(parents=True)
    kb, done = str(tmp_path / "kb"), str(tmp_path / "done")
    run = lambda: stream_ingest(spark, str(tmp_path / "m"), kb, done, by_folder=True).awaitTermination()
    planogram_csv(folder, "part-0.csv", [("Pan", f"p{i}", 10 + i, 1 + i % 3) for i in range(6)])
    run()
    planogram_csv(folder, "part-0.csv", [("Pan", "other", 900, 1)] * 50)
    planogram_csv(folder, "part-1.csv", [("Pan", f"q{i}", 13 + i, 2) for i in range(4)]
                  + [("Vino", "v", 1, 1)])
    run()
    got = {r["id"]: r for r in spark.read.parquet(kb).collect()}
    assert {i: r["n_products"] for i, r in got.items()} == {"2025_07_Pan": 10, "2025_07_Vino": 1}
    assert "other" not in got["2025_07_Pan"]["document"]
    # A part that is gone no longer counts, as soon as its month has news.
    (folder / "part-0.csv").unlink()
    planogram_csv(folder, "part-2.csv", [("Vino", "w", 1, 1)])
    run()
    got = {r["id"]: r["n_products"] for r in spark.read.parquet(kb).collect()}
    assert got == {"2025_07_Pan": 4, "2025_07_Vino": 2}


def test_merged_parts_give_the_chunks_of_all_rows(spark, tmp_path):
    for k in range(4):
        planogram_csv(tmp_path, f"sales_2025_07_july{k}.csv", [
            (c, f"{c}{k}{i}", (7 * i + k) % 23, 1 + i % 7) for c in ("Pan", "Vino") for i in range(9)])
    rows = RD.read_monthly(spark, str(tmp_path)).withColumn("part", F.col("source_file")).withColumns(
        {"source_file": F.lit("sales_2025_07_july.csv"), "month_name": F.lit("july")})
    whole = KB.kb_chunks(rows, "name").drop("avg_price", "avg_margin", "avg_sales").collect()
    parts = KB.chunks_of_parts(KB.month_parts(rows, "name"))
    assert sorted(map(str, whole)) == sorted(map(str, parts.drop(
        "avg_price", "avg_margin", "avg_sales").collect()))


def test_an_earlier_name_that_arrives_later_changes_nothing(spark, monthly, tmp_path):
    kb, done = str(tmp_path / "kb"), str(tmp_path / "done")
    planogram_csv(monthly, "sales_2025_07_july_b.csv", [("Pan", f"p{i}", 1, 1) for i in range(6)])
    stream_ingest(spark, str(monthly), kb, done).awaitTermination()
    planogram_csv(monthly, "sales_2025_07_july_a.csv", [("Pan", f"q{i}", 1, 1) for i in range(4)])
    stream_ingest(spark, str(monthly), kb, done).awaitTermination()
    got = {r["id"]: (r["n_products"], r["source_file"], r["month_name"])
           for r in spark.read.parquet(kb).collect()}
    assert got["2025_07_Pan"] == (6, "sales_2025_07_july_b.csv", "july_b")
    jobs.build_knowledge_base(spark, str(monthly), kb)  # the same rule in one go
    assert got == {r["id"]: (r["n_products"], r["source_file"], r["month_name"])
                   for r in spark.read.parquet(kb).collect()}


def test_a_file_without_a_month_is_an_error(spark, monthly, tmp_path):
    planogram_csv(monthly, "sales_summer.csv", [("Pan", "pan", 1, 1)])
    with pytest.raises(Exception, match="cannot read a month"):
        jobs.build_knowledge_base(spark, str(monthly), str(tmp_path / "kb"))


def test_profit_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("B", 1.0, 1.0, 5.0), ("A", 1.0, 1.0, 5.0)],
                               "model string, mse double, original_profit double, optimized_profit double")
    got = {r["model"]: (r["lowest_mse"], r["highest_profit"]) for r in RP.compare_models(df).collect()}
    assert got == {"A": (True, True), "B": (False, False)}


# --- enrichment ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def catalog(spark):
    cats = F.array(*[F.lit(c) for c in ("Fruta", "Vino", "Hielo")])
    return spark.range(400).select(
        F.col("id").alias("product_id"), F.element_at(cats, (F.col("id") % 3 + 1).cast("int"))
        .alias("category"), F.concat(F.lit("p"), F.col("id")).alias("name"),
        (F.col("id") % 90 / 10 + 0.5).alias("price_numeric")).cache()


def test_generated_months(catalog):
    months = E.month_keys(2025, range(1, 4))
    df = E.generate_months(catalog, months).cache()
    rows = df.collect()
    per_month = {m: [r for r in rows if r["month_key"] == m] for m in months}
    for month, rs in per_month.items():
        assert 0.6 * 400 - 1 <= len(rs) <= 0.9 * 400
        first = {}
        for r in sorted(rs, key=lambda r: r["product_id"]):
            first.setdefault(r["category"], len(first))
        assert all(r["rack_id"] == first[r["category"]] for r in rs)
    assert all(r["estimated_monthly_sales"] >= 1 and 1 <= r["shelf_level"] <= 7 for r in rows)
    wine = [r for r in rows if r["category"] == "Vino"]
    assert all(6 <= r["product_width_cm"] <= 12 for r in wine)
    assert all(25 * .95 - .1 <= r["profit_margin_percentage"] <= 50 * 1.05 + .1 for r in wine)
    again = E.generate_months(catalog.repartition(7), months)
    assert df.exceptAll(again).count() == 0 and again.count() == len(rows)
    other = E.generate_months(catalog, months, seed=43)
    assert df.exceptAll(other).count() > 0


def test_small_catalogues_keep_ten(catalog):
    small = E.sample_months(catalog.filter("product_id < 12"), ["2025_01"])
    assert small.count() == 10


def test_forecast_keeps_categories_without_a_reply(spark, catalog):
    base = E.assign_rack(E.enrich_heuristic(catalog.withColumn("month_key", F.lit("2025_01"))))
    replies = spark.createDataFrame([("Fruta", 0.5), ("Nada", 2.0)],
                                    "category string, multiplier double")
    mult = FC.forecast(base, 7, replies)
    after = FC.apply_forecast(base, mult)
    both = base.alias("a").join(after.alias("b"), "product_id").select(
        "a.category", F.col("a.estimated_monthly_sales").alias("x"),
        F.col("b.estimated_monthly_sales").alias("y"))
    for r in both.collect():
        assert r["y"] == (max(1, r["x"] // 2) if r["category"] == "Fruta" else r["x"])
    assert {r["category"] for r in FC.top_adjustments(mult).collect()} == {"Fruta"}


def test_resume_skips_written_batches(catalog, tmp_path):
    path = str(tmp_path / "out")
    rows = E.batch_rows(catalog.withColumn("month_key", F.lit("2025_01")), 30)
    seen = []

    def enricher(df):
        seen.append(df.count())
        return E.enrich_heuristic(df)

    E.enrich_resumable(rows.filter("batch_id < 5"), path, enricher)
    out = E.enrich_resumable(rows, path, enricher)
    assert seen == [150, 250] and out.count() == 400
    assert rows.agg(F.max("item_no")).first()[0] == 30


def test_a_run_that_stops_between_slices_goes_on(spark, catalog, tmp_path):
    path = tmp_path / "out"
    rows = E.batch_rows(catalog.withColumn("month_key", F.lit("2025_01")), 30)
    calls = []

    def stops(df):
        calls.append(df.count())
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return E.enrich_heuristic(df)

    with pytest.raises(RuntimeError, match="stopped"):
        E.enrich_resumable(rows, str(path), stops, slices=4)
    # Rows that were written, but whose commit never came into the ledger.
    first = sorted(path.glob("commit=*"))[0]
    shutil.copytree(first, path / "commit=cunfinished")
    out = E.enrich_resumable(rows, str(path), stops, slices=4)
    assert out.count() == out.select("product_id").distinct().count() == 400
    assert calls[3:5] == [0, 0] and sum(calls[:2]) + sum(calls[3:]) == 400
    assert sorted(out.columns) == sorted(E.enrich_heuristic(rows).columns)
    # The ledger alone tells what is done: the output isn't opened for it.
    for part in path.glob("commit=*/*.parquet"):
        part.write_bytes(b"")
    assert spark.read.parquet(f"{path}-ledger").select("month_key", "batch_id").distinct().count() == 14


def test_written_months_are_skipped(spark, catalog, tmp_path):
    path = str(tmp_path / "m")
    df = E.generate_months(catalog, ["2025_01", "2025_02"]).withColumnRenamed(
        "category", "Category")
    SK.write_monthly(df.filter("month_key = '2025_01'"), path)
    SK.write_monthly(df.withColumn("shelf_level", F.lit(1)), path, skip_existing=True)
    back = RD.read_monthly(spark, path)
    assert back.filter("month_key = '2025_02' and shelf_level <> 1").count() == 0
    assert back.filter("month_key = '2025_01' and shelf_level <> 1").count() > 0
    assert [c for c in back.columns[:12]] == list(K.PLANOGRAM_COLUMNS)


def test_catalogue_to_prediction(spark, tmp_path):
    lines = ["Category,name,subtitle,price,discount_price"] + [
        f'{("Fruta", "Vino", "Hielo")[i % 3]},p{i},s,"{i % 9},{i % 90 + 10} €",' for i in range(60)]
    source = tmp_path / "products.csv"
    source.write_text("\n".join(lines), encoding="utf-8")
    out = str(tmp_path / "monthly")
    jobs.generate_monthly(spark, str(source), out, E.month_keys(2025, (11, 12)))
    planogram = jobs.monthly_planogram(spark, out)
    assert {r["month_key"] for r in planogram.collect()} == {"2025_11", "2025_12"}
    base = KB.latest_month(planogram)
    result = jobs.predict_month(base, 1)
    totals = result.totals.first()
    assert totals["lift"] == pytest.approx(totals["opt_profit"] - totals["orig_profit"])
    assert result.layout.count() == base.count()
    model, metrics = jobs.train_lift_model(planogram, "linear")
    assert metrics.first()["mse"] > 0
    guided = jobs.predict_month(base, 1, model=model)
    assert guided.layout.count() == base.count()


def test_known_months_are_skipped_before_any_work(spark, tmp_path):
    source, out = tmp_path / "products.csv", str(tmp_path / "monthly")
    source.write_text("Category,name,subtitle,price,discount_price\n" + "\n".join(
        f'{("Pan", "Fruta", "Vino")[i % 3]},p{i},s,"1,{i % 90 + 10} €",' for i in range(40)), encoding="utf-8")
    jobs.generate_monthly(spark, str(source), out, ["2025_01"], skip_existing=True)
    jobs.generate_monthly(spark, str(tmp_path / "gone.csv"), out, ["2025_01"], skip_existing=True)
    jobs.generate_monthly(spark, str(source), out, ["2025_01", "2025_02"], skip_existing=True)
    rows = RD.read_monthly(spark, out)
    assert {r["month_key"] for r in rows.collect()} == {"2025_01", "2025_02"}
    first = {r["Category"]: r["rack_id"] for r in rows.filter("month_key = '2025_01'").collect()}
    seen = sorted((int(r["name"][1:]), r["Category"]) for r in rows.filter("month_key = '2025_01'").collect())
    order = list(dict.fromkeys(c for _, c in seen))
    assert first == {c: i for i, c in enumerate(order)}


# --- replies and vectors -----------------------------------------------------------------

def estimates(spark, text, n=3):
    replies = spark.createDataFrame([("m", 0, text)], "month_key string, batch_id long, reply_text string")
    batch = spark.createDataFrame([("m", 0, i + 1) for i in range(n)],
                                  "month_key string, batch_id long, item_no int")
    return [(r[0], r[1], r[2]) for r in RE.parse_estimates(replies, batch).orderBy("item_no").select(
        "estimated_monthly_sales", "profit_margin_percentage", "product_width_cm").collect()]


DEFAULT = (50, 30.0, 12.0)
ITEM = ('{"estimated_monthly_sales": 12.7, "profit_margin_percentage": 90, '
        '"product_width_cm": 0.5}')


@pytest.mark.parametrize("text, rows", [
    (f"[{ITEM}, {ITEM}, {ITEM}]", [(12, 70.0, 2.0)] * 3),
    (f"```json\n[{ITEM}]\n```", [(12, 70.0, 2.0), DEFAULT, DEFAULT]),
    (f"[{ITEM}, {ITEM}, {ITEM}, {ITEM}, 5]", [(12, 70.0, 2.0)] * 3),
    (f"[{ITEM}, 5]", [DEFAULT] * 3), (f"[{ITEM}, null]", [DEFAULT] * 3),
    ('[{"estimated_monthly_sales": -4}]', [(1, 30.0, 12.0), DEFAULT, DEFAULT]),
    (f'[{ITEM}, {{"product_width_cm": "wide"}}]', [DEFAULT] * 3),
    (f'[{ITEM}, {{"product_width_cm": null}}]', [DEFAULT] * 3),
    (f"[{ITEM}, {{", [DEFAULT] * 3), ("no", [DEFAULT] * 3), (None, [DEFAULT] * 3)])
def test_estimate_replies(spark, text, rows):
    assert estimates(spark, text) == rows


def test_batches_without_a_reply_get_defaults(spark):
    replies = spark.createDataFrame([], "month_key string, batch_id long, reply_text string")
    batch = spark.createDataFrame([("m", 0, 1)], "month_key string, batch_id long, item_no int")
    assert RE.parse_estimates(replies, batch).first()["estimated_monthly_sales"] == 50


@pytest.mark.parametrize("text, want", [
    ('{"A": -1, "B": 9, "C": 1.2}', {"A": 0.3, "B": 2.5, "C": 1.2}),
    ('so: ```{"A": 1}``` ok', {"A": 1.0}), ('{"A": 1, "B": "x"}', {}), ("nothing", {}),
    ('{"A": 1', {}), (None, {})])
def test_multiplier_replies(spark, text, want):
    df = spark.createDataFrame([("m", text)], "month_key string, reply_text string")
    assert {r["category"]: r["multiplier"] for r in RE.parse_multipliers(df).collect()} == want


def test_prompts_have_every_category(spark):
    """The same rule for any number of products and categories; long prompts in parts."""
    rows = [(*r[:4], f"C{r[2] % 70:02d}", *r[5:]) for r in X.random_rows(1, (400,))]
    df = spark.createDataFrame(rows, X.SCHEMA)
    sample = RE.prompt_sample(df, per_category=3).orderBy("line_no").collect()
    assert [r["line_no"] for r in sample] == list(range(1, 211))
    assert [r["category"] for r in sample] == [f"C{i // 3:02d}" for i in range(210)]
    few = spark.createDataFrame(X.random_rows(1, (40,)), X.SCHEMA)
    assert RE.prompt_sample(few).count() == 5
    context = spark.createDataFrame([("2025_01", "C", "d")], "month_key string, category string, document string")
    parts = RE.forecast_prompt(context, df, 2025, 2, lines=100).orderBy("part_no").collect()
    assert [p["part_no"] for p in parts] == [1, 2, 3, 4]
    assert all("### Data from 2025_01" in p["prompt"] and RE.FORECAST_TASK in p["prompt"] for p in parts)


def test_heat_of_two_stores(spark):
    cells = spark.createDataFrame([(s, i, i, 0) for s in (1, 2, 3) for i in range(3)],
                                  "store_id int, cell_id int, x int, y int")
    centres = spark.createDataFrame(
        [(1, 0.0, 0.0, 1.0, 1.0)] + [(2, 2.0, 0.0, 1.0, 0.5)] * 1200,
        "store_id int, x double, y double, sigma double, weight double")
    heat = {(r["store_id"], r["cell_id"]): r["heat"] for r in ST.traffic_heatmap(cells, centres).collect()}
    assert heat[1, 0] == heat[2, 2] == 1.0 and heat[3, 0] is None
    assert heat[1, 1] == pytest.approx(heat[2, 1]) == pytest.approx(0.60653066)


def test_cosine_topk_in_blocks(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    vectors += [(300 + i, vectors[i][1]) for i in range(5)] + [(999, [0.0] * 8)]
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(6)
    q = v.filter("vec_id < 40").withColumnRenamed("vec_id", "query_id")
    got = {(r["query_id"], r["rank"]): r["vec_id"]
           for r in V.cosine_topk(q, v, 4, query_block=16, vector_block=50).collect()}
    m = np.array([x for i, x in vectors if i != 999])
    ids = np.array([i for i, _ in vectors if i != 999])
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    for i in range(40):
        sims = np.round(unit @ unit[i], 12)
        want = ids[np.lexsort((ids, -sims))][:4]
        assert [got[i, r] for r in range(1, 5)] == list(want)


def test_cosine_topk_of_nothing_and_of_odd_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0]), (4, [0.0, 0.0]), (5, None),
                               (6, [1.0, None])], "vec_id long, embedding array<double>")
    q = v.withColumnRenamed("vec_id", "query_id")
    assert V.cosine_topk(q.limit(0), v).collect() == [] == V.cosine_topk(q, v.limit(0)).collect()
    got = {(r["query_id"], r["vec_id"]) for r in V.cosine_topk(q, v, 1).collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}
    problems = {r["vec_id"]: r["problem"] for r in V.vector_problems(v).collect()}
    assert problems == {3: "length 1", 4: "all zero", 5: "missing", 6: "missing entry"}
    assert V.vector_problems(v.limit(0)).collect() == []


def test_retrieval_opens_the_wanted_months_only(spark, monthly, tmp_path):
    kb = str(tmp_path / "kb")
    jobs.build_knowledge_base(spark, str(monthly), kb)
    context = KB.retrieve_context(spark.read.parquet(kb), 2025, 9, n_recent=1)
    plan = context._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month_key" in plan.split("PartitionFilters: [")[1][:200]
    row = KB.context_by_month(context).collect()
    assert [r["month_key"] for r in row] == ["2025_08"]
    assert row[0]["metadata"][0]["source_file"] == "sales_2025_08_august.csv"
    assert len(row[0]["documents"]) == len(row[0]["metadata"]) == 1


# --- analytics ----------------------------------------------------------------------------

def test_store_and_frequency(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", "S1", 3, 2, 3.0, 1.0), (2, "b", "x", "S1", 3, 1, 1.0, .5),
         (3, "c", "y", "S1", 1, 5, 5.0, .5)],
        "product_id int, name string, category string, shelf_id string, rack_level int, "
        "units_sold int, revenue double, profit double")
    totals = SA.store_totals(df).first()
    assert (totals["total_units"], totals["margin_pct"]) == (8, pytest.approx(2 / 9 * 100))
    assert [r["name"] for r in SA.top_products(df, 2).collect()] == ["a", "b"]
    assert {r["product_id"]: r["n_neighbours"] for r in SA.neighbour_count(df).collect()} == {
        1: 1, 2: 1, 3: 0}
    assert SA.dominant(df, "category", ["product_id"]).first()["value"] == "x"
    assert SA.dominant(df, "name", ["product_id"]).first()["value"] == "a"
    assert SA.level_share(df).first()[0] == pytest.approx(200 / 3)
    freq = {(r["dimension"], r["value"]): r["n"] for r in SA.frequency(df, ["category", "shelf_id"]).collect()}
    assert freq == {("category", "x"): 2, ("category", "y"): 1, ("shelf_id", "S1"): 3}


def test_rolling_and_restock(spark):
    df = spark.createDataFrame([(1, d, 7 if d < 3 else 0, d == 4) for d in range(1, 10)],
                               "product_id int, day int, units_sold int, restocked boolean")
    rolling = {r["day"]: r for r in I.rolling_sales(df).collect()}
    assert rolling[1]["avg_7"] == 1.0 and rolling[2]["avg_30"] == pytest.approx(14 / 30)
    assert rolling[9]["avg_7"] == 0.0
    age = {r["day"]: r["days_since_restock"] for r in I.days_since_restock(df).collect()}
    assert age == {1: 1, 2: 2, 3: 3, 4: 0, 5: 1, 6: 2, 7: 3, 8: 4, 9: 5}


def test_metrics_and_guard(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "label double, prediction double")
    m = RP.regression_metrics(df).first()
    assert (m["mse"], m["mae"], m["r2"]) == (pytest.approx(1 / 3), pytest.approx(1 / 3), 0.5)
    with pytest.raises(ML.NotEnoughRows):
        ML.require_rows(df, 100)


def test_trees_predict_in_range(spark):
    k = F.col("id")
    features = spark.range(400).select(
        k.alias("product_id"), F.lit(0).alias("day"), (k % 4).alias("shelf_tier"),
        (k % 6 + 1).alias("facing_count"), (k % 7 == 0).cast("int").alias("is_end_cap"),
        (k % 10 == 0).cast("int").alias("is_checkout"), (k % 5 == 0).cast("int").alias("adjacency_promo"),
        (k % 10).alias("product_category"), (k % 49 + 0.99).alias("base_price"),
        (k % 55 / 100 + 0.1).alias("margin_pct"), (k % 15).alias("days_since_restock"),
        (k % 7).alias("day_of_week"), (k % 52 + 1).alias("week_of_year"))
    model, metrics = ML.fit_planogram_lift(I.with_lift(features), trees=15)
    assert metrics.first()["mae"] < 0.5
    low, high = ML.predict_planogram_lift(model, features).agg(
        F.min("prediction"), F.max("prediction")).first()
    assert 0.3 <= low <= high <= 4.0
    top = ML.feature_importances(model).orderBy(F.desc("importance")).first()["feature"]
    assert top in ("shelf_tier", "is_end_cap")


def test_splits_are_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "product_id")
    train, test = W.split(df, 0.85, 42, ["product_id"])
    assert train.count() + test.count() == 5000 and 600 < test.count() < 900
    again, _ = W.split(df.repartition(9), 0.85, 42, ["product_id"])
    assert train.exceptAll(again).count() == 0


def test_quality(spark):
    df = spark.createDataFrame([("a", "1,00 €"), ("a", "x"), (None, " ")], "category string, price string")
    assert tuple(Q.catalog_report(df).first()) == (3, 1, 1, 1, 1)


def test_transitions(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate("abab")] + [(2, 0, "a"), (2, 1, "a")],
                               "visit int, at int, section string")
    m = ST.transition_matrix(df, "visit", ["at"], "section")
    got = {(r["from_section"], r["to_section"]): (r["n"], r["probability"]) for r in m.collect()}
    assert got == {("a", "b"): (2, pytest.approx(2 / 3)), ("a", "a"): (1, pytest.approx(1 / 3)),
                   ("b", "a"): (1, 1.0)}


def test_two_files_of_every_month(spark, sf_dir):
    """No month is left out before the files are written and ingested."""
    months = {r[0] for r in planogram(spark, sf_dir).filter("shelf_level = 3")
              .select("month_key").distinct().collect()}
    kb = _two_files(spark, sf_dir).select("month_key", "source_file").distinct().collect()
    assert {r["month_key"] for r in kb} == months and len({m[:4] for m in months}) > 1
    assert all(r["source_file"].endswith("_b.csv") for r in kb)
