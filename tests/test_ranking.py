"""Block-wise ranking against plain windows, with a hot group."""

from pyspark.sql import Window, functions as F

from gondola.functions.numbers import half_up, uniform
from gondola.operators import ranking as RK


def groups(spark, n=6000):
    """A third of all rows in group 0."""
    k = F.col("id")
    return spark.range(n).select(
        k, F.when(k % 3 == 0, 0).otherwise(k % 50 + 1).alias("g"),
        (F.xxhash64(k) % 97).cast("double").alias("v"))


def test_row_numbers(spark):
    df = groups(spark)
    got = RK.row_numbers(df, ["g"], ["id"])
    want = df.withColumn("row_no", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert got.select("id", "row_no").exceptAll(want.select("id", "row_no")).count() == 0
    assert got.count() == want.count()


def test_row_numbers_along_two_columns(spark):
    df = groups(spark)
    order = [F.desc("v"), "id"]
    got = RK.row_numbers(df, ["g"], order)
    want = df.withColumn("row_no", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.select("id", "row_no").exceptAll(want.select("id", "row_no")).count() == 0
    assert got.count() == want.count()


def test_row_numbers_without_groups(spark):
    df = groups(spark, 500)
    got = RK.row_numbers(df, [], ["id"]).collect()
    assert all(r["row_no"] == r["id"] + 1 for r in got)


def test_row_numbers_of_text_and_sparse_keys(spark):
    """One hot group; the keys share a long prefix, or lie far apart."""
    df = spark.range(20_000).select(
        F.lit("hot").alias("g"), F.format_string("SKU-%08d", "id").alias("t"),
        (F.col("id") * 1_000_003).alias("far"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for key in ("t", "far"):
            got = RK.row_numbers(df, ["g"], [key])
            assert got.filter("row_no <> id + 1").count() == 0 and got.count() == 20_000
            blocks = RK.ordered_blocks(df, ["g"], [key]).groupBy("_block").count().collect()
            assert len(blocks) > 4 and max(r["count"] for r in blocks) < 8_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_row_numbers_of_null_groups_and_lags_of_nulls(spark):
    rows = [(None, 1, "a"), (None, 2, None), ("g", 1, "b"), ("g", 2, None), ("g", 3, "c")]
    df = spark.createDataFrame(rows, "g string, id int, s string")
    got = {(r["g"], r["id"]): r["row_no"] for r in RK.row_numbers(df, ["g"], ["id"]).collect()}
    assert got == {(g, i): i for g, i, _ in rows}
    lag = {(r["g"], r["id"]): r["p"] for r in RK.previous_value(df, ["g"], ["id"], "s", "p").collect()}
    assert lag == {(None, 1): None, (None, 2): "a", ("g", 1): None, ("g", 2): "b", ("g", 3): None}


def test_previous_value(spark):
    df = groups(spark).withColumn("s", F.concat(F.lit("s"), F.col("id").cast("string")))
    got = RK.previous_value(df, ["g"], ["id"], "s", "prev")
    want = df.withColumn("prev", F.lag("s").over(Window.partitionBy("g").orderBy("id")))
    assert got.select("id", "prev").exceptAll(want.select("id", "prev")).count() == 0
    assert got.count() == want.count()


def test_top_n(spark):
    got = RK.top_n(groups(spark), ["g"], [F.desc("v"), "id"], 3)
    assert got.groupBy("g").count().filter("count <> 3").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_first_fraction_keeps_exactly_the_quota(spark):
    df = groups(spark)
    wanted = df.groupBy("g").agg(F.floor(F.count(F.lit(1)) * 0.37).alias("n_keep"))
    got = RK.first_fraction(df, ["g"], uniform(1, "id"), ["id"], wanted, buckets=64)
    sizes = got.groupBy("g").count().join(wanted, "g", "full")
    assert sizes.filter("count <> n_keep or count is null").count() == 0
    w = Window.partitionBy("g").orderBy(uniform(1, "id"), "id")
    want = (df.withColumn("rn", F.row_number().over(w)).join(wanted, "g")
            .filter("rn <= n_keep").select("id"))
    assert got.select("id").exceptAll(want).count() == 0


def test_first_fraction_of_everything(spark):
    df = groups(spark, 300)
    wanted = df.select("g").distinct().withColumn("n_keep", F.lit(10_000))
    assert RK.first_fraction(df, ["g"], uniform(1, "id"), ["id"], wanted).count() == 300


def test_first_fraction_broadcasts_quotas_and_no_rows(spark, tmp_path):
    spark.range(50_000).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows")).withColumn(
        "g", F.explode(F.array(F.lit("a"), F.lit("b"))))
    wanted = spark.createDataFrame([("a", 100), ("b", 40_000)], "g string, n_keep long")
    got = RK.first_fraction(rows, ["g"], uniform(1, "g", "id"), ["id"], wanted)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and "SortMergeJoin" not in plan
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {"a": 100, "b": 40_000}


def test_merged_shuffle_partitions_stay_small(spark):
    settings = {"spark.sql.shuffle.partitions": "64",
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(2_500_000).select("id", *[F.xxhash64("id", F.lit(i)).alias(f"h{i}")
                                                     for i in range(2)])
        assert rows.repartition("id").rdd.getNumPartitions() >= 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_half_up_takes_noise_for_a_tie(spark):
    row = spark.range(1).select(
        half_up(F.lit(1.005), 2).alias("a"), half_up(F.lit(2.675), 2).alias("b"),
        half_up(F.lit(2.5), 0).alias("c"), half_up(F.lit(-1.25), 1).alias("d"),
        half_up(F.lit(1.0049), 2).alias("e")).first()
    assert tuple(row) == (1.01, 2.68, 3.0, -1.2, 1.0)


def test_uniform_is_uniform_and_stable(spark):
    u = spark.range(20_000).select("id", uniform(7, "id").alias("u"))
    stats = u.agg(F.min("u"), F.max("u"), F.avg("u"), F.stddev("u")).first()
    assert 0 <= stats[0] < 0.001 and 0.999 < stats[1] < 1
    assert abs(stats[2] - 0.5) < 0.01 and abs(stats[3] - 0.2887) < 0.01
    again = spark.range(20_000).repartition(13).select("id", uniform(7, "id").alias("u"))
    assert u.exceptAll(again).count() == 0
