"""Views of the star-schema test tables in the engine's own data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def planogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly planogram: one row per (month, part), racks of one brand."""
    sales = (table(spark, sf_dir, "lineitem")
             .groupBy("l_partkey", F.trunc("l_shipdate", "MM").alias("_month"))
             .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("sales"))
             .withColumn("month_key", F.date_format("_month", "yyyy_MM")))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.concat("p_brand", F.lit("-"),
                 F.floor(F.col("p_partkey") / 2000).cast("string")).alias("rack_id"),
        ((F.col("p_retailprice") - 900.0) / 10.0).alias("price_numeric"),
        (20 + F.col("p_partkey") % 31).cast("double").alias("profit_margin_percentage"),
        F.col("p_size").cast("double").alias("product_width_cm"),
        (1 + (F.col("p_partkey") * 7919) % 7).cast("int").alias("shelf_level"),
        F.col("p_partkey").alias("l_partkey"))
    return sales.join(part, "l_partkey").select(
        "month_key", "product_id", "name", "category", "rack_id", "price_numeric",
        "profit_margin_percentage", F.col("sales").alias("estimated_monthly_sales"),
        "product_width_cm", "shelf_level")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue with Spanish price text.

    The text takes five forms by ``p_size % 5``: plain, with a thousands
    point, with a no-break space, blank and not a price.
    """
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    euros = F.concat((F.floor(cents / 100)).cast("string"), F.lit(","),
                     F.lpad((cents % 100).cast("string"), 2, "0"))
    form = F.col("p_size") % 5
    text = (F.when(form == 0, F.concat(euros, F.lit(" €")))
            .when(form == 1, F.concat(F.lit("1."), euros, F.lit(" €")))
            .when(form == 2, F.concat(euros, F.lit("\u00a0€")))
            .when(form == 3, F.lit("  "))
            .otherwise(F.concat(F.col("p_name"), F.lit(" €"))))
    words = F.array(*[F.lit(w) for w in CATEGORY_WORDS])
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.element_at(words, (F.col("p_partkey") % len(CATEGORY_WORDS) + 1).cast("int"))
        .alias("category"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("subtitle"),
        text.alias("price"),
        ((F.col("p_retailprice") - 900.0) / 10.0).alias("price_numeric"))


# Category names that hit different rules, in both rule tables.
CATEGORY_WORDS = (
    "Fruta y verdura", "Marisco fresco", "Congelados", "Chocolate negro",
    "Aguacate", "Turrón", "Vino tinto", "Pan de molde", "Leche entera",
    "Jamón serrano", "Cerveza", "Ferretería",
)


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per part: units, exact money, small-store attributes."""
    units = (table(spark, sf_dir, "lineitem")
             .groupBy(F.col("l_partkey").alias("product_id"),
                      F.to_date("l_shipdate").alias("sale_date"))
             .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units_sold")))
    return with_money(units.join(small_store(spark, sf_dir), "product_id"))


def run_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per (run, part): run = 1 + supplier % 10."""
    units = (table(spark, sf_dir, "lineitem")
             .groupBy((1 + F.col("l_suppkey") % 10).alias("sim_id"),
                      F.col("l_partkey").alias("product_id"),
                      F.to_date("l_shipdate").alias("sale_date"))
             .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units_sold")))
    return with_money(units.join(small_store(spark, sf_dir), "product_id"))


def small_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small-store catalogue: shelf = brand, four levels, price in cents."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        (F.round(F.col("p_retailprice") * 100).cast("bigint") % 1000 + 90)
        .cast("bigint").alias("price_cents"),
        (15 + F.col("p_partkey") % 26).cast("bigint").alias("margin_pct"),
        (45 + F.col("p_partkey") % 46).cast("bigint").alias("popularity_pct"),
        F.col("p_brand").alias("shelf_id"),
        (1 + F.col("p_partkey") % 4).cast("int").alias("rack_level"))


def with_money(df: DataFrame) -> DataFrame:
    """Revenue and profit of units sold, exact to the cent, halves up."""
    cents = F.col("units_sold") * F.col("price_cents")
    return (df.withColumn("revenue", (cents / 100).cast("decimal(18,2)"))
            .withColumn("profit", (F.floor((cents * F.col("margin_pct") + 50) / 100) / 100)
                        .cast("decimal(18,2)"))
            .withColumn("price", F.col("price_cents") / 100)
            .withColumn("margin", F.col("margin_pct") / 100)
            .withColumn("popularity", F.col("popularity_pct") / 100)
            .drop("price_cents", "margin_pct", "popularity_pct"))


def inventory_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed (demand, stock) per part and day, with restock days."""
    day = F.datediff(F.col("sale_date"), F.lit("1995-01-01").cast("date"))
    k = F.col("product_id")
    return (daily_sales(spark, sf_dir).select(
        "product_id", "category", "sale_date", day.alias("day"),
        F.col("units_sold").cast("double").alias("demand"),
        ((k * 13 + day * 7) % 60).cast("double").alias("stock_before"),
        F.round(F.col("price") * F.col("margin"), 4).alias("margin_abs"),
        F.col("price").alias("base_price"), F.col("margin").alias("margin_pct"),
        (F.lit(2.0) + k % 18).alias("base_demand"),
        (F.lit(30) + k % 90).cast("int").alias("max_inventory"),
        ((k + day) % 7 == 0).alias("restocked")))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store position per part key, with its attributes."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("position_id"),
        (k * 31 % 4).cast("int").alias("tier"),
        (1 + k % 4).cast("int").alias("facing_count"),
        (k % 7 == 0).alias("is_end_cap"),
        (k % 10 == 0).alias("is_checkout"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dynamics per part."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("product_id"),
        (k % 10).cast("int").alias("product_category"),
        ((F.col("p_retailprice") - 899.0) / 4.0).alias("base_price"),
        ((10 + k % 56) / 100).alias("margin_pct"),
        (F.lit(2.0) + k % 18).alias("base_demand"),
        (F.lit(30) + k % 90).cast("int").alias("max_inventory"))


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which product stands in which position on which day: every sale day."""
    day = F.datediff(F.col("sale_date"), F.lit("1995-01-01").cast("date"))
    return (daily_sales(spark, sf_dir)
            .select("product_id", F.col("product_id").alias("position_id"), day.alias("day"),
                    ((F.col("product_id") + day) % 15).cast("int").alias("days_since_restock"),
                    F.col("units_sold").cast("double").alias("inventory")))
