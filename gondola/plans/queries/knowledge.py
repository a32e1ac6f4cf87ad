"""Knowledge base, retrieval, files in and out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.numbers import half_up
from ...operators import knowledge as KB
from ...operators.enrich import batch_rows, enrich_heuristic, enrich_resumable
from ...operators.ranking import top_n
from ...session import shared_dir, written
from ...sources import readers, sinks
from .. import tables as T
from . import sql as S
from .enrichment import (_band_ctes, _heuristic, _season_ctes)
from ... import rules

_AVG = ("avg_sales", "avg_price", "avg_margin", "avg_width")


def _rounded(df, *columns):
    return df.select(*[c for c in df.columns if c not in columns],
                     *[half_up(c, 4).alias(c) for c in columns])


def _stored(spark, d, **writer):
    """The planogram written as monthly files and read back."""
    path = shared_dir(spark)
    sinks.write_monthly(_with_text(spark, d), path, **writer)
    return path


def _with_text(spark, d):
    return T.planogram(spark, d).withColumns({
        "subtitle": F.lit("-"), "price": F.lit("1,00 €"), "discount_price": F.lit(None).cast("string"),
        "discount_price_numeric": F.lit(0.0), "rack_id": F.col("product_id").cast("int")})


_READ = ["month_key", "year", "month", "month_name", "name", "rack_id",
         "estimated_monthly_sales", "shelf_level"]


def _skipped(spark, d):
    """Two writes; the second one only adds the months the first one lacks."""
    path = shared_dir(spark)
    df = _with_text(spark, d)
    sinks.write_monthly(df.filter(F.col("month_key") < "1999_01"), path)
    doubled = df.withColumn("estimated_monthly_sales", F.col("estimated_monthly_sales") * 2)
    sinks.write_monthly(doubled, path, skip_existing=True)
    return readers.read_monthly(spark, path).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("estimated_monthly_sales").cast("bigint").alias("sales"))


def _knowledge(spark, d):
    """A written knowledge base: all months, then the months of 1998 replaced."""
    path = shared_dir(spark)
    df = T.planogram(spark, d)
    sinks.upsert_months(KB.kb_chunks(df), path)
    again = df.filter(F.col("month_key").startswith("1998"))
    sinks.upsert_months(KB.kb_chunks(again.filter(F.col("category") != "PROMO")), path)
    return spark.read.parquet(path)


def _kb_table(spark, d):
    kb = _knowledge(spark, d)
    return kb.select("id", "document", "year", "month", "month_name", "category", "n_products",
                     half_up("total_sales", 2).alias("total_sales"),
                     *[half_up(c, 4).alias(c) for c in ("avg_sales", "avg_price", "avg_margin")],
                     "source_file", "month_key")


def _stats(spark, d):
    return KB.kb_stats(KB.kb_chunks(T.planogram(spark, d))).withColumn(
        "months", F.array_join("months", ","))


def _trend(spark, d):
    trend = KB.category_trend(KB.category_summary(T.planogram(spark, d)))
    return _rounded(trend, "change_previous", "change_last_year")


def stored_chunks(spark, d):
    """A written knowledge base of all months, cut by month."""
    path = shared_dir(spark)
    sinks.upsert_months(KB.kb_chunks(T.planogram(spark, d)), path)
    return spark.read.parquet(path)


def _context(spark, d):
    return KB.retrieve_context(stored_chunks(spark, d), 2000, 3).select(
        "month_key", "category", "document")


def _context_documents(spark, d):
    docs = KB.context_by_month(KB.retrieve_context(stored_chunks(spark, d), 2000, 3, n_recent=12))
    about = F.transform("metadata", lambda m: F.concat_ws(
        "|", m["category"], m["month_name"], m["n_products"].cast("string"),
        F.format_string("%.2f", m["total_sales"]), m["source_file"]))
    return docs.select("month_key", F.array_join("documents", "\n").alias("documents"),
                       F.array_join(about, "\n").alias("metadata"))


def _latest_file(spark, d):
    return readers.read_latest(spark, _stored(spark, d), category="PROMO").select(
        "month_key", "name", "rack_id", "shelf_level")


def _resumed(spark, d):
    """Enrichment that was stopped after some batches and then resumed; batches are numbered once."""
    path = shared_dir(spark)
    rows = written(batch_rows(T.planogram(spark, d).drop("estimated_monthly_sales"), 30))
    enrich_resumable(rows.filter(F.col("batch_id") < 20), path, enrich_heuristic)
    return enrich_resumable(rows, path, enrich_heuristic, slices=2).select(
        "month_key", "product_id", "batch_id", "item_no", "estimated_monthly_sales",
        "profit_margin_percentage", "product_width_cm")


QUERIES = {
    "g6_category_summary": lambda s, d: _rounded(KB.category_summary(T.planogram(s, d)), *_AVG),
    "g7_category_documents": lambda s, d: KB.category_documents(T.planogram(s, d)).select(
        "month_key", "category", "document"),
    "g8_kb_stats": _stats,
    "g9_month_stats": lambda s, d: _rounded(
        KB.month_stats(T.planogram(s, d)), "avg_sales", "avg_margin", "avg_width"),
    "k3_upsert_months": _kb_table,
    "r1_u2_f2_retrieve_context": _context,
    "r1_context_documents": _context_documents,
    "w3_top_sellers": lambda s, d: top_n(
        T.planogram(s, d), ["month_key", "category"],
        [F.desc("estimated_monthly_sales"), "product_id"], 5).select(
            "month_key", "category", "product_id", "estimated_monthly_sales", "rank"),
    "w5_category_trend": _trend,
    "u3_distinct_keys": lambda s, d: KB.months_present(
        T.planogram(s, d), ["month_key", "rack_id", "category"]),
    "s4_latest_month": lambda s, d: KB.latest_month(T.planogram(s, d), "PROMO"),
    "s4_latest_file": _latest_file,
    "s10_load_summary": lambda s, d: readers.load_summary(
        readers.read_monthly(s, _stored(s, d))).drop("n_categories"),
    "k1_s2_s3_monthly_files": lambda s, d: readers.read_monthly(
        s, _stored(s, d), strict=True).select(*_READ),
    "k2_skip_existing": _skipped,
    "r4_batch_rows": lambda s, d: batch_rows(T.planogram(s, d), 30).select(
        "month_key", "product_id", "batch_id", "item_no"),
    "k7_resumable_enrichment": _resumed,
}

_DOC = f"""docs AS (
  SELECT month_key, category, n_products, total_sales, avg_sales, avg_price, avg_margin,
    'Category: ' || category || ' | Month: ' || substr(month_key, 6, 2) || '/' || substr(month_key, 1, 4)
    || ' | Products: ' || n_products || ' | Total sales: ' || total_units
    || ' units | Avg sales/product: ' || CAST({S.half_up('avg_sales', 0)} AS BIGINT)
    || ' | Avg price: €' || printf('%.2f', {S.half_up('avg_price', 2)})
    || ' | Avg margin: ' || printf('%.1f', {S.half_up('avg_margin', 1)})
    || '% | Avg width: ' || printf('%.1f', {S.half_up('avg_width', 1)})
    || 'cm | Shelf distribution: [' || shelves || '] | Top sellers: ' || sellers AS document
  FROM (SELECT month_key, category, count(*) AS n_products,
               CAST(sum(estimated_monthly_sales) AS BIGINT) AS total_units,
               CAST(sum(estimated_monthly_sales) AS DOUBLE) AS total_sales,
               avg(estimated_monthly_sales) AS avg_sales, avg(price_numeric) AS avg_price,
               avg(profit_margin_percentage) AS avg_margin, avg(product_width_cm) AS avg_width
        FROM source GROUP BY 1, 2) a
  JOIN (SELECT month_key, category, string_agg('S' || shelf_level || ': ' || n, ', ' ORDER BY shelf_level) AS shelves
        FROM (SELECT month_key, category, shelf_level, count(*) AS n FROM source GROUP BY 1, 2, 3) x
        GROUP BY 1, 2) b USING (month_key, category)
  JOIN (SELECT month_key, category,
               string_agg(name || ' (' || estimated_monthly_sales || ' units)', ', ' ORDER BY rn) AS sellers
        FROM (SELECT *, row_number() OVER (PARTITION BY month_key, category
                ORDER BY estimated_monthly_sales DESC, product_id) AS rn FROM source) y
        WHERE rn <= 5 GROUP BY 1, 2) c USING (month_key, category))"""
_ALL = "source AS (SELECT * FROM retail)"
_UPSERTED = ("source AS (SELECT * FROM retail WHERE NOT "
             "(substr(month_key, 1, 4) = '1998' AND category = 'PROMO'))")
_NAME = ("['january', 'february', 'march', 'april', 'may', 'june', 'july', 'august', "
         "'september', 'october', 'november', 'december'][CAST(substr(month_key, 6, 2) AS INTEGER)]")
_WANTED = "('2000_01', '2000_02', '1999_03')"


def _h4(expression: str, name: str) -> str:
    return f"{S.half_up(expression, 4)} AS {name}"


ORACLES = {
    "g6_category_summary": S.query(f"""SELECT month_key, category, count(*) AS n_products,
  CAST(sum(estimated_monthly_sales) AS DOUBLE) AS total_sales,
  {_h4('avg(estimated_monthly_sales)', 'avg_sales')}, {_h4('avg(price_numeric)', 'avg_price')},
  {_h4('avg(profit_margin_percentage)', 'avg_margin')}, {_h4('avg(product_width_cm)', 'avg_width')}
FROM retail GROUP BY 1, 2""", S.PLANOGRAM),
    "g7_category_documents": S.query(
        "SELECT month_key, category, document FROM docs", S.PLANOGRAM, _ALL, _DOC),
    "g8_kb_stats": S.query("""SELECT count(*) AS total_chunks,
  (SELECT string_agg(m, ',' ORDER BY m) FROM (SELECT DISTINCT month_key AS m FROM retail) x) AS months,
  count(DISTINCT month_key) AS n_months, count(DISTINCT category) AS n_categories
FROM (SELECT DISTINCT month_key, category FROM retail) t""", S.PLANOGRAM),
    "g9_month_stats": S.query(f"""SELECT month_key, count(*) AS n_products,
  count(DISTINCT category) AS n_categories, {_h4('avg(estimated_monthly_sales)', 'avg_sales')},
  {_h4('avg(profit_margin_percentage)', 'avg_margin')}, {_h4('avg(product_width_cm)', 'avg_width')}
FROM retail GROUP BY 1""", S.PLANOGRAM),
    "k3_upsert_months": S.query(f"""SELECT month_key || '_' || category AS id, document,
  CAST(substr(month_key, 1, 4) AS INTEGER) AS year, CAST(substr(month_key, 6, 2) AS INTEGER) AS month,
  {_NAME} AS month_name, category, n_products, {S.half_up('total_sales', 2)} AS total_sales,
  {_h4('avg_sales', 'avg_sales')}, {_h4('avg_price', 'avg_price')}, {_h4('avg_margin', 'avg_margin')},
  'sales_' || month_key || '_' || {_NAME} || '.csv' AS source_file, month_key
FROM docs""", S.PLANOGRAM, _UPSERTED, _DOC),
    "r1_u2_f2_retrieve_context": S.query(
        f"SELECT month_key, category, document FROM docs WHERE month_key IN {_WANTED}",
        S.PLANOGRAM, _ALL, _DOC),
    "r1_context_documents": S.query(
        "SELECT month_key, string_agg(document, chr(10) ORDER BY category) AS documents, "
        f"string_agg(category || '|' || {_NAME} || '|' || n_products || '|' || "
        f"printf('%.2f', total_sales) || '|sales_' || month_key || '_' || {_NAME} || '.csv', "
        "chr(10) ORDER BY category) AS metadata FROM docs "
        "WHERE month_key BETWEEN '1999_03' AND '2000_02' GROUP BY 1", S.PLANOGRAM, _ALL, _DOC),
    "w3_top_sellers": S.query("""SELECT month_key, category, product_id, estimated_monthly_sales,
  CAST(row_number() OVER (PARTITION BY month_key, category
    ORDER BY estimated_monthly_sales DESC, product_id) AS INTEGER) AS rank
FROM retail QUALIFY rank <= 5""", S.PLANOGRAM),
    "w5_category_trend": S.query(f"""SELECT a.month_key, a.category, a.total_sales,
  p.total_sales AS sales_previous, y.total_sales AS sales_last_year,
  {_h4('a.total_sales / p.total_sales - 1', 'change_previous')},
  {_h4('a.total_sales / y.total_sales - 1', 'change_last_year')}
FROM m a LEFT JOIN m p ON p.category = a.category AND p.first = a.first - INTERVAL 1 MONTH
LEFT JOIN m y ON y.category = a.category AND y.first = a.first - INTERVAL 1 YEAR""", S.PLANOGRAM,
        """m AS (SELECT month_key, category, strptime(month_key || '_01', '%Y_%m_%d') AS first,
  CAST(sum(estimated_monthly_sales) AS DOUBLE) AS total_sales FROM retail GROUP BY 1, 2)"""),
    "u3_distinct_keys": S.query(
        "SELECT DISTINCT month_key, rack_id, category FROM retail", S.PLANOGRAM),
    "s4_latest_month": S.query(
        "SELECT * FROM retail WHERE month_key = (SELECT max(month_key) FROM retail) "
        "AND category = 'PROMO'", S.PLANOGRAM),
    "s4_latest_file": S.query(
        "SELECT month_key, name, CAST(product_id AS INTEGER) AS rack_id, shelf_level FROM retail "
        "WHERE month_key = (SELECT max(month_key) FROM retail) AND category = 'PROMO'", S.PLANOGRAM),
    "s10_load_summary": S.query(
        "SELECT count(*) AS n_rows, count(DISTINCT month_key) AS n_months, "
        "count(DISTINCT month_key) AS n_files FROM retail", S.PLANOGRAM),
    "k1_s2_s3_monthly_files": S.query(f"""SELECT month_key,
  CAST(substr(month_key, 1, 4) AS INTEGER) AS year, CAST(substr(month_key, 6, 2) AS INTEGER) AS month,
  {_NAME} AS month_name, name, CAST(product_id AS INTEGER) AS rack_id,
  CAST(estimated_monthly_sales AS DOUBLE) AS estimated_monthly_sales, shelf_level FROM retail""",
                                      S.PLANOGRAM),
    "k2_skip_existing": S.query("""SELECT month_key, count(*) AS n,
  CAST(sum(CASE WHEN month_key < '1999_01' THEN 1 ELSE 2 END * estimated_monthly_sales) AS BIGINT) AS sales
FROM retail GROUP BY 1""", S.PLANOGRAM),
    "r4_batch_rows": S.query("""SELECT month_key, product_id, (rn - 1) // 30 AS batch_id,
  CAST((rn - 1) % 30 + 1 AS INTEGER) AS item_no
FROM (SELECT month_key, product_id, row_number() OVER (PARTITION BY month_key ORDER BY product_id) AS rn
      FROM retail) t""", S.PLANOGRAM),
    "k7_resumable_enrichment": S.query(f"""SELECT month_key, product_id, (rn - 1) // 30 AS batch_id,
  CAST((rn - 1) % 30 + 1 AS INTEGER) AS item_no, {_heuristic('t', 'month_key', 'product_id')}
FROM (SELECT *, row_number() OVER (PARTITION BY month_key ORDER BY product_id) AS rn,
             CAST(substr(month_key, 6, 2) AS INTEGER) AS month FROM retail) t
JOIN season USING (category, month) JOIN band USING (category)""", S.PLANOGRAM,
        _season_ctes("season", rules.SEASONAL_GENERATION,
                     "(SELECT category, CAST(substr(month_key, 6, 2) AS INTEGER) AS month FROM retail)"),
        _band_ctes("band", rules.BANDS_GENERATION, "retail")),
}
