"""Explicit schemas for every file the engine reads."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
MONEY = T.DecimalType(18, 2)

CATALOG = _struct(
    ("Category", _S), ("name", _S), ("subtitle", _S), ("price", _S),
    ("discount_price", _S),
)

PLANOGRAM = _struct(
    ("Category", _S), ("name", _S), ("subtitle", _S), ("price", _S),
    ("discount_price", _S), ("price_numeric", _D),
    ("discount_price_numeric", _D), ("estimated_monthly_sales", _D),
    ("profit_margin_percentage", _D), ("product_width_cm", _D),
    ("rack_id", _I), ("shelf_level", _I),
)

DAILY_SALES = _struct(
    ("day", _I), ("product_id", _I), ("name", _S), ("category", _S),
    ("shelf_id", _S), ("rack_level", _I), ("units_sold", _I),
    ("revenue", MONEY), ("profit", MONEY),
)

TOP_PRODUCTS = _struct(
    ("product_id", _I), ("name", _S), ("category", _S), ("price", _D),
    ("margin", _D), ("popularity", _D), ("shelf_id", _S), ("rack_level", _I),
    ("total_units", _I), ("total_revenue", _D), ("total_profit", _D),
    ("sim_id", _I), ("seed", _I),
)

CATEGORIES = _struct(
    ("id", _I), ("name", _S), ("base_demand_mean_per_day", _D),
    ("seasonality_amp", _D), ("margin_avg", _D), ("facing_width_avg_cm", _D),
    ("products_per_category", _I),
    ("adjacency_bonus", T.MapType(_S, _D)),
)

CALENDAR = _struct(("day_of_year", _I), ("season_sin", _D), ("season_cos", _D))

RESULT = _struct(("mse", _D), ("original_profit", _D), ("optimized_profit", _D))
RESULTS = T.MapType(_S, RESULT)

ESTIMATES = T.ArrayType(_struct(
    ("estimated_monthly_sales", _D), ("profit_margin_percentage", _D),
    ("product_width_cm", _D),
))
MULTIPLIERS = T.MapType(_S, _D)

GRID_LAYOUT = _struct(
    ("height", _I), ("width", _I), ("door", T.ArrayType(_I)),
    ("shelves", T.ArrayType(_struct(
        ("id", _I), ("grid_pos", T.ArrayType(_I)),
        ("balda_capacity", T.ArrayType(_I)), ("facing_width_total", _I)))),
    ("adjacencies", T.ArrayType(_struct(
        ("shelf_id", _I), ("neighbors", T.ArrayType(_I))))),
)
