"""Fixed values of the retail model, stated once and used by every operator."""

# --- fixed values: rack geometry -------------------------------------------
SHELF_WIDTH_CM = 300.0
NUM_SHELVES = 7
SHELVES = tuple(range(1, NUM_SHELVES + 1))
BOTTOM_SHELVES = (1, 2)
EYE_SHELVES = (3, 4, 5)
TOP_SHELVES = (6, 7)

# --- fixed values: seven-level rack visibility (1 = floor) ------------------
SHELF_MULTIPLIERS = {1: 0.7, 2: 0.7, 3: 1.2, 4: 1.2, 5: 1.2, 6: 0.8, 7: 0.8}
DEFAULT_MULTIPLIER = 1.0

# --- fixed values: rack dynamics -------------------------------------------
CROWDING_FREE = 5
CROWDING_STEP = 0.05
CROWDING_FLOOR = 0.5
FILL_FREE = 0.6
FILL_SLOPE = 0.5
FILL_FLOOR = 0.7
PREMIUM_PRICE = 5.0
BUDGET_PRICE = 2.0
PREMIUM_EYE_BONUS = 1.1
BUDGET_BOTTOM_BONUS = 1.15
PREMIUM_BOTTOM_PENALTY = 0.85
SPREAD_BONUS = 0.15

# --- fixed values: four-level small store -----------------------------------
SMALL_STORE_LEVELS = {1: 0.50, 2: 0.75, 3: 1.00, 4: 0.65}
BASE_DAILY_DEMAND = 20
ADJACENCY_STEP = 0.05
ADJACENCY_CAP = 0.15

# --- fixed values: planogram lift -------------------------------------------
TIER_LIFT = {0: 0.70, 1: 0.85, 2: 1.00, 3: 1.60}
FACING_GAIN = 0.12
END_CAP_GAIN = 0.50
CHECKOUT_GAIN = 0.30
CHECKOUT_CATEGORIES_BELOW = 4
PROMO_GAIN = 0.20
WEEKEND_GAIN = 0.15
STALE_LOSS_PER_DAY = 0.03
STALE_DAYS_CAP = 10
LIFT_MIN = 0.3
LIFT_MAX = 4.0

# --- fixed values: inventory economics ---------------------------------------
HOLDING_COST = 0.02
PARTIAL_STOCKOUT_PENALTY = 2.0
FULL_STOCKOUT_PENALTY = 5.0
PARTIAL_FILL_THRESHOLD = 0.50

# --- fixed values: documented store model ------------------------------------
LEVEL_VISIBILITY = {1: 0.70, 2: 0.85, 3: 1.20, 4: 0.95, 5: 0.75}
TRAFFIC_DECAY = 0.15
DAYS_IN_SEASON = 365

# --- fixed values: forecast multipliers and estimate replies -----------------
MULTIPLIER_MIN = 0.3
MULTIPLIER_MAX = 2.5
DEFAULT_SALES = 50
DEFAULT_MARGIN = 30.0
DEFAULT_WIDTH = 12.0
MARGIN_RANGE = (1.0, 70.0)
WIDTH_RANGE = (2.0, 60.0)

# --- fixed values: file names and column orders ------------------------------
MONTH_FILE_PATTERN = r"sales_(\d{4})_(\d{2})_(\w+)\.csv"
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june", "july",
    "august", "september", "october", "november", "december",
)
# --- fixed values: labels of a category's monthly line, in order ---------------
SUMMARY_LABELS = (
    "Category: ", " | Month: ", " | Products: ", " | Total sales: ",
    " units | Avg sales/product: ", " | Avg price: €", " | Avg margin: ",
    "% | Avg width: ", "cm | Shelf distribution: [", "] | Top sellers: ",
)
PLANOGRAM_COLUMNS = (
    "Category", "name", "subtitle", "price", "discount_price",
    "price_numeric", "discount_price_numeric",
    "estimated_monthly_sales", "profit_margin_percentage",
    "product_width_cm", "rack_id", "shelf_level",
)
MOVE_FEATURES = (
    "price_numeric", "profit_margin_percentage", "estimated_monthly_sales",
    "product_width_cm", "original_shelf", "new_shelf",
    "n_products_on_original_shelf", "n_products_on_new_shelf",
    "n_shelves_used", "rack_product_count",
)
LIFT_FEATURES = (
    "shelf_tier", "facing_count", "is_end_cap", "is_checkout",
    "adjacency_promo", "product_category", "base_price", "margin_pct",
    "days_since_restock", "day_of_week", "week_of_year",
)

# Default rack identity: a rack belongs to one month.
RACK_KEYS = ("month_key", "rack_id")
