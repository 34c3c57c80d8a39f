"""Small parameter tables: category maps, quality rules, calendar, basket rules.

The maps and rules are fixed, user-supplied lists (tens of entries); they
become literal column expressions (``create_map``, ``CASE``), so they never
need a join.  The calendar is derived from the data by Spark and holds one
row per distinct scrape day.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Category maps (source category -> shared category name).
# Lookup is case-sensitive and exact; unmapped values become NULL.
# ---------------------------------------------------------------------------
CATEGORY_MAP_A = {
    "fruit & vegetables": "fruits_veg",
    "chips, chocolates & snacks": "snacks_confectionary",
    "frozen": "freezer",
    "drinks": "drinks",
    "liquorland": "alcohol",
    "dairy, eggs & fridge": "dairy_eggs_fridge",
    "home & garden": "home_garden",
    "meat & seafood": "poultry_meat_seafood",
    "pantry": "pantry",
    "dietary & world foods": "international_food",
    "cleaning & laundry": "cleaning_laundry",
    "health & beauty": "health_beauty",
    "pet": "pet",
    "baby": "baby",
    "bakery": "bakery",
    "deli": "deli",
}
CATEGORY_MAP_B = {
    "lunch_box": "lunch_box",
    "drinks": "drinks",
    "fruits_veg": "fruits_veg",
    "dinner": "dinner",
    "deli": "deli",
    "pantry": "pantry",
    "bakery": "bakery",
    "freezer": "freezer",
    "snacks_confectionary": "snacks_confectionary",
    "international_food": "international_food",
    "half_price": "half_price",
    "poultry_meat_seafood": "poultry_meat_seafood",
    "dairy_eggs_fridge": "dairy_eggs_fridge",
    "beer_wine_spirits": "alcohol",
}

# Quality rules (expect-or-drop).
STAGE_A_RULES = [
    ("non_null_scrape_timestamp", "scrape_timestamp IS NOT NULL"),
    ("valid_store_id_a", "store_id = 1000"),
    ("category_mapped_a", "category_name IS NOT NULL"),
    ("sku_present_a", "store_sku IS NOT NULL"),
]
STAGE_B_RULES = [
    ("valid_store_id_b", "store_id = 1001"),
    ("category_mapped_b", "category_name IS NOT NULL"),
    ("sku_present_b", "store_sku IS NOT NULL"),
]
PRICE_RULES = [
    ("known_store_ids", "store_id IN (1000, 1001)"),
    ("scrape_ts_present", "scrape_timestamp IS NOT NULL"),
    ("regular_price_non_negative", "regular_price >= 0"),
    ("promo_price_non_negative", "promo_price >= 0"),
    ("has_store_product_match", "store_product_id IS NOT NULL"),
]

# Scrape days of the published trend: (week, week start, days).
SCRAPE_WEEKS = (
    (1, "2025-11-03", ("2025-11-04", "2025-11-10")),
    (2, "2025-11-10", ("2025-11-07", "2025-11-12")),
    (3, "2025-11-17", ("2025-11-17",)),
)
# Fuzzy match cut-off (0..100) and the id offset used when A has no ids.
MATCH_SCORE_THRESHOLD = 80
FALLBACK_ID_START = 27624
# Calendar rule for the driver data: weeks counted from this Monday.
WEEK_ORIGIN = "1995-01-02"
# ---------------------------------------------------------------------------


def map_column(mapping: dict[str, str], col) -> Column:
    """Literal map lookup (missing key -> NULL)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    c = F.col(col) if isinstance(col, str) else col
    return m[c]


@dataclass(frozen=True)
class BasketRule:
    priority: int
    label: str
    name_like: str | None
    category: str | None
    brands: tuple[str, ...] | None


# ---------------------------------------------------------------------------
# The published basket rules (a brand with a leading blank is
# meant as it stands).
# ---------------------------------------------------------------------------
PUBLISHED_BASKET_RULES = (
    BasketRule(1, "Milk", "%milk%", "dairy_eggs_fridge", ("Pauls", "Vitasoy", "Devondale")),
    BasketRule(2, "Egg", "%egg%", "dairy_eggs_fridge", ("Sunny Queen",)),
    BasketRule(3, "Snacks", "%tim%tam%", "snacks_confectionary", ("Arnotts",)),
    BasketRule(4, "Butter", "%butter%", "dairy_eggs_fridge", ("Devondale", "Lurpak")),
    BasketRule(5, "Pasta", "%pasta%", "dairy_eggs_fridge", ("25 Degrees South",)),
    BasketRule(6, "Ice cream", None, "freezer", ("Connoisseur", "Sara Lee", " Peters", "Reese's")),
    BasketRule(7, "International food", None, "international_food", None),
)

# Basket rules for the driver data (FIXTURES.md §5).
BASKET_RULES = (
    BasketRule(1, "Widgets", "%widget%", "dairy_eggs_fridge", ("Brand#1", "Brand#2", "Brand#3")),
    BasketRule(2, "Gears", "%gear%", "bakery", ("Brand#4", "Brand#6")),
    BasketRule(3, "Rings and rods", "%r%", "drinks", ("Brand#7", "Brand#8")),
    BasketRule(4, "Freezer", None, "freezer", ("Brand#9", "Brand#10")),
    BasketRule(5, "Pantry", None, "pantry", None),
)


def basket_label(rules=BASKET_RULES, name="canonical_name", category="category_name") -> Column:
    """First rule (by priority) whose name pattern -- or, without one, whose
    category -- fits the row."""
    out = None
    for r in sorted(rules, key=lambda r: r.priority):
        cond = F.col(name).like(r.name_like) if r.name_like is not None else (F.col(category) == F.lit(r.category))
        out = F.when(cond, F.lit(r.label)) if out is None else out.when(cond, F.lit(r.label))
    return out


def basket_filter(rules=BASKET_RULES, name="canonical_name", category="category_name",
                  brand="brand_name") -> Column:
    """Row belongs to the basket when every condition of some rule holds."""
    out = F.lit(False)
    for r in rules:
        cond = F.lit(True)
        if r.name_like is not None:
            cond = cond & F.col(name).like(r.name_like)
        if r.category is not None:
            cond = cond & (F.col(category) == F.lit(r.category))
        if r.brands is not None:
            cond = cond & F.col(brand).isin(list(r.brands))
        out = out | cond
    return out


def calendar_from_dates(dates: DataFrame, date_col: str = "scrape_date") -> DataFrame:
    """(scrape_date DATE, week_num INT, week_start DATE) for each distinct day.

    ``week_start`` is the Monday of the day; ``week_num`` counts whole weeks
    from WEEK_ORIGIN, plus one."""
    d = dates.select(F.col(date_col).cast("date").alias("scrape_date")).where(F.col("scrape_date").isNotNull()).distinct()
    return d.select(
        "scrape_date",
        (F.floor(F.datediff("scrape_date", F.lit(WEEK_ORIGIN).cast("date")) / 7) + 1).cast("int").alias("week_num"),
        F.date_trunc("week", "scrape_date").cast("date").alias("week_start"))


def calendar_from_weeks(spark: SparkSession, weeks=SCRAPE_WEEKS) -> DataFrame:
    """The same columns from a list of (week number, week start, scrape days);
    a day in no week has no row, so its prices drop out of the trend."""
    rows = [(day, num, start) for num, start, days in weeks for day in days]
    return spark.createDataFrame(rows, "scrape_date string, week_num int, week_start string").select(
        F.col("scrape_date").cast("date").alias("scrape_date"), "week_num", F.col("week_start").cast("date").alias("week_start"))
