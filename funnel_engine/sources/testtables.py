"""Session view over the TPC-H-style test tables.

One session per order: ``orders`` joined to ``customer``, ``nation`` and
``region`` on their keys. Funnel stages nest because the thresholds on one
hash of the order fall stage by stage. The mapping is plain column
expressions, so Catalyst prunes the scans to the columns each query needs and
picks the join strategies itself: nation and region are tiny and fall under
the planner's size-checked broadcast threshold; orders x customer is a
sort-merge join on the customer key at scale (AQE splits a skewed key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# --- fixed values of the test-table mapping ---------------------------------
HASH_ORDER_MULT = 7919
HASH_CUST_MULT = 104729
HASH_MOD = 100
# Stage thresholds on the hash: viewed / cart / checkout / purchase.
STAGE_THRESHOLDS = (65, 45, 35, 25)
MOBILE_SHARE = 7  # o_orderkey % 10 < 7 -> Mobile
DISCOUNT_EVERY = 4  # purchases with o_orderkey % 4 == 0 are discounted
DISCOUNT_FACTOR = "0.9"
# Dirty variant: bad dates, bad revenue text, upper-case / missing purchase flags.
DIRTY_DATE_EVERY = 97
DIRTY_REVENUE_EVERY = 89
DIRTY_UPPER_EVERY = 13
DIRTY_NULL_EVERY = 11
# Variant with gaps: a column is NULL on every so-many-th session.
GAP_EVERY = {"user_id": 19, "session_id": 17, "channel": 23, "campaign_type": 31, "region": 29, "month": 37}
# Choices for queries that take any: months, and an analysis date, inside the data.
CHOSEN_MONTHS = ("1995-03", "1996-07", "1996-08")
AS_OF_INSIDE = "1998-07-15"
# -----------------------------------------------------------------------------


# Columns of the test tables this mapping reads. Declaring them skips the
# footer read for schema inference and is the projection pushed to the scan.
TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _yes_if(cond: Column) -> Column:
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def _order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )


def _hash() -> Column:
    return (F.col("o_orderkey") * HASH_ORDER_MULT + F.col("o_custkey") * HASH_CUST_MULT) % HASH_MOD


def _session_columns() -> dict[str, Column]:
    h = _hash()
    key = F.col("o_orderkey")
    views, carts, checkouts, purchases = STAGE_THRESHOLDS
    purchased = h < purchases
    discounted = purchased & (key % DISCOUNT_EVERY == 0)
    order_value = F.col("o_totalprice").cast(DecimalType(18, 2))
    factor = F.when(discounted, F.lit(DISCOUNT_FACTOR).cast(DecimalType(2, 1))).otherwise(
        F.lit("1.0").cast(DecimalType(2, 1))
    )
    date = F.col("o_orderdate").cast("date")
    return {
        "user_id": F.col("o_custkey"),
        "session_id": key,
        "date": date,
        "month": F.date_format(date, "yyyy-MM"),
        "channel": F.col("o_orderpriority"),
        "campaign_type": F.col("o_orderstatus"),
        "device": F.when(key % 10 < MOBILE_SHARE, F.lit("Mobile")).otherwise(F.lit("Desktop")),
        "user_type": F.col("c_mktsegment"),
        "region": F.col("r_name"),
        "visited_website": F.lit("Yes"),
        "viewed_product": _yes_if(h < views),
        "added_to_cart": _yes_if(h < carts),
        "checkout_started": _yes_if(h < checkouts),
        "purchase_completed": _yes_if(purchased),
        "discount_applied": _yes_if(discounted),
        "order_value": order_value,
        "revenue": F.when(purchased, order_value * factor).otherwise(F.lit(0).cast(DecimalType(21, 3))),
    }


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw 17-column session table (typed: ids bigint, date, money decimal)."""
    cols = _session_columns()
    return _order_facts(spark, sf_dir).select(*[c.alias(n) for n, c in cols.items()])


def dirty_from_sessions(sessions_df: DataFrame) -> DataFrame:
    """All-text session table with bad dates, bad money and mixed-case flags,
    derived row by row from the typed session table (``session_id`` is the
    order key). This is what a CSV source looks like before
    ``ingest.clean_sessions``."""
    key = F.col("session_id")
    cols = {c: F.col(c).cast("string") for c in sessions_df.columns}
    cols["date"] = F.when(key % DIRTY_DATE_EVERY == 0, F.lit("not-a-date")).otherwise(cols["date"])
    cols["revenue"] = F.when(key % DIRTY_REVENUE_EVERY == 0, F.lit("n/a")).otherwise(cols["revenue"])
    cols["purchase_completed"] = (
        F.when(F.col("purchase_completed") != F.lit("Yes"), F.lit("No"))
        .when(key % DIRTY_UPPER_EVERY == 0, F.lit("YES"))
        .when(key % DIRTY_NULL_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("Yes"))
    )
    return sessions_df.select(*[c.alias(n) for n, c in cols.items()])


def quoted_from_sessions(sessions_df: DataFrame) -> DataFrame:
    """The dirty text table with separators and quotes inside channels, as a CSV export quotes them."""
    return dirty_from_sessions(sessions_df).withColumn("channel", F.concat("channel", F.lit(', "'), "device", F.lit('"')))


def gaps_from_sessions(sessions_df: DataFrame) -> DataFrame:
    """The session table with missing ids and dimensions, row by row."""
    key = F.col("session_id")
    return sessions_df.select(
        *[F.when(key % GAP_EVERY[c] != 0, F.col(c)).alias(c) if c in GAP_EVERY else F.col(c) for c in sessions_df.columns]
    )


def dirty_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty all-text variant of ``sessions``."""
    return dirty_from_sessions(sessions(spark, sf_dir))
