"""Column names, stage labels and schemas shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for identical results) -------
# Funnel stages in funnel order, each with the raw yes/no column, the derived
# base-table flag and the label printed in the funnel summary.
STAGES = [
    ("visited_website", "visited_flag", "Install / Visit"),
    ("viewed_product", "viewed_flag", "Signup / Product View"),
    ("added_to_cart", "cart_flag", "Cart Add"),
    ("checkout_started", "checkout_flag", "Checkout"),
    ("purchase_completed", "order_flag", "First Order / Purchase"),
]
DISCOUNT = ("discount_applied", "discount_flag")
# Dimensions of the segment rollup, in the reference's configured order.
DIMENSIONS = ["channel", "campaign_type", "device", "region", "user_type"]
# Churn bands: days since last order <= 14 Low, <= 30 Medium, else High.
CHURN_LABELS = ("Low", "Medium", "High")
CHURN_DAYS = (14, 30)
RETENTION_HORIZONS = (7, 14, 30)
# Analysis end date hard-coded in the reference's standalone KPI script.
SCRIPT_AS_OF = "2025-12-27"
# Environment variable that overrides the source path.
SOURCE_PATH_ENV = "D2C_FUNNEL_DATA_PATH"
# Tokens the reference's CSV reader (pandas defaults) treats as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# ---------------------------------------------------------------------------

FLAG_SOURCES = [raw for raw, _, _ in STAGES] + [DISCOUNT[0]]
BASE_FLAGS = [flag for _, flag, _ in STAGES] + [DISCOUNT[1]]

RAW_COLUMNS = [
    "user_id", "session_id", "date", "month",
    "channel", "campaign_type", "device", "user_type", "region",
    *FLAG_SOURCES,
    "order_value", "revenue",
]

# Every source field is read as text; cleaning coerces ("coerce, do not fail").
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# The typed table of the reference's DDL.
TYPED_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("session_id", T.LongType(), True),
        T.StructField("date", T.DateType(), True),
        T.StructField("month", T.StringType(), True),
        *[T.StructField(c, T.StringType(), True) for c in ["channel", "campaign_type", "device", "user_type", "region"]],
        *[T.StructField(c, T.StringType(), True) for c in FLAG_SOURCES],
        T.StructField("order_value", T.DoubleType(), True),
        T.StructField("revenue", T.DoubleType(), True),
    ]
)

# Schemas of the pipeline's outputs, for reading their CSV copies back typed.
# Ids are written as text where the source's are; read them with ``schemas=``.
_SHARED = "sessions BIGINT, users BIGINT"
OUTPUT_SCHEMAS = {
    "funnel_summary": "stage_order INT, stage STRING, sessions BIGINT, conversion_from_previous DOUBLE, "
    "conversion_from_visit DOUBLE, dropoff_from_previous DOUBLE",
    "monthly_growth_kpis": f"month STRING, {_SHARED}, product_views BIGINT, cart_adds BIGINT, checkouts BIGINT, orders BIGINT, "
    "revenue DOUBLE, discounted_sessions BIGINT, visit_to_order_rate DOUBLE, aov DOUBLE, discount_usage_rate DOUBLE",
    "segment_wallet_share": f"dimension STRING, segment STRING, {_SHARED}, views BIGINT, carts BIGINT, checkouts BIGINT, orders BIGINT, "
    "revenue DOUBLE, discounted_sessions BIGINT, conversion_rate DOUBLE, view_to_cart_rate DOUBLE, checkout_to_order_rate DOUBLE, "
    "aov DOUBLE, wallet_share DOUBLE",
    "campaign_performance": f"channel STRING, campaign_type STRING, {_SHARED}, carts BIGINT, checkouts BIGINT, orders BIGINT, "
    "revenue DOUBLE, discounted_sessions BIGINT, conversion_rate DOUBLE, revenue_per_session DOUBLE, discount_usage_rate DOUBLE, "
    "wallet_share DOUBLE",
    "customer_retention_churn": "user_id BIGINT, first_order_date DATE, last_order_date DATE, order_count BIGINT, customer_revenue DOUBLE, "
    "second_order_date DATE, days_to_second_order BIGINT, days_since_last_order BIGINT, repeat_buyer_flag INT, "
    + "".join(f"retained_d{h} INT, " for h in RETENTION_HORIZONS)
    + "repeat_purchase_frequency DOUBLE, churn_risk STRING",
    "retention_summary": "purchasers BIGINT, repeat_buyers BIGINT, first_to_second_order_rate DOUBLE, "
    + "".join(f"d{h}_retention DOUBLE, " for h in RETENTION_HORIZONS)
    + "avg_repeat_purchase_frequency DOUBLE, high_churn_risk_customers BIGINT, high_churn_risk_rate DOUBLE",
    "cleaning_report": "rows BIGINT, undated_rows BIGINT, bad_ids BIGINT",
    "rejected_values": "column STRING, value STRING, reason STRING, row STRING",
}
# How the rows of an output lie in its one file: columns, ``-`` for descending (nulls last).
OUTPUT_ORDER = {
    "funnel_summary": ["stage_order"],
    "monthly_growth_kpis": ["month"],
    "segment_wallet_share": ["dimension", "-revenue", "segment"],
    "campaign_performance": ["-revenue", "channel", "campaign_type"],
    "run_summary_txt": ["line_no"],
}
