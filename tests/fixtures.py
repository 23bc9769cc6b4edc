"""Hand-made inputs: the 13-row micro fixture and dirty cleaning rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

from funnel_engine.schema import RAW_COLUMNS

# user_id, session_id, date, purchased
MICRO = [
    (1, 1, "2025-12-01", True),
    (1, 2, "2025-12-08", True),
    (2, 3, "2025-11-01", True),
    (2, 4, "2025-11-09", True),
    (3, 5, "2025-10-01", True),
    (3, 6, "2025-10-31", True),
    (3, 7, "2025-12-13", True),
    (4, 8, "2025-09-01", True),
    (4, 9, "2025-10-02", True),
    (5, 10, "2025-11-27", True),
    (6, 11, "2025-12-27", False),
    (7, 12, "2025-11-26", True),
    (7, 13, "2025-11-26", True),
]


def micro_raw(spark: SparkSession):
    """All-text raw session rows (as read from CSV)."""
    rows = []
    for user, session, date, bought in MICRO:
        yes = "Yes" if bought else "No"
        rows.append(
            {
                "user_id": str(user),
                "session_id": str(session),
                "date": date,
                "month": date[:7],
                "channel": "Paid Ads" if user % 2 else "Organic",
                "campaign_type": "Discount",
                "device": "Mobile",
                "user_type": "New",
                "region": "Metro",
                "visited_website": "Yes",
                "viewed_product": "Yes",
                "added_to_cart": yes,
                "checkout_started": yes,
                "purchase_completed": yes,
                "discount_applied": "No",
                "order_value": "100" if bought else "0",
                "revenue": "100" if bought else "0",
            }
        )
    return spark.createDataFrame([[r[c] for c in RAW_COLUMNS] for r in rows], RAW_COLUMNS)


def dirty_raw(spark: SparkSession):
    cols = [" User_ID ", "session_id", "Date", "month", "channel", "campaign_type", "device", "user_type", "region",
            "visited_website", "viewed_product", "added_to_cart", "checkout_started", "purchase_completed",
            "discount_applied", "order_value", "revenue"]
    base = ["1", "1", "2025-07-01", "1999-01", "Paid Ads", "Discount", "Mobile", "New", "Metro",
            "Yes", "yes", "YES", " Yes ", None, "No", "10.5", "n/a"]
    rows = [
        base,
        ["2", "2", "not-a-date", "2025-07", "Organic", "Discount", "Mobile", "New", "Metro",
         "Yes", "Yes", "Yes", "Yes", "Yes", "No", "1", "1"],
        ["3", "3", "", "2025-07", "Organic", "Discount", "Mobile", "New", "Metro",
         "Yes", "Yes", "Yes", "Yes", "Yes", "No", "1", "1"],
        ["4", "4", "2025-08-15", "2025-08", "NA", "Discount", "Mobile", "New", "Metro",
         "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", "", "20.25"],
    ]
    return spark.createDataFrame(rows, cols)
