"""KPI operators over the base table (funnel, monthly, segments, campaigns,
customers, retention, executive) and report views."""

from .campaigns import campaign_basic, campaign_performance, share_of_total
from .cells import cells, distinct_users
from .customers import (
    analysis_window,
    customer_orders,
    customer_retention_churn,
    order_sequence,
    purchases,
)
from .executive import executive_kpis
from .funnel import funnel_summary, stage_counts, top_dropoff
from .grouping import join_null_safe, sets_and_distinct, sums_and_distinct
from .monthly import monthly_kpis, monthly_kpis_basic
from .retention import retention_asof, retention_summary
from .segments import segment_rollup, segment_wallet_share
from .views import (
    campaign_scatter,
    churn_bands,
    dimension_wallet,
    kpi_strip,
    monthly_long,
    require_rows,
    select_months,
    top_campaign,
    top_campaigns,
    wallet_view,
)

__all__ = [
    "analysis_window",
    "campaign_basic",
    "campaign_performance",
    "campaign_scatter",
    "churn_bands",
    "customer_orders",
    "cells",
    "customer_retention_churn",
    "dimension_wallet",
    "distinct_users",
    "executive_kpis",
    "funnel_summary",
    "join_null_safe",
    "kpi_strip",
    "monthly_kpis",
    "monthly_kpis_basic",
    "monthly_long",
    "order_sequence",
    "purchases",
    "require_rows",
    "retention_asof",
    "retention_summary",
    "segment_rollup",
    "segment_wallet_share",
    "select_months",
    "sets_and_distinct",
    "share_of_total",
    "stage_counts",
    "sums_and_distinct",
    "top_campaign",
    "top_campaigns",
    "top_dropoff",
    "wallet_view",
]
