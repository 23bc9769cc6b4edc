"""Plans: the shared base table, the batch pipeline and the run report."""

from .base import funnel_events, materialize, register_kpi_views, register_views

__all__ = ["funnel_events", "materialize", "register_kpi_views", "register_views"]
