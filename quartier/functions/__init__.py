"""Column expressions shared by the operators."""

from quartier.functions.scalars import (
    event_date,
    growth_pct,
    half_up,
    list_items,
    rank_value,
    surrogate_key,
    time_id,
)

__all__ = [
    "event_date",
    "growth_pct",
    "half_up",
    "list_items",
    "rank_value",
    "surrogate_key",
    "time_id",
]
