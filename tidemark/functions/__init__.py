"""Business rules as built-in column expressions."""

from tidemark.functions.rules import (bounced, campaign, conversion_score, currency, day, day_of_week, fee,
                                      iso_to_ts, month_start, net_revenue, or_default, ts_to_iso)

__all__ = ["bounced", "campaign", "conversion_score", "currency", "day", "day_of_week", "fee", "iso_to_ts",
           "month_start", "net_revenue", "or_default", "ts_to_iso"]
