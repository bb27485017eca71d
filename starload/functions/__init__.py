"""Column-level scalar functions, all built from native Spark expressions (no Python UDFs)."""

from starload.functions.dates import (
    calendar_attributes,
    date_id,
    epoch_to_timestamp,
    holiday_label,
    strip_dashes,
    weekend_label,
)
from starload.functions.ids import padded_id, time_ordered_id
from starload.functions.numeric import round_to_int, to_money

__all__ = [
    "calendar_attributes", "date_id", "epoch_to_timestamp", "holiday_label", "strip_dashes", "weekend_label",
    "padded_id", "time_ordered_id", "round_to_int", "to_money",
]
