from fieldfit.functions.measures import (
    days_left,
    eligible,
    gap,
    grade,
    in_time,
    install_status,
    pct,
    pending,
    scale,
    segment,
    target_qty,
)
from fieldfit.functions.scalars import (
    as_date,
    bucket,
    days_open,
    days_since,
    display_name,
    first_known,
    is_stale,
    risk_status,
    sorted_label_set,
    split_list,
    split_suffix,
)

__all__ = [
    "as_date",
    "bucket",
    "days_left",
    "days_open",
    "days_since",
    "display_name",
    "eligible",
    "first_known",
    "gap",
    "grade",
    "in_time",
    "install_status",
    "is_stale",
    "pct",
    "pending",
    "risk_status",
    "scale",
    "segment",
    "sorted_label_set",
    "split_list",
    "split_suffix",
    "target_qty",
]
