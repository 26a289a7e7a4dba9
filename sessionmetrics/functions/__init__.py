"""Scalar column functions."""

from .scalar import (
    epoch_seconds,
    flag,
    is_time_only,
    lenient_number,
    norm,
    norm_lower,
    parse_timestamp,
    product_label,
    safe_ratio,
)

__all__ = [
    "epoch_seconds",
    "flag",
    "is_time_only",
    "lenient_number",
    "norm",
    "norm_lower",
    "parse_timestamp",
    "product_label",
    "safe_ratio",
]
