"""Column helpers shared by the operators."""

from yieldloom.functions.columns import (
    decode_label,
    edge_index,
    half_even,
    ratio_or_zero,
    unit_hash,
    without_nan,
)

__all__ = ["decode_label", "edge_index", "half_even", "ratio_or_zero", "unit_hash", "without_nan"]
