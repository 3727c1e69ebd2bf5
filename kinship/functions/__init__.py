"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from kinship.functions.columns import (
    PRED_DIGITS,
    SIM_DIGITS,
    RatingScale,
    deviation,
    rescale,
    safe_ratio,
    scale,
    tidy,
)

__all__ = [
    "PRED_DIGITS",
    "SIM_DIGITS",
    "RatingScale",
    "deviation",
    "rescale",
    "safe_ratio",
    "scale",
    "tidy",
]
