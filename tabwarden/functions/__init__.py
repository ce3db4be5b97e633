from tabwarden.functions.columns import (
    NUMERIC_TYPES,
    class1_probability,
    nan_to_null,
    order_key,
    recode_label,
    safe_ratio,
)

__all__ = ["NUMERIC_TYPES", "class1_probability", "nan_to_null", "order_key", "recode_label", "safe_ratio"]
