"""Column expressions shared by the operators."""

from clickmart.functions.columns import (  # noqa: F401
    epoch_micros, event_label, hour_start, is_confirmation, is_product,
    isin_nullsafe, normalise_uuid, product_name,
)
