"""Reusable ``Column`` expressions: predicates and scalar derivations."""

from erpweave.functions.expressions import (
    BUCKET_1_7,
    BUCKET_8_14,
    BUCKET_ON_TIME,
    BUCKET_OVER_14,
    BUCKET_UNKNOWN,
    MADE_TO_ORDER,
    MADE_TO_STOCK,
    as_of_date,
    deviation_days,
    key_skipping_nulls,
    key_with_blanks,
    late_bucket,
    month_start,
    mto_vs_mts,
    on_time_flag,
    hmac_sha256_hex,
    sha256_hex,
    to_date_safe,
)
from erpweave.functions.predicates import (
    RETIRED_OLD_MATERIAL_NUMBERS,
    any_null,
    no_split_valuation,
    not_deleted,
    not_deleted_or_blank,
    old_material_number_valid,
)

__all__ = [
    "BUCKET_1_7",
    "BUCKET_8_14",
    "BUCKET_ON_TIME",
    "BUCKET_OVER_14",
    "BUCKET_UNKNOWN",
    "MADE_TO_ORDER",
    "MADE_TO_STOCK",
    "RETIRED_OLD_MATERIAL_NUMBERS",
    "any_null",
    "as_of_date",
    "deviation_days",
    "key_skipping_nulls",
    "key_with_blanks",
    "late_bucket",
    "month_start",
    "mto_vs_mts",
    "no_split_valuation",
    "not_deleted",
    "not_deleted_or_blank",
    "old_material_number_valid",
    "on_time_flag",
    "hmac_sha256_hex",
    "sha256_hex",
    "to_date_safe",
]
