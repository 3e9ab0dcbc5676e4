"""Row predicates of the preparation step, as plain ``Column`` expressions.

They stay inside whole-stage codegen and, on parquet sources, the null tests and the
``IN`` list are pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Old material numbers that mark a material as retired (exact,
# case-sensitive match, as in the reference).
RETIRED_OLD_MATERIAL_NUMBERS = ["ARCHIVE", "DUPLICATE", "RENUMBERED"]


def old_material_number_valid(column: str = "BISMT") -> Column:
    """Old material number missing or not one of the retired markers."""
    return F.col(column).isNull() | ~F.col(column).isin(RETIRED_OLD_MATERIAL_NUMBERS)


def not_deleted_or_blank(column: str = "LVORM") -> Column:
    """Deletion flag missing or blank (the rule for the general material table)."""
    return F.col(column).isNull() | (F.trim(F.col(column)) == F.lit(""))


def not_deleted(column: str = "LVORM") -> Column:
    """Deletion flag missing (the rule for valuation and plant tables; blank is deleted)."""
    return F.col(column).isNull()


def no_split_valuation(column: str = "BWTAR") -> Column:
    """Valuation type missing: the material is not split-valuated."""
    return F.col(column).isNull()


def any_null(columns: list[str]) -> Column:
    """True when at least one of the columns is null."""
    test = F.col(columns[0]).isNull()
    for name in columns[1:]:
        test = test | F.col(name).isNull()
    return test
