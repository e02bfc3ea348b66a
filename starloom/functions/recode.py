"""Dictionary recoding, boolean labels and default filling."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source gender codes and their warehouse labels.
GENDER_CODES = {"M": "Male", "F": "Female", "U": "Undefined"}

# Product status labels.
ACTIVE, INACTIVE = "active", "inactive"

# Defaults for product levels left empty by category routing.
DEFAULT_CATEGORIES = {
    "product_type": "No product_type",
    "category": "No category",
    "subcategory": "No subcategory",
}

POLICIES = ("error", "default", "null")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(value, mapping: dict, on_missing: str = "error", default=None,
           name: str = "code") -> Column:
    """Map codes through a small literal dictionary.

    ``on_missing``: ``error`` fails the job on an unknown or NULL code (a
    map lookup alone yields NULL, even under ANSI), ``default`` substitutes
    ``default``, ``null`` keeps NULL. For table-sized maps use a join.
    """
    if on_missing not in POLICIES:
        raise ValueError(f"on_missing must be one of {POLICIES}")
    value = _col(value)
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])[value]
    if on_missing == "null":
        return lookup
    if on_missing == "default":
        return F.coalesce(lookup, F.lit(default))
    message = F.concat(F.lit(f"unknown {name}: "), F.coalesce(value.cast("string"), F.lit("NULL")))
    return F.coalesce(lookup, F.raise_error(message).cast("string"))


def bool_label(value, true_label: str = ACTIVE, false_label: str = INACTIVE) -> Column:
    """'active' only for TRUE; FALSE and NULL give the false label."""
    return F.when(_col(value), true_label).otherwise(false_label)


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Replace NULLs per column with the given defaults."""
    return df.fillna(defaults or DEFAULT_CATEGORIES)
