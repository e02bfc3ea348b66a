"""Money arithmetic in decimals only (no float round trip)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.schemas import MONEY_PRECISION, MONEY_SCALE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hundredths_to_money(total_hundredths, precision: int = MONEY_PRECISION,
                        scale: int = MONEY_SCALE) -> Column:
    """Integer hundredths -> decimal(p, s), rounded half-up at ``scale``.

    Integer hundredths are exact in decimal, so rounding before or after a
    later re-summation gives the same total. Under ANSI mode a value that
    does not fit decimal(p, s) fails the job, like numeric(10,2) would.
    """
    exact = _col(total_hundredths).cast("decimal(38,0)") / F.lit(100)
    return F.round(exact, scale).cast(f"decimal({precision},{scale})")


def money_sum(price_hundredths) -> Column:
    """ROUND(SUM(price) / 100, 2) as decimal(10, 2)."""
    return hundredths_to_money(F.sum(_col(price_hundredths)))


def money(value, precision: int = MONEY_PRECISION, scale: int = MONEY_SCALE) -> Column:
    return _col(value).cast(f"decimal({precision},{scale})")
