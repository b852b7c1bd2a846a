"""Exact sums of two-decimal amounts that are stored as doubles.

A sum over doubles depends on the order in which partitions arrive, so its last
digits change with the file layout. Sums of whole numbers do not. They also stay
in primitive longs, where a wide decimal sum allocates an object per row.

Bounds, each of which raises an error when it is passed:

- an amount must be below ``2**51`` hundredths in size and have no third decimal,
  whatever the ANSI setting;
- products and sums must fit into a bigint, which ANSI mode checks; without it
  nothing is built;
- ``exact_sum`` takes a scale of 1 to 9.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_LOW_BITS = 20
#: Hundredths from which on a double times 100 can miss the whole number.
LIMIT = 2**51


def require_ansi() -> None:
    """Refuses to go on without ANSI mode, in which an overflow gives a wrong number."""
    session = SparkSession.getActiveSession()
    if session is None:
        raise ValueError("there is no active Spark session whose spark.sql.ansi.enabled could be looked at")
    if session.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled to true: without it an overflow would go unnoticed")


def hundredths(amount: Column | str) -> Column:
    """The amount in whole hundredths (bigint); null stays null.

    Raises on NaN, infinity, amounts of ``LIMIT`` hundredths or more and amounts that
    are further from a whole hundredth than the error of a double explains.
    """
    col = F.col(amount) if isinstance(amount, str) else amount
    scaled = col * 100
    whole = F.rint(scaled)
    fits = (F.abs(scaled) < float(LIMIT)) & (F.abs(scaled - whole) <= F.abs(scaled) * 2.0**-51)
    wrong = F.raise_error(F.concat(F.lit("not an amount of whole hundredths below 2**51: "), col.cast("string")))
    return F.when(col.isNotNull() & ~fits, wrong).otherwise(whole).cast("bigint")


def exact_sum(units: Column, scale: int) -> Column:
    """Sum of a bigint column that counts units of ``10**-scale``, as a double.

    The sum is exact until the last step, which rounds it once to a double.
    High and low bits are summed apart, so that neither sum overflows: the low
    one holds for 8.8e12 rows in one group, whatever the values; the high one,
    at that row count, for values that average below 1e12 units.
    """
    if not 1 <= scale <= 9:
        raise ValueError(f"scale must be 1 to 9, not {scale}: beyond that decimals would be cut off")
    require_ansi()
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(19,0)")
    total = high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low
    unit = F.lit(f"1e-{scale}").cast(f"decimal({scale},{scale})")
    return (total * unit).cast("double")
