"""Rounding by the exact binary value."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = 134217729.0  # 2**27 + 1 cuts a double into two halves


def round_half_even(x: Column, places: int) -> Column:
    """Nearest decimal of the exact binary value, ties to even.

    bround() rounds the shortest decimal text of a double, which differs where
    that text looks like a tie (2.675 is below the tie it shows).  Here the
    product x * 10**places is kept with its rounding error, and the error breaks
    apparent ties.  Pass a plain column: it is used several times.
    """
    m = F.lit(float(10 ** places))
    p = x * m
    high = F.lit(SPLIT) * x - (F.lit(SPLIT) * x - x)
    err = high * m - p + (x - high) * m
    r = F.rint(p)
    step = (F.when((p - r == 0.5) & (err > 0), F.lit(1.0)).when((p - r == -0.5) & (err < 0), F.lit(-1.0))
            .otherwise(F.lit(0.0)))
    return (r + step) / m
