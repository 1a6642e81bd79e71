"""Money is decimal(12,2) throughout; sums and averages stay exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def exact_average(amount: Column) -> Column:
    """Average of the non-null amounts, rounded half-up once, to cents.

    ``avg`` of a decimal keeps only four extra digits and so rounds twice.
    """
    count = F.count(amount)
    return F.round(F.sum(amount).cast("decimal(38,18)") / F.nullif(count, F.lit(0)), 2)
