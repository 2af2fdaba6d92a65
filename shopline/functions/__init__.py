"""Column-level helpers built only from ``pyspark.sql.functions``."""

from shopline.functions.stats import Partial, exact_avg, exact_mean, exact_sum, partial_mean, partial_sum, safe_corr, safe_ratio
from shopline.functions.calendar import year_month, in_period
from shopline.functions.sizing import bounded_broadcast

__all__ = [
    "Partial", "exact_avg", "exact_mean", "exact_sum", "partial_mean", "partial_sum", "safe_corr", "safe_ratio",
    "year_month", "in_period", "bounded_broadcast",
]
