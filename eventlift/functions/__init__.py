from eventlift.functions.columns import count_if, iso_utc, percent, ratio, round_n, sum_if
from eventlift.functions.quantiles import exact_percentile

__all__ = ["count_if", "exact_percentile", "iso_utc", "percent", "ratio", "round_n", "sum_if"]
