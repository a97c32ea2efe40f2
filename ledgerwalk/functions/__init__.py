from ledgerwalk.functions.numeric import round_half, money, ratio, exact_avg, to_double
from ledgerwalk.functions.dates import month_start, month_diff, day_diff
from ledgerwalk.functions.banding import band_columns, band_labels, DEFAULT_BAND_EDGES

__all__ = [
    "round_half", "money", "ratio", "exact_avg", "to_double",
    "month_start", "month_diff", "day_diff",
    "band_columns", "band_labels", "DEFAULT_BAND_EDGES",
]
