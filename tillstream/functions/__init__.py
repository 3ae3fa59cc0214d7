from tillstream.functions.money import exact_total, money_sum, two_places, zero_if_missing
from tillstream.functions.times import iso_text, order_time_text, within_trailing

__all__ = [
    "exact_total",
    "iso_text",
    "money_sum",
    "order_time_text",
    "two_places",
    "within_trailing",
    "zero_if_missing",
]
