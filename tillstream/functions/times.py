"""Order times as text and as predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(moment: Column) -> Column:
    """ISO 8601 text without a zone: six fraction digits, or none when they are 0."""
    moment = moment.cast("timestamp")
    return F.when(
        F.unix_micros(moment) % 1_000_000 == 0,
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
    ).otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def order_time_text(parsed: Column, raw: Column) -> Column:
    """The order time as ISO text, or the text as received when it is not a time."""
    return F.coalesce(iso_text(parsed), raw)


def within_trailing(moment: Column, as_of: Column, seconds: int = 60) -> Column:
    """True for moments in the ``seconds`` up to ``as_of``, both ends included."""
    return moment.between(as_of - F.make_dt_interval(secs=F.lit(seconds)), as_of)
