"""Column helpers built from JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the JVM counts as whitespace. The no-break
# spaces U+00A0, U+2007 and U+202F are deliberately not among them.
WHITESPACE = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only spaces."""
    return F.btrim(value, F.lit(WHITESPACE))


def is_blank(value: Column) -> Column:
    return F.length(strip(value)) == 0


def money(value: Column) -> Column:
    return value.cast("decimal(19,2)")


def amount(value: Column) -> Column:
    return value.cast("decimal(12,2)")


def month_key(ts: Column) -> Column:
    """yyyymm as an int: the partition column of the fact tables."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def to_millis(ts: Column) -> Column:
    """Table edges keep milliseconds."""
    return F.date_trunc("millisecond", ts)


def event_millis(ts: Column) -> Column:
    """Event time as epoch milliseconds."""
    return F.unix_millis(ts)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value)


def row_digest(*columns: Column) -> Column:
    """60 bits of an MD5 of the printed columns, as a bigint.

    Nulls are printed as ``\\N`` and separators inside values are escaped, so different rows print differently.

    Summing digests gives a content check that needs no row order and can be
    computed by any other engine from the same text.
    """
    marked = [F.coalesce(F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\\N")) for c in columns]
    text = F.concat_ws("|", *marked)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(a))
