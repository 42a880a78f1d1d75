"""Date formats: detection and parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Name keywords, prefix patterns and their formats, tried in this order.
DATE_KEYWORDS = ["date", "time", "datetime", "timestamp", "created", "updated"]
DATE_FORMATS = [
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "yyyy-MM-dd HH:mm:ss"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}", "yyyy-MM-dd HH:mm"),
    (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"),
    (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}", "MM/dd/yyyy HH:mm:ss"),
    (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}", "MM/dd/yyyy HH:mm"),
    (r"\d{2}/\d{2}/\d{4}", "MM/dd/yyyy"),
    (r"\d{2}-\d{2}-\d{4}", "dd-MM-yyyy"),
    (r"\d{2}\.\d{2}\.\d{4}", "dd.MM.yyyy"),
    (r"\d{4}/\d{2}/\d{2}", "yyyy/MM/dd"),
]


def is_date_name(name: str) -> bool:
    lowered = name.lower()
    return any(word in lowered for word in DATE_KEYWORDS)


def inferred_format(c: Column) -> Column:
    """The first format whose pattern matches the start of the value; null when none does."""
    out = F.lit(None).cast("string")
    for pattern, fmt in reversed(DATE_FORMATS):
        out = F.when(c.rlike("^" + pattern), F.lit(fmt)).otherwise(out)
    return out


def parse(c: Column, fmt: str | None, exact: bool = False) -> Column:
    """Text to a zoneless timestamp, null where it does not parse.

    ``exact`` takes the format as it stands; otherwise one that ends in seconds also
    accepts a fraction. Without a format the default parser applies, except to bare
    numbers, which it would read as years.
    """
    if fmt is None:
        return F.when(c.rlike(r"^\s*\d{4}\D"), c).try_cast("timestamp_ntz")
    if not exact and fmt.endswith("ss"):
        fmt += "[.SSSSSSSSS]"
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def parse_any(c: Column) -> Column:
    """Parse each value by whichever known format fits it, else by the default parser.

    The default parser reads ISO text with a ``T`` between day and time, which also starts like a date.
    """
    out = parse(c, None)
    for pattern, fmt in reversed(DATE_FORMATS):
        out = F.when(c.rlike("^" + pattern), F.coalesce(parse(c, fmt), parse(c, None))).otherwise(out)
    return out
