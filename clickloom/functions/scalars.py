"""Column expressions; all run inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom import constants as C

# The raw time text and the form of a session id.
RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_TIME_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?"
    r" ?(Z|UTC|[+-]\d{2}(:?\d{2})?)?$"
)
SESSION_ID_PATTERN = r"\A[A-Za-z0-9][A-Za-z0-9_.-]*\z"


def parse_utc_text(text: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS UTC`` to a zone-less timestamp, NULL if malformed."""
    bare = F.replace(text, F.lit(" UTC"), F.lit(""))
    return F.try_to_timestamp(bare, F.lit(RAW_TIME_FORMAT)).cast("timestamp_ntz")


def format_utc_text(time: Column) -> Column:
    return F.concat(F.date_format(time, RAW_TIME_FORMAT), F.lit(" UTC"))


def epoch_micros(time: Column) -> Column:
    """Microseconds since 1970 of a zone-less UTC time (session zone is UTC)."""
    return F.unix_micros(time.cast("timestamp"))


def iso_text(time: Column) -> Column:
    """ISO text; the fraction is shown only when it is not zero."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(epoch_micros(time) % C.MICROS == 0, whole).otherwise(fraction)


def parse_iso(text: Column) -> Column:
    """ISO text with ``Z``, an offset or no zone (read as UTC) to UTC time.

    Text without a whole date and a time of day is no time.
    """
    whole = F.when(text.rlike(ISO_TIME_PATTERN), text)
    return whole.try_cast("timestamp").cast("timestamp_ntz")


def iso_text_utc(text: Column) -> Column:
    """Any ISO text re-written with an explicit ``+00:00``."""
    return F.concat(iso_text(parse_iso(text)), F.lit("+00:00"))


def blank_to_null(value: Column) -> Column:
    return F.when(value == "", None).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def event_id(session, time_text, event_type, product, user) -> Column:
    """SHA-256 hex over the five identity fields joined by ``|``."""
    return F.sha2(F.concat_ws("|", session, time_text, event_type, product, user), 256)


def cart_view_ratio(views: Column, carts: Column) -> Column:
    return F.when(views == 0, F.lit(0.0)).otherwise(
        carts.cast("double") / F.when(views != 0, views)
    )


def category_value(code: Column, category: Column) -> Column:
    return F.coalesce(code, category)


def is_session_id(value: Column) -> Column:
    return value.rlike(SESSION_ID_PATTERN)


def is_type(name: str) -> Column:
    return (F.col("event_type") == name).cast("long")


def in_time_range(time: Column, start, end) -> Column:
    """Half-open ``[start, end)``."""
    start = F.lit(start) if isinstance(start, str) else start
    end = F.lit(end) if isinstance(end, str) else end
    return (time >= start) & (time < end)


def slice_label(time: Column, slices) -> Column:
    """Name of the half-open slice a time falls in, NULL outside all of them."""
    label = F.lit(None).cast("string")
    for name, start, end in reversed(list(slices)):
        inside = in_time_range(
            time, F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
        )
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label
