"""Timestamps, date parts and calendar columns."""

from __future__ import annotations

# The range of a nanosecond timestamp; what lies outside counts as a bad date.
FIRST_TIMESTAMP = "1677-09-21 00:12:43.145225"
LAST_TIMESTAMP = "2262-04-11 23:47:16.854775"


def parse_timestamp(column: str, fmt: str | None = None) -> str:
    """Text to a timestamp without zone; unparsable or out-of-range text becomes null.

    Without ``fmt`` each value is read as ISO on its own. ``fmt`` needs the UTC session zone.
    """
    if fmt is None:
        ts = f"try_cast(`{column}` as timestamp_ntz)"
    else:
        quoted = fmt.replace("\\", "\\\\").replace("'", "\\'")
        ts = f"cast(try_to_timestamp(`{column}`, '{quoted}') as timestamp_ntz)"
    first, last = f"timestamp_ntz'{FIRST_TIMESTAMP}'", f"timestamp_ntz'{LAST_TIMESTAMP}'"
    return f"if({ts} between {first} and {last}, {ts}, null)"


def date_parts(ts: str) -> dict[str, str]:
    return {
        "order_date": f"to_date(`{ts}`)",
        "order_year": f"year(`{ts}`)",
        "order_month": f"month(`{ts}`)",
        "order_quarter": f"quarter(`{ts}`)",
        "order_dow": f"date_format(`{ts}`, 'EEEE')",
    }


def calendar_columns(day: str) -> dict[str, str]:
    """Calendar year beside the ISO week; Monday is day 0."""
    return {
        "date_id": f"cast(date_format(`{day}`, 'yyyyMMdd') as int)",
        "year": f"year(`{day}`)",
        "quarter": f"quarter(`{day}`)",
        "month": f"month(`{day}`)",
        "month_name": f"date_format(`{day}`, 'MMMM')",
        "day": f"dayofmonth(`{day}`)",
        "day_of_week": f"weekday(`{day}`)",
        "week_of_year": f"weekofyear(`{day}`)",
        "is_weekend": f"weekday(`{day}`) in (5, 6)",
    }
