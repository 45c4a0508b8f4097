"""Date and file-name stamp expressions (time-zone independent)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The registered landing-file pattern and its stamp layout.
POST_FILE_PATTERN = r"post_detail_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.json"
STAMP_FORMAT = "yyyy-MM-dd_HH-mm-ss"
YEAR_PATTERN = r"(\d{4})"
MONTH_PATTERN = r"-(\d{2})-"
DAY_PATTERN = r"-(\d{2})_"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_date(ts_text) -> Column:
    """Calendar date in UTC of an ISO-8601 text such as
    ``2024-01-01T23:10:00.000000+0000``; NULL when unparsable.

    Goes through epoch microseconds, so the result does not depend on the
    session time zone.
    """
    ts = _c(ts_text).try_cast("timestamp")
    micros = F.unix_micros(ts)
    return F.date_from_unix_date(F.floor(micros / F.lit(86_400_000_000)).cast("int"))


def iso_text(ts_ntz) -> Column:
    """ISO-8601 text with microseconds and an explicit ``+0000`` offset."""
    return F.concat(F.date_format(_c(ts_ntz), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+0000"))


def file_name(path) -> Column:
    """Text after the last ``/`` of a path."""
    return F.regexp_extract(_c(path), r".*/(.*)", 1)


def stamp(path, pattern: str = POST_FILE_PATTERN) -> Column:
    """Group 1 of the registered pattern found anywhere in the path; '' if none."""
    return F.regexp_extract(_c(path), pattern, 1)


def stamp_parts(stamp_col) -> dict[str, Column]:
    s = _c(stamp_col)
    return {
        "year": F.regexp_extract(s, YEAR_PATTERN, 1),
        "month": F.regexp_extract(s, MONTH_PATTERN, 1),
        "day": F.regexp_extract(s, DAY_PATTERN, 1),
    }


def batch_ts(stamp_col, fmt: str = STAMP_FORMAT) -> Column:
    """Batch timestamp from the stamp; NULL for '' or an impossible date."""
    s = _c(stamp_col)
    return F.when(s != "", F.try_to_timestamp(s, F.lit(fmt)))


def name_matches(name, pattern: str = POST_FILE_PATTERN) -> Column:
    """Whole-name match of the registered pattern (trailing text rejected)."""
    return _c(name).rlike(f"^(?:{pattern})$")


def default_business_date() -> Column:
    """Yesterday in the session's calendar (the default batch date, F5)."""
    return F.date_sub(F.current_date(), 1)
