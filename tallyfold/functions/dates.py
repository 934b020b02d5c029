"""Free-text publication dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_ISO_DAY = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
_CZECH = r"^(\d{1,2})\.\s+(\d{1,2})\.\s+(\d{4})\s+(\d{1,2}):(\d{1,2})$"
_ENGLISH = r"(?i)^([a-z]{3})\s+(\d{1,2}),\s+(\d{4})\s+v\s+(\d{1,2}):(\d{1,2})\s+[a-z]{3,4}$"


def _as_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def _english_date(text: Column) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(text, _ENGLISH, i)

    at = F.instr(F.lit(_MONTHS), F.lower(part(1)))
    # A hit that is not on a multiple of three spans two month names.
    month = F.when(at % 3 == 1, ((at + 2) / 3).cast("int"))
    return _as_timestamp(
        F.concat(part(3), F.lit("-"), month.cast("string"), F.lit("-"), part(2),
                 F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":00"))
    )


def parse_date(text: Column, named_months: bool = True) -> Column:
    """``text`` as TIMESTAMP_NTZ; null when no known format fits.

    Known are ``2022-1-5``, ``5. 3. 2021 9:07`` and, with ``named_months``,
    ``Nov 5, 2021 v 19:07 CET`` (the zone is dropped, the wall time kept). The
    pieces are rearranged and cast, so the result does not depend on the session
    zone and a text that fits no format costs a failed match, not an exception.
    """
    parsed = F.when(text.rlike(_ISO_DAY), _as_timestamp(text)).when(
        text.rlike(_CZECH),
        _as_timestamp(F.regexp_replace(text, _CZECH, "$3-$2-$1 $4:$5:00")),
    )
    if named_months:
        parsed = parsed.when(text.rlike(_ENGLISH), _english_date(text))
    return parsed


def date_parts(day: Column) -> list[Column]:
    """Year, month and weekday (Monday is 0) of a parsed date."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.weekday(day).alias("weekday"),
    ]
