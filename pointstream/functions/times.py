"""Column functions over time; none of them depends on the session time zone.

Local times are TIMESTAMP_NTZ. Their text is cut from ``cast(ts as string)``,
because ``date_format`` and ``date_trunc`` take a TIMESTAMP_NTZ through the
session zone.
"""

import datetime as dt

from pyspark.sql import Column, functions as F

from pointstream.functions.binary import ColumnOrName, _col
from pointstream.schemas import DEVICE_ZONE

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _as_date(day: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def _midnight(day: dt.date) -> Column:
    return F.expr(f"timestamp_ntz'{day.isoformat()} 00:00:00'")


def _local_seconds(instant: Column, zone: str) -> Column:
    # from_utc_timestamp only shifts the microsecond count; read as a count
    # again it is the wall clock of the zone, whatever the session zone is.
    seconds = F.unix_seconds(F.from_utc_timestamp(instant, zone))
    return F.expr(_EPOCH) + seconds * F.expr("interval '1' second")


def local_time(epoch_seconds: ColumnOrName, zone: str = DEVICE_ZONE) -> Column:
    """Epoch seconds as the wall-clock time of a zone."""
    return _local_seconds(F.timestamp_seconds(_col(epoch_seconds)), zone)


def local_arrival(instant: ColumnOrName, zone: str = DEVICE_ZONE) -> Column:
    """Instant (TIMESTAMP) as the wall-clock time of a zone, cut to seconds."""
    return _local_seconds(_col(instant), zone)


def second_text(local: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.substring(_col(local).cast("string"), 1, 19)


def milli_text(local: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, further digits cut off."""
    text = _col(local).cast("string")
    return F.concat(
        F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0")
    )


def day_text(local: ColumnOrName) -> Column:
    """``yyyy-MM-dd``."""
    return F.substring(_col(local).cast("string"), 1, 10)


def outside_day(local: ColumnOrName, day: str | dt.date) -> Column:
    """True when a time is not on the day; NULL for a NULL time.

    A range over the bare column reaches the Parquet scan; a comparison of
    formatted text would not.
    """
    start = _as_date(day)
    local = _col(local)
    return (local < _midnight(start)) | (local >= _midnight(start + dt.timedelta(days=1)))


def processing_time() -> Column:
    """Processing-time attribute: one instant per batch or micro-batch."""
    return F.current_timestamp()


def pull_window(run_date: str | dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Yesterday 00:00 and today 00:00, seen from the run date."""
    end = dt.datetime.combine(_as_date(run_date), dt.time())
    return end - dt.timedelta(days=1), end


def window_text(run_date: str | dt.date) -> dict[str, str]:
    """The pull window as the pair of texts that names one ledger request."""
    start, end = pull_window(run_date)
    return {"startTime": f"{start}", "endTime": f"{end}"}


def in_pull_window(local: ColumnOrName, run_date: str | dt.date) -> Column:
    """Half-open test ``start <= t < end`` for the pull window of a run date."""
    start, end = pull_window(run_date)
    local = _col(local)
    return (local >= _midnight(start.date())) & (local < _midnight(end.date()))


def pull_day(run_date: str | dt.date) -> str:
    """Day label of a pull: the day before the run date."""
    return pull_window(run_date)[0].date().isoformat()


def pull_day_of(run_date: ColumnOrName) -> Column:
    """Day label of a pull, for a DATE column of run dates."""
    return F.date_sub(_col(run_date), 1).cast("string")
