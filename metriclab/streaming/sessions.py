"""Sessions of users over a stream of events, with repeated and late rows.

One plan serves a stream and a table.  On a stream the state has a row for every event that
may still be repeated and one for every open session; both are dropped when the watermark
has passed them, and a session is given out once, when it is closed for good.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unrepeated(events: DataFrame, key: Sequence[str] = ("event_id",), late: str = "2 days", time: str = "ts") -> DataFrame:
    """One row of each key, with ``_t``, its time as a timestamp; on a stream repeats are known for as long as rows may be late.

    Repeats are equal rows; which of them stays is open.  Rows without a time go, as they
    can't be told to be late.
    """
    rows = events.withColumn("_t", F.col(time).cast("timestamp")).filter("_t IS NOT NULL")
    if rows.isStreaming:
        return rows.withWatermark("_t", late).dropDuplicatesWithinWatermark(list(key))
    return rows.dropDuplicates(list(key))


def sessions(events: DataFrame, gap: str = "30 minutes", user: str = "user_id", value: str = "value", key: Sequence[str] = ("event_id",), late: str = "2 days", time: str = "ts") -> DataFrame:
    """(user, session_start, session_end, n, total): runs of a user's events with less than ``gap`` between them.

    A session ends ``gap`` after its last event.  On a stream, rows later than ``late`` are
    dropped.  A null user is a user of its own.
    """
    rows = unrepeated(events, key, late, time)
    found = rows.groupBy(F.session_window("_t", gap).alias("w"), F.col(user)).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return found.select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total")
