"""Time as a number."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clock_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time column.

    A TIMESTAMP_NTZ is taken as it reads on the clock, without the session's zone:
    a change to summer time would otherwise reorder readings. In a session by UTC
    the cast does just that, without the decimals of ``extract``.
    """
    ts = F.col(name)
    if dict(df.dtypes)[name] == "timestamp":
        return F.unix_micros(ts)
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z"):
        return F.unix_micros(ts.cast("timestamp"))
    day = F.unix_date(ts.cast("date")).cast("bigint")
    minutes = (day * 24 + F.hour(ts)) * 60 + F.minute(ts)
    second = F.extract(F.lit("SECOND"), ts)
    return minutes * 60_000_000 + (second * 1_000_000).cast("bigint")
