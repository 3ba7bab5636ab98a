"""Small tables and comparisons for the tests."""

from datetime import datetime, timedelta

ORIGIN = datetime(2024, 1, 1)
ORIGIN_MS = 1_704_067_200_000


def at(ms):
    return ORIGIN + timedelta(milliseconds=ms)


def rows(df):
    """Rows as plain tuples, in a stable order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def events(spark, items):
    """items: (seq, pv_name, offset in ms from the origin, value)"""
    return spark.createDataFrame(
        [(seq, pv, at(ms), ORIGIN_MS + ms, float(value)) for seq, pv, ms, value in items],
        "seq BIGINT, pv_name STRING, ts TIMESTAMP_NTZ, ts_ms BIGINT, value DOUBLE",
    )


def members(spark, pvs, window, delay=0, push=0, snapshot="snap"):
    return spark.createDataFrame(
        [(snapshot, pv, window, delay, push) for pv in pvs],
        "snapshot_name STRING, pv_name STRING, time_window BIGINT, repeat_delay BIGINT, "
        "sub_push_delay_msec BIGINT",
    )
