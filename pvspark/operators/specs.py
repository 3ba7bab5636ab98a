"""Snapshot specifications: defaults, validation, membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.functions.uri import SNAPSHOT_NAME_PATTERN, uri_pv_name, uri_status

# --- fixed values: snapshot kinds and specification defaults ------------------------
NORMAL = "normal"
TIMED_BUFFERED = "timedbuffered"
SPEC_DEFAULTS = {
    "time_window": 1000,
    "repeat_delay": 0,
    "sub_push_delay_msec": 0,
    "respect_push_order": True,
    "triggered": False,
    "type": NORMAL,
}
# -----------------------------------------------------------------------------------


def with_defaults(specs: DataFrame) -> DataFrame:
    """Give the optional spec columns their defaults where they are absent or null."""
    filled = {}
    for name, value in SPEC_DEFAULTS.items():
        default = F.lit(value).cast("bigint") if type(value) is int else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in specs.columns else default
    return specs.withColumns(filled)


def validate_specs(specs: DataFrame) -> DataFrame:
    """Fill in defaults and add ``error``: the first failing rule, or null for a valid spec.

    The address check of the whole list comes first, as it does when a snapshot is created.
    ``sub_push_delay_msec`` is not validated.
    """
    name = F.col("snapshot_name")
    uris = F.col("pv_uri_list")

    def has_status(status: str) -> Column:
        return F.exists(uris, lambda uri: uri.isNotNull() & (uri_status(uri) == status))

    error = (
        F.when(has_status("malformed"), "malformed_uri")
        .when(has_status("bad_protocol"), "bad_protocol")
        .when(F.coalesce(name, F.lit("")) == "", "empty_name")
        .when(~F.regexp_like(name, F.lit(SNAPSHOT_NAME_PATTERN)), "invalid_name")
        .when(F.coalesce(F.size(uris), F.lit(0)) <= 0, "empty_pv_list")
        .when(F.exists(uris, lambda uri: uri.isNull()), "non_text_uri")
        .when(F.col("time_window") < 0, "negative_time_window")
        .when(F.col("repeat_delay") < 0, "negative_repeat_delay")
        .when(~F.col("type").isin(NORMAL, TIMED_BUFFERED), "unknown_type")
    )
    return with_defaults(specs).withColumn("error", error)


MEMBER_PARAMS = ("time_window", "repeat_delay", "sub_push_delay_msec")


def snapshot_members(specs: DataFrame, *carried: str) -> DataFrame:
    """Long form of the valid specs: one row per distinct (snapshot_name, pv_name).

    A spec with any fault has no members.  The key is the PV name, so ``pva://x`` and ``ca://x``
    are one member.  Further columns of the specs are ``carried`` along.
    """
    kept = [*MEMBER_PARAMS, *carried]
    return (
        validate_specs(specs)
        .where(F.col("error").isNull())
        .select("snapshot_name", *kept, F.explode("pv_uri_list").alias("uri"))
        .select("snapshot_name", uri_pv_name(F.col("uri")).alias("pv_name"), *kept)
        .dropDuplicates(["snapshot_name", "pv_name"])
    )
