"""PV catalog, address lists, topic map, silent PVs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pvspark.functions.uri import topic_of, uri_protocol, uri_pv_name, uri_status


def parse_uris(uris: DataFrame, uri: str = "uri") -> DataFrame:
    """Add ``protocol``, ``pv_name`` and ``status`` to a table of addresses."""
    address = F.col(uri)
    return uris.select(
        "*",
        uri_protocol(address).alias("protocol"),
        uri_pv_name(address).alias("pv_name"),
        uri_status(address).alias("status"),
    )


def pv_catalog(uris: DataFrame, uri: str = "uri") -> DataFrame:
    """One row per valid PV with the protocols it is addressed by."""
    return (
        parse_uris(uris, uri)
        .where(F.col("status") == "ok")
        .groupBy("pv_name")
        .agg(F.sort_array(F.collect_set("protocol")).alias("protocols"))
    )


def list_report(uris: DataFrame, list_id: str = "list_id", uri: str = "uri") -> DataFrame:
    """Per list: accepted only if every member is valid; the first kind of fault otherwise."""
    malformed = F.col("status") == "malformed"
    bad_protocol = F.col("status") == "bad_protocol"
    return (
        parse_uris(uris, uri)
        .groupBy(list_id)
        .agg(
            F.count(F.lit(1)).alias("n_uris"),
            F.count_if(malformed).alias("n_malformed"),
            F.count_if(bad_protocol).alias("n_bad_protocol"),
            F.every(F.col("status") == "ok").alias("accepted"),
        )
    )


def topic_map(pvs: DataFrame) -> DataFrame:
    """Topic of every distinct PV."""
    return pvs.select("pv_name").distinct().withColumn("topic", topic_of(F.col("pv_name")))


def topic_collisions(pvs: DataFrame) -> DataFrame:
    """Topics more than one PV publishes on.

    Only counts and the extreme names are aggregated, so a topic that a large share of
    all PVs map to is no larger a row than any other.  ``topic_map`` lists the members.
    """
    return (
        topic_map(pvs)
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("n_pvs"),
            F.min("pv_name").alias("first_pv"),
            F.max("pv_name").alias("last_pv"),
        )
        .where(F.col("n_pvs") > 1)
    )


def silent_pvs(catalog: DataFrame, events: DataFrame) -> DataFrame:
    """Catalogued PVs without a single event.

    The log is reduced to its distinct names (combined map-side) before the join.
    """
    heard = events.select("pv_name").distinct()
    return catalog.join(heard, "pv_name", "left_anti")
