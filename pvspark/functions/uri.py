"""PV address grammar as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: address grammar -------------------------------------------------
# ``\z`` instead of ``$``: a trailing line break is rejected.
URI_PATTERN = r"^(pva?|ca)://([A-Za-z0-9\-_:]+(?:\.[A-Za-z0-9\-_]+)*)\z"
SNAPSHOT_NAME_PATTERN = r"^[A-Za-z0-9_\-]+\z"
SUPPORTED_PROTOCOLS = ("pva", "ca")
# -----------------------------------------------------------------------------------


def uri_protocol(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, URI_PATTERN, 1), F.lit(""))


def uri_pv_name(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, URI_PATTERN, 2), F.lit(""))


def uri_status(uri: Column) -> Column:
    """``ok``, ``bad_protocol`` (grammar admits it, support does not) or ``malformed``."""
    protocol = uri_protocol(uri)
    return (
        F.when(protocol.isNull(), "malformed")
        .when(~protocol.isin(*SUPPORTED_PROTOCOLS), "bad_protocol")
        .otherwise("ok")
    )


def topic_of(pv_name: Column) -> Column:
    """Topic a PV publishes on.  Not injective: ``a:b`` and ``a_b`` share one."""
    return F.replace(pv_name, F.lit(":"), F.lit("_"))
