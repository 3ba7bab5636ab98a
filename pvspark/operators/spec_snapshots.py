"""Snapshots driven by a table of specs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from pvspark.operators.projection import keep_keys
from pvspark.operators.snapshots import recurring_buffered, recurring_normal
from pvspark.operators.specs import MEMBER_PARAMS, NORMAL, TIMED_BUFFERED, snapshot_members
from pvspark.operators.triggered import triggered_buffered, triggered_normal
from pvspark.sizing import checked_broadcast


def snapshots_from_specs(
    events: DataFrame, specs: DataFrame, triggers: DataFrame, origin_ms: int
) -> DataFrame:
    """The rows of every valid spec, each by its own type, trigger mode, windows and fields.

    ``events`` carry a value of any type and ``fields`` (a JSON object, or a VARIANT one) besides it;
    ``triggers`` are those of triggered specs.  A recurring or triggered NORMAL spec gives the last value per
    listed PV, a TIMED_BUFFERED one every value; a PV without one has a row with null ``seq``.  ``fields``
    holds the members that the spec's field filter names, all if it names none.  ``push_index`` is the partial
    push of a recurring TIMED_BUFFERED value.  A spec of another type is a fault of ``validate_specs``.
    """
    wanted = specs if "pv_field_filter_list" in specs.columns else specs.withColumn(
        "pv_field_filter_list", F.array().cast("array<string>")
    )
    listed = snapshot_members(wanted, "type", "triggered", "pv_field_filter_list")

    def of(kind: str, manual: bool) -> DataFrame:
        chosen = listed.where((F.col("type") == kind) & (F.col("triggered") == manual))
        return chosen.select("snapshot_name", "pv_name", *MEMBER_PARAMS)

    columns = ["snapshot_name", "iteration", "push_index", "pv_name", "seq", "value"]
    asked = {kind: of(kind, True) for kind in (NORMAL, TIMED_BUFFERED)}
    pulled = {
        kind: triggers.join(members.select("snapshot_name").distinct(), "snapshot_name", "left_semi")
        for kind, members in asked.items()
    }
    # The operators take a value of any type: the fields travel with the value they belong to.
    whole = events.withColumn("value", F.struct("value", "fields"))
    no_push = F.lit(None).cast("bigint").alias("push_index")

    def unpushed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("push_index", no_push)

    parts = [
        unpushed(recurring_normal(whole, of(NORMAL, False), origin_ms).withColumnRenamed("value_seq", "seq")),
        recurring_buffered(whole, of(TIMED_BUFFERED, False), origin_ms),
        unpushed(triggered_normal(pulled[NORMAL], asked[NORMAL], whole).withColumnRenamed("value_seq", "seq")),
        unpushed(triggered_buffered(pulled[TIMED_BUFFERED], asked[TIMED_BUFFERED], whole)),
    ]
    parts = [part.select(*columns) for part in parts]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    filters = listed.select("snapshot_name", "pv_name", "type", "triggered", "pv_field_filter_list")
    names = F.coalesce("pv_field_filter_list", F.array().cast("array<string>"))
    kind = events.schema["fields"].dataType
    carried = F.col("value.fields")
    if isinstance(kind, T.StringType):
        fields = F.to_json(keep_keys(F.try_parse_json(carried), names))
    elif isinstance(kind, T.VariantType):
        fields = keep_keys(carried, names)
    else:
        raise TypeError(f"fields must be JSON text or VARIANT, not {kind.simpleString()}")
    return rows.join(checked_broadcast(filters), ["snapshot_name", "pv_name"]).select(
        *columns[:-1], F.col("value.value").alias("value"), "type", "triggered", fields.alias("fields")
    )
