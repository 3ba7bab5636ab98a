"""Reassembly of recurring snapshot records: header, data, tail.

Only headers and tails decide which iterations exist, so they are handled first and alone:
a small share of the log.  Data records are then placed under their header with one shuffle
of the log, cut into offset segments so that a busy topic is many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pvspark.operators.segments import fitting_width, running_last, segment_of
from pvspark.session import materialise
from pvspark.sizing import checked_broadcast

# --- fixed values: record kinds ----------------------------------------------------
HEADER, DATA, TAIL = 0, 1, 2
# -----------------------------------------------------------------------------------

SEGMENT_OFFSETS = 1 << 30

EPOCHS = (
    "topic STRING, header_offset BIGINT, iteration BIGINT, header_timestamp BIGINT, "
    "tail_offset BIGINT, tail_timestamp BIGINT"
)


def _control(records: DataFrame) -> DataFrame:
    return records.where(F.col("message_type").isin(HEADER, TAIL)).select(
        "topic", "offset", "message_type", F.coalesce("iter_index", F.lit(0)).alias("iter_index"),
        "timestamp_ms",
    )


def _width(records: DataFrame) -> int:
    return fitting_width(records, ["topic"], F.col("offset"), SEGMENT_OFFSETS)


def _in_segments(df: DataFrame, segment_offsets: int | None) -> DataFrame:
    """Add ``__segment`` along the offset; its width is measured unless given."""
    width = segment_offsets or _width(df)
    return df.withColumn("__segment", segment_of(F.col("offset"), width))


def robust_epochs(records: DataFrame, segment_offsets: int | None = None) -> DataFrame:
    """Every header with the first tail of its own iteration before the next header.

    A lost tail costs one iteration: its ``tail_offset`` is null.
    """
    is_header = F.col("message_type") == HEADER
    opened = F.when(
        is_header,
        F.struct(
            F.col("offset").alias("header_offset"),
            F.col("iter_index").alias("iteration"),
            F.col("timestamp_ms").alias("header_timestamp"),
        ),
    )
    placed = running_last(
        _in_segments(_control(records), segment_offsets).withColumn("__opened", opened),
        ["topic"], "__segment", ["offset"], "__opened", "__epoch",
    )
    tail = F.when(
        ~is_header & (F.col("iter_index") == F.col("__epoch.iteration")),
        F.struct(
            F.col("offset").alias("tail_offset"), F.col("timestamp_ms").alias("tail_timestamp")
        ),
    )
    return (
        placed.where(F.col("__epoch").isNotNull())
        .select("topic", "__epoch.*", tail.alias("__tail"))
        .groupBy("topic", "header_offset", "iteration", "header_timestamp")
        .agg(F.min("__tail").alias("__tail"))
        .select("topic", "header_offset", "iteration", "header_timestamp", "__tail.*")
    )


# Headers one task follows at most.
SEGMENT_HEADERS = 200_000
_HEADERS = "topic STRING, header_offset BIGINT, next_header BIGINT, kind STRING"


def _headers_with_tails(control: DataFrame, width: int) -> DataFrame:
    """Every header with the first tail of its iteration after it, and the first header after that tail.

    Both are running values along the reversed offset, so neither a topic nor an iteration is one task.
    """
    back = control.withColumn("__back", -F.col("offset"))
    placed = back.withColumn("__segment", segment_of(F.col("__back"), width)).withColumn(
        "__header", F.when(F.col("message_type") == HEADER, F.struct(F.col("offset").alias("next_header")))
    )
    ahead = running_last(placed, ["topic"], "__segment", ["__back"], "__header", "__next", inclusive=False)
    tail = F.struct(
        F.col("offset").alias("tail_offset"), F.col("timestamp_ms").alias("tail_timestamp"),
        F.col("__next.next_header").alias("next_header"),
    )
    tails = ahead.withColumn("__tail", F.when(F.col("message_type") == TAIL, tail))
    closed = running_last(
        tails, ["topic", "iter_index"], "__segment", ["__back"], "__tail", "__closing", inclusive=False
    )
    return closed.where(F.col("message_type") == HEADER).select(
        "topic",
        F.col("offset").alias("header_offset"),
        F.col("iter_index").alias("iteration"),
        F.col("timestamp_ms").alias("header_timestamp"),
        "__closing.*",
        segment_of(F.col("offset"), width).alias("__segment"),
    )


def _following(headers: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """A segment's headers by offset, and the place of the header accepted after each (its own place if outside)."""
    headers = headers.sort_values("header_offset", ignore_index=True)
    offsets, following = headers["header_offset"].to_numpy(), headers["next_header"].to_numpy(np.float64, na_value=np.inf)
    place = np.searchsorted(offsets, following)
    own = np.arange(len(offsets))
    return headers, np.where(place < len(offsets), place, own)


def _last_of_chain(place: np.ndarray) -> np.ndarray:
    """Where the chain from each header ends within the segment, by doubling the steps."""
    while True:
        further = place[place]
        if (further == place).all():
            return place
        place = further


def _left_to(headers: pd.DataFrame) -> pd.DataFrame:
    """The headers beyond the segment that any of its chains leads to."""
    headers, place = _following(headers)
    out = headers.iloc[np.unique(_last_of_chain(place))]
    out = out[out["next_header"].notna()].drop_duplicates("next_header")
    return pd.DataFrame({"topic": out["topic"], "header_offset": out["next_header"].astype("int64")})


def _way_through(group: pd.DataFrame) -> pd.DataFrame:
    """Of the headers at which a segment may be entered, where each one's chain leaves it."""
    headers, place = _following(group[group["kind"] == "header"])
    entries = np.unique(group["header_offset"][group["kind"] == "entry"].to_numpy())
    at = np.searchsorted(headers["header_offset"].to_numpy(), entries)
    left = headers["next_header"].to_numpy()[_last_of_chain(place)[at]]
    return pd.DataFrame({"topic": group["topic"].iloc[0], "header_offset": entries, "next_header": pd.array(left, "Int64"), "kind": "entry"})


def _entered(entries: pd.DataFrame) -> pd.DataFrame:
    """Compose the segments of a topic: the entries that its first header leads to, few rows a segment."""
    way = dict(zip(entries["header_offset"], entries["next_header"]))
    at, out = min(way), []
    while not pd.isna(at):
        out.append(at)
        at = way[at]
    return pd.DataFrame({"topic": entries["topic"].iloc[0], "header_offset": out})


def _accepted(group: pd.DataFrame) -> pd.DataFrame:
    """The closed iterations of a segment's chain from its entry."""
    headers, place = _following(group[group["kind"] == "header"])
    entry = group["header_offset"][group["kind"] == "entry"]
    chain: list[int] = []
    if len(entry):
        at = int(np.searchsorted(headers["header_offset"].to_numpy(), entry.min()))
        chain.append(at)
        while place[at] != at:
            at = int(place[at])
            chain.append(at)
    out = headers.iloc[chain]
    return out[out["tail_offset"].notna()][_EPOCH_COLUMNS]


_EPOCH_COLUMNS = [field.split()[0] for field in EPOCHS.split(", ")]


def exact_epochs(records: DataFrame, segment_offsets: int | None = None) -> DataFrame:
    """The iterations a strict consumer accepts: an open header refuses every later one.

    A lost tail blocks its topic until a tail of that iteration arrives.  If a header is accepted, the tail that
    closes it is the first one of its iteration after it, and the next header accepted is the first after that
    tail: a chain through the headers of a topic.  Chains are followed within segments of a topic, by doubling
    steps; a segment hands on only where its chains lead to, which are few headers as chains soon meet.  Those
    rows are composed per topic, and each segment then marks the one chain that enters it.
    """
    # Headers and tails are a small share of the log; the running values below read them several times.
    control = materialise(_control(records))
    width = segment_offsets
    if width is None:
        # Sparse offsets must not give segments of a header each, so the widest segment is the whole log.
        widest = (control.agg(F.max("offset")).first()[0] or 0) + 1
        width = fitting_width(control, ["topic"], F.col("offset"), widest, SEGMENT_HEADERS)
    headers = materialise(_headers_with_tails(control, width))
    segment = segment_of(F.col("header_offset"), width).alias("__segment")
    first = headers.groupBy("topic").agg(F.min("header_offset").alias("header_offset"))
    left_to = headers.select("topic", "__segment", "header_offset", "next_header").groupBy("topic", "__segment").applyInPandas(
        _left_to, "topic STRING, header_offset BIGINT"
    )
    marked = headers.withColumn("kind", F.lit("header"))

    def with_entries(entries: DataFrame):
        rows = entries.select("topic", "header_offset", segment, F.lit("entry").alias("kind"))
        return marked.unionByName(rows, allowMissingColumns=True).groupBy("topic", "__segment")

    ways = with_entries(first.unionByName(left_to)).applyInPandas(
        lambda group: _way_through(group) if (group["kind"] == "entry").any() else pd.DataFrame(columns=["topic", "header_offset", "next_header", "kind"]),
        _HEADERS,
    )
    entered = ways.groupBy("topic").applyInPandas(_entered, "topic STRING, header_offset BIGINT")
    return with_entries(entered).applyInPandas(_accepted, EPOCHS)


def place_data(
    records: DataFrame, epochs: DataFrame, segment_offsets: int | None = None
) -> DataFrame:
    """Data records under their completed iteration, one row per value.

    A record counts if it lies between header and tail, has their iteration, and holds
    exactly one PV (``pv_name`` is null otherwise).
    """
    iteration = F.coalesce("iter_index", F.lit(0))
    data = records.where(F.col("message_type") == DATA).select(
        "topic", "offset", iteration.alias("iter_index"), "pv_name", "value"
    )
    headers = epochs.select(
        "topic",
        F.col("header_offset").alias("offset"),
        F.struct(
            "header_offset", "iteration", "header_timestamp", "tail_offset", "tail_timestamp"
        ).alias("__opened"),
    )
    line = _in_segments(data.unionByName(headers, allowMissingColumns=True), segment_offsets)
    filled = running_last(line, ["topic"], "__segment", ["offset"], "__opened", "__epoch")
    return filled.where(
        F.col("__opened").isNull()
        & F.col("pv_name").isNotNull()
        & (F.col("iter_index") == F.col("__epoch.iteration"))
        & (F.col("offset") < F.col("__epoch.tail_offset"))
    ).select(
        "topic",
        F.col("__epoch.header_offset").alias("header_offset"),
        F.col("__epoch.iteration").alias("iteration"),
        F.col("__epoch.header_timestamp").alias("header_timestamp"),
        F.col("__epoch.tail_timestamp").alias("tail_timestamp"),
        F.col("__epoch.tail_timestamp").alias("timestamp"),
        "offset",
        "pv_name",
        "value",
    )


def reassemble(
    records: DataFrame, mode: str = "robust", segment_offsets: int | None = None, pv_list: DataFrame | None = None
) -> DataFrame:
    """Values of every completed iteration, one row per value, ordered by offset.

    The last row of an iteration has the tail's offset and a null ``pv_name``, so an iteration
    without values shows too.  With a ``pv_list`` (topic, pv_name) only its topics and PVs are in the result,
    and a listed PV without a value has one row whose ``offset`` and ``value`` are null.
    """
    if mode not in ("robust", "exact"):
        raise ValueError("mode must be 'robust' or 'exact'")
    width = segment_offsets or _width(records)
    epochs = robust_epochs(records, width) if mode == "robust" else exact_epochs(records, segment_offsets)
    epochs = materialise(epochs)
    closing = epochs.where(F.col("tail_offset").isNotNull()).select(
        "topic",
        "header_offset",
        "iteration",
        "header_timestamp",
        "tail_timestamp",
        F.col("tail_timestamp").alias("timestamp"),
        F.col("tail_offset").alias("offset"),
    )
    values = place_data(records, epochs, width)
    if pv_list is not None:
        values = materialise(_of_listed(epochs, values, pv_list))
        closing = closing.join(checked_broadcast(pv_list.select("topic").distinct()), "topic", "left_semi")
    return values.unionByName(closing, allowMissingColumns=True)


def _of_listed(epochs: DataFrame, values: DataFrame, pv_list: DataFrame) -> DataFrame:
    """The values of listed PVs, and a row for each listed PV that an iteration has no value of."""
    listed = checked_broadcast(pv_list.select("topic", "pv_name").distinct())
    silent = (
        completed_iterations(epochs, values, pv_list).where(F.col("n_values") == 0).drop("n_values")
        .withColumn("timestamp", F.col("tail_timestamp"))
    )
    kept = values.join(listed, ["topic", "pv_name"], "left_semi").select(values.columns)
    return kept.unionByName(silent, allowMissingColumns=True)


def completed_iterations(epochs: DataFrame, values: DataFrame, pv_list: DataFrame) -> DataFrame:
    """Each listed PV of each completed iteration with its number of values.

    ``pv_list`` has topic and pv_name.  Unlisted PVs are left out; a listed PV without data
    has 0.  Completion and counting share one shuffle.
    """
    listed = checked_broadcast(pv_list.select("topic", "pv_name").distinct())
    spine = (
        epochs.where(F.col("tail_offset").isNotNull())
        .select("topic", "header_offset", "iteration", "header_timestamp", "tail_timestamp")
        .join(listed, "topic")
        .withColumn("__n", F.lit(0).cast("bigint"))
    )
    counted = (
        values.join(listed, ["topic", "pv_name"], "left_semi")
        .select(*spine.columns[:-1])
        .withColumn("__n", F.lit(1).cast("bigint"))
    )
    keys = spine.columns[:-1]
    return spine.unionByName(counted).groupBy(*keys).agg(F.sum("__n").alias("n_values"))
