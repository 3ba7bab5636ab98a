"""Column tables: pack rows into column arrays, unpack them, replace a column.

A column table value is ``labels ARRAY<STRING>`` and ``payload STRUCT<column: ARRAY>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.operators.segments import LIST_VALUES, ordered_lists


def _payload(items: str, columns: Sequence[str]) -> Column:
    # Bind the name early: the lambda runs when the column is built, once per label.
    def column_of(name: str) -> Column:
        return F.transform(items, lambda row: row[name])

    return F.struct(*[column_of(name).alias(name) for name in columns])


def pack_tables(
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str],
    position: Column,
    widest: int,
    max_rows: int = LIST_VALUES,
) -> DataFrame:
    """Rows of each key as table values, ordered by ``order``.

    Every table comes in parts of at most ``max_rows`` rows, numbered by ``part``, with the place
    of the part's first row as ``first_position``, so that a hot key is many cells.
    ``position`` is the BIGINT axis of the order and ``widest`` a width along it.
    """
    lists = ordered_lists(rows, keys, position, widest, order, columns, "__rows", max_rows)
    return lists.select(
        *keys,
        "part",
        "first_position",
        F.array(*[F.lit(name) for name in columns]).alias("labels"),
        _payload("__rows", columns).alias("payload"),
    )


def table_status(columns: Sequence[str], payload: str = "payload") -> Column:
    """``ok``, or ``ragged`` when the column arrays differ in length."""
    sizes = [F.size(F.col(f"{payload}.`{name}`")) for name in columns]
    same = F.lit(True)
    for size in sizes[1:]:
        same = same & (size == sizes[0])
    return F.when(same, "ok").otherwise("ragged")


def unpack_tables(
    tables: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per table row, with its position in the whole table; ragged ones are padded and flagged.

    Tables without ``first_position`` are whole.
    """
    zipped = F.arrays_zip(*[F.col(f"payload.`{name}`").alias(name) for name in columns])
    first = F.col("first_position") if "first_position" in tables.columns else F.lit(0).cast("bigint")
    return tables.select(
        *keys,
        table_status(columns).alias("status"),
        first.alias("__first"),
        F.posexplode(zipped).alias("__at", "__row"),
    ).select(
        *keys,
        "status",
        (F.col("__first") + F.col("__at")).alias("row_index"),
        *[F.col(f"__row.`{name}`").alias(name) for name in columns],
    )


def set_columns(
    tables: DataFrame, replacements: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Apply column replacements to stored tables.

    ``replacements`` has the keys, ``seq``, ``label`` and ``data`` (texts are cast to the
    column's type); the last one per label wins.  A label that is in the table's own ``labels``
    and in ``columns`` is known; another changes nothing and makes ``status`` ``undefined_label``.
    For tables in parts, ``keys`` include ``part``, and each part's data is replaced.
    """
    label = F.col("label")
    declared = tables.select(*keys, F.col("labels").alias("__labels"))
    replacements = replacements.join(declared, list(keys), "left")
    known = label.isin(*columns) & F.coalesce(F.array_contains("__labels", label), F.lit(False))
    per_table = replacements.groupBy(*keys).agg(
        *[
            F.max_by("data", F.when(known & (label == name), F.col("seq"))).alias(f"__new_{name}")
            for name in columns
        ],
        F.count_if(known).alias("__known"),
        F.count_if(~known).alias("__unknown"),
    )

    def replaced(name: str) -> Column:
        kind = tables.schema["payload"].dataType[name].dataType.simpleString()
        new = F.col(f"__new_{name}").cast(kind)
        return F.coalesce(new, F.col(f"payload.`{name}`")).alias(name)

    status = (
        F.when(F.col("__unknown") > 0, "undefined_label")
        .when(F.col("__known") > 0, "replaced")
        .otherwise("unchanged")
    )
    return tables.join(per_table, list(keys), "left").select(
        *keys,
        *[name for name in ("part", "first_position") if name in tables.columns and name not in keys],
        "labels",
        F.struct(*[replaced(name) for name in columns]).alias("payload"),
        status.alias("status"),
    )
