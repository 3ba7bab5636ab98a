"""Field projection on the PV value structure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def keep_keys(value: Column, names: Column) -> Column:
    """The members of a variant object whose name is in an array of names; no names keeps all."""
    members = F.try_variant_get(value, "$", "map<string,variant>")
    return F.map_filter(members, lambda key, _: (F.size(names) == 0) | F.array_contains(names, key))


def project_fields(df: DataFrame, fields: Sequence[str], column: str = "fields") -> DataFrame:
    """Keep only the named fields of a struct, map or JSON text column; no names keeps all.

    A struct is strict: an unknown field is an analysis error, and the projection prunes the
    nested Parquet columns.  A map, JSON object or variant keeps the named keys that are present,
    each with its own type and nulls; a variant becomes a map from name to variant, and what is
    no object becomes null.
    """
    if not fields:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        kept = F.struct(*[F.col(f"`{column}`.`{name}`").alias(name) for name in fields])
    elif isinstance(kind, T.MapType):
        kept = F.map_filter(F.col(column), lambda key, _: key.isin(*fields))
    elif isinstance(kind, T.StringType):
        kept = F.to_json(keep_keys(F.try_parse_json(F.col(column)), F.array(*map(F.lit, fields))))
    elif isinstance(kind, T.VariantType):
        kept = keep_keys(F.col(column), F.array(*map(F.lit, fields)))
    else:
        raise TypeError(f"cannot project fields of {kind.simpleString()}")
    return df.withColumn(column, kept)


def extract_field(
    df: DataFrame, name: str, as_type: str = "string", column: str = "fields", strict: bool = False
) -> DataFrame:
    """Add one field of a JSON column as a typed column; strict fails on a row without it."""
    found = F.get_json_object(F.col(column), f"$['{name}']").cast(as_type)
    if strict:
        found = F.coalesce(
            found,
            F.raise_error(F.concat(F.lit("missing field: "), F.lit(name))).cast(as_type),
        )
    return df.withColumn(name, found)
