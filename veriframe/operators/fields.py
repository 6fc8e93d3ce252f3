"""Computed fields: derived columns of a container."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.functions.skew import lookup
from veriframe.functions.text import cleaned_name, formatted_number, name_key


def _src(name: str) -> Column:
    return F.col(f"`{name}`")


def cast_field(src: str, target_type: str, format: str | None = None) -> Column:
    """Cast to a Spark SQL type, dates optionally by pattern; what fails is null."""
    kind = target_type.lower()
    if format is None:
        return _src(src).try_cast(target_type)
    text = _src(src).cast("string")
    if kind == "date":
        return F.try_to_date(text, format)
    return F.try_to_timestamp(text, F.lit(format)).try_cast(target_type)


def cleaned_entity_name(src: str, **options) -> Column:
    return cleaned_name(_src(src), **options)


def convert_formatted_numeric(src: str) -> Column:
    return formatted_number(_src(src))


def custom_expression(expression: str, source_fields: Sequence[str] | None = None) -> Column:
    """Any Spark SQL expression; it names its columns itself, so no source fields."""
    if source_fields is not None:
        raise ValueError("a custom expression takes no source fields")
    return F.expr(expression)


def concatenate(fields: Sequence[str], separator: str = " ") -> Column:
    """Fields joined by ``separator``; nulls are skipped."""
    return F.concat_ws(separator, *[_src(f).cast("string") for f in fields])


def entity_name_lookup(
    df: DataFrame, src: str, ref: DataFrame, ref_field: str, id_field: str, out_field: str
) -> DataFrame:
    """Resolve a name through a reference container by normalised name.

    Many matches give the smallest id, none gives null.
    """
    found = (
        ref.select(name_key(F.col(f"`{ref_field}`")).alias("_ref"), F.col(f"`{id_field}`").alias("_id"))
        .filter(F.col("_ref").isNotNull())
        .groupBy("_ref")
        .agg(F.min("_id").alias(out_field))
    )
    keyed = df.withColumn("_name", name_key(_src(src)))
    return lookup(keyed, ["_name"], found, ["_ref"]).drop("_name")


@dataclass(frozen=True)
class ComputedField:
    """Definition of one computed field."""

    name: str
    transformation: str
    source_fields: Sequence[str] | None = None
    properties: Mapping[str, object] = field(default_factory=dict)


def field_column(definition: ComputedField) -> Column:
    """The column of a definition that needs no join."""
    props = definition.properties
    kind = definition.transformation
    if kind == "customExpression":
        return custom_expression(props["column_expression"], definition.source_fields)
    sources = list(definition.source_fields or ())
    if not sources:
        raise ValueError(f"{kind} needs a source field")
    if kind == "concatenate":
        return concatenate(sources, props.get("separator", " "))
    if len(sources) != 1:
        raise ValueError(f"{kind} takes exactly one source field")
    src = sources[0]
    if kind == "cast":
        return cast_field(src, props["target_type"], props.get("format"))
    if kind == "cleanedEntityName":
        return cleaned_entity_name(
            src,
            terms_to_drop=list(props.get("terms_to_drop") or ()),
            terms_to_ignore=list(props.get("terms_to_ignore") or ()),
            suffix=bool(props.get("drop_from_suffix")),
            prefix=bool(props.get("drop_from_prefix")),
            interior=bool(props.get("drop_from_interior")),
        )
    if kind == "convertFormattedNumeric":
        return convert_formatted_numeric(src)
    raise ValueError(f"unknown transformation {kind}")


def apply_computed_fields(
    df: DataFrame,
    definitions: Sequence[ComputedField],
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Add every field, replacing columns of the same name; the last definition wins.

    All but the lookups become one projection over the container's own columns.
    """
    by_name = {d.name: d for d in definitions}
    plain = {n: d for n, d in by_name.items() if d.transformation != "entityNameLookup"}
    out = df.withColumns({n: field_column(d) for n, d in plain.items()}) if plain else df
    for name, d in by_name.items():
        if d.transformation == "entityNameLookup":
            props = d.properties
            if name in out.columns:
                out = out.withColumnRenamed(name, "_replaced")
            src = d.source_fields[0] if d.source_fields[0] != name else "_replaced"
            out = entity_name_lookup(
                out, src, references[props["ref_container_name"]],
                props["ref_field"], props["ref_id_field"], name,
            ).drop("_replaced")
    return out
