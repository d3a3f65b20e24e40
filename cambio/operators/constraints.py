"""Load constraints: NOT NULL and byte-length limits. Spark's file tables do not enforce the former.

A number that is NaN is missing, as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cambio.schemas import TableSpec


def _present(value: Column, kind: T.DataType) -> Column:
    return F.nanvl(value, F.lit(None).cast(kind)) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _broken(spec: TableSpec) -> dict[str, Column]:
    kinds = {field.name: field.dataType for field in spec.schema.fields}
    rules = {f"{name} is NULL": _present(F.col(name).cast(kinds[name]), kinds[name]).isNull() for name in spec.not_null}
    for name, limit in spec.max_bytes:
        rules[f"{name} longer than {limit} bytes"] = F.coalesce(F.octet_length(name) > limit, F.lit(False))
    return rules


def enforce(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows in the table's columns and types; the first row that breaks a constraint fails whatever job reads them.

    The checks sit in the projected columns themselves, so they cost no extra pass and cannot be pruned away.
    """
    limits = dict(spec.max_bytes)
    columns = []
    for field in spec.schema.fields:
        value = _present(F.col(field.name).cast(field.dataType), field.dataType)
        if field.name in limits:
            message = F.lit(f"{spec.name}.{field.name} is longer than {limits[field.name]} bytes")
            value = F.when(F.octet_length(value) > limits[field.name], F.raise_error(message)).otherwise(value)
        if field.name in spec.not_null:
            message = F.lit(f"{spec.name}.{field.name} must not be NULL")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def violations(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``(table_name, violation, n)`` for every constraint, in one aggregation pass."""
    rules = _broken(spec)
    counts = rows.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    pairs = [
        F.struct(F.lit(spec.name).alias("table_name"), F.lit(name).alias("violation"), F.col(f"`{name}`").alias("n"))
        for name in rules
    ]
    return counts.select(F.inline(F.array(*pairs)))
