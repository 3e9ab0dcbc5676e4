"""Bring a DataFrame to a declared schema by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StructType


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _to(column: str, source: DataType, target: DataType) -> str:
    # TRY_CAST: a value that does not fit (e.g. non-ISO date text) becomes null instead of
    # failing the whole query under ANSI mode.
    name = _quoted(column)
    return name if source == target else f"TRY_CAST({name} AS {target.simpleString()}) AS {name}"


def conform(df: DataFrame, schema: StructType, allow_missing: bool = False, keep_extra: bool = False) -> DataFrame:
    """Select the schema's columns in its order, cast to its types (bad values -> null).

    A missing column raises ``ValueError`` unless ``allow_missing``, in which case it is
    added as a typed null. With ``keep_extra`` the other columns follow unchanged. The
    projection is sent to the JVM as one list of SQL expressions.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    missing = [field.name for field in schema.fields if field.name not in present]
    if missing and not allow_missing:
        msg = f"Columns {missing} not found in DataFrame."
        raise ValueError(msg)
    columns = [
        _to(field.name, present[field.name], field.dataType)
        if field.name in present
        else f"CAST(NULL AS {field.dataType.simpleString()}) AS {_quoted(field.name)}"
        for field in schema.fields
    ]
    if keep_extra:
        wanted = {field.name for field in schema.fields}
        columns += [_quoted(name) for name in df.columns if name not in wanted]
    return df.selectExpr(*columns)


def losses(df: DataFrame, schema: StructType, date_formats: Sequence[str] = ()) -> dict[str, Column]:
    """Per column of ``schema`` whose type changes: true where conforming turns a value into null.

    A date column also accepts text in ``date_formats`` (after ISO), as the preparation
    operators do when given them.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    found = {}
    for field in schema.fields:
        if field.name not in present or present[field.name] == field.dataType:
            continue
        value = F.col(_quoted(field.name))
        kept = [value.try_cast(field.dataType)]
        if isinstance(field.dataType, DateType):
            kept += [F.try_to_date(value.cast("string"), fmt) for fmt in date_formats]
        found[field.name] = value.isNotNull() & F.coalesce(*kept).isNull()
    return found


def lost_columns(df: DataFrame, schema: StructType, date_formats: Sequence[str] = ()) -> Column:
    """The names of a row's columns that conforming turns into null."""
    names = [F.when(lost, F.lit(name)) for name, lost in losses(df, schema, date_formats).items()]
    return F.filter(F.array(*names).cast("array<string>"), lambda name: name.isNotNull())


def conform_rejects(df: DataFrame, schema: StructType, date_formats: Sequence[str] = ()) -> DataFrame:
    """column_name and rejected: per column of ``schema`` the values that conforming turns into null.

    One aggregation over the columns whose type changes.
    """
    counts = {name: F.count_if(lost) for name, lost in losses(df, schema, date_formats).items()}
    if not counts:
        return df.sparkSession.createDataFrame([], "column_name string, rejected long")
    wide = df.agg(*[count.alias(f"c{i}") for i, count in enumerate(counts.values())])
    cells = [F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("rejected")) for i, name in enumerate(counts)]
    return wide.select(F.inline(F.array(*cells)))
