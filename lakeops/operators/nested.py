"""Structs and arrays to flat rows, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_structs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each struct by its fields."""
    return df.select(*[f"{c}.*" if c in cols else c for c in df.columns])


def explode_rows(df: DataFrame, col: str) -> DataFrame:
    """One row per element with the element's fields; parents without elements vanish."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(col).alias(col)).select(*others, f"{col}.*")


def explode_outer_rows(df: DataFrame, col: str) -> DataFrame:
    """One row per element; a parent without elements stays, with null fields."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode_outer(col).alias(col)).select(*others, f"{col}.*")


def struct_or_array(df: DataFrame, col: str) -> DataFrame:
    """Make ``col`` an array of structs even when the files held a single struct."""
    if isinstance(df.schema[col].dataType, T.ArrayType):
        return df
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.array(F.col(col))))


def has_path(schema: T.DataType, path: str) -> bool:
    """Whether a dotted path of fields exists; array elements are looked through."""
    for name in path.split("."):
        if isinstance(schema, T.ArrayType):
            schema = schema.elementType
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return False
        schema = schema[name].dataType
    return True


def flatten_optional_groups(df: DataFrame, groups: Sequence[tuple[str, str]]) -> DataFrame:
    """Expand repeating or single groups ``(path, prefix)``, skipping absent ones.

    Each group is exploded outer and its fields are added as ``prefix`` +
    field. The parent group column goes away when the last path below it is done.
    """
    roots = {path.split(".")[0] for path, _ in groups}
    for path, prefix in groups:
        if not has_path(df.schema, path):
            continue
        kind = df.select(F.col(path).alias("_g")).schema["_g"].dataType
        item = F.explode_outer(path) if isinstance(kind, T.ArrayType) else F.col(path)
        staged = df.select("*", item.alias("_g"))
        fields = staged.schema["_g"].dataType
        if isinstance(fields, T.StructType):
            added = [F.col("_g").getField(n).alias(f"{prefix}{n}") for n in fields.names]
        else:
            added = [F.col("_g").alias(prefix.rstrip("_"))]
        df = staged.select(*df.columns, *added)
    return df.select(*[c for c in df.columns if c not in roots])


def pick_nested_or_flat(df: DataFrame, parent: str, field: str):
    """``parent.field`` where it exists and is not null, else the flat ``parent_field``, as text."""
    options = []
    if has_path(df.schema, f"{parent}.{field}"):
        options.append(F.col(f"{parent}.{field}").cast("string"))
    if f"{parent}_{field}" in df.columns:
        options.append(F.col(f"{parent}_{field}").cast("string"))
    return F.coalesce(*options, F.lit(None).cast("string")).alias(f"{parent}_{field}")


def array_from_rows(df: DataFrame, *, keys: Sequence[str], fields: Mapping[str, str] | Sequence[str], name: str) -> DataFrame:
    """One row per parent with the sorted array of its children.

    The array is one value of one row, so a parent's children must fit in a task's memory by nature.
    """
    pairs = list(fields.items() if isinstance(fields, Mapping) else [(f, f) for f in fields])
    child = F.struct(*[F.col(s).alias(t) for s, t in pairs])
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(child)).alias(name))
