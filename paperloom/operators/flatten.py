"""Nested records into related flat tables.

The schema is walked once; each array (or map) level becomes a child table
whose rows carry the key of the record, the surrogate key of their own node
(its path in the record), the key of their parent and their ordinal. Every
table reads only its own nested columns, and no table needs a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class ChildTable:
    """path: the level, e.g. ``images.figure_data.nodes``; scalars: column
    suffix (as in node paths) to column of ``rows``."""

    path: str
    parent: str
    rows: DataFrame
    scalars: dict[str, str] = field(default_factory=dict)


def infer_merged_schema(df: DataFrame, column: str) -> T.DataType:
    """The merged schema of all JSON texts of a column (one aggregate over all
    rows; texts that aren't JSON count as null)."""
    ddl = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]
    return T.DataType.fromDDL(ddl.replace("OBJECT<", "STRUCT<")) if ddl and ddl != "VOID" else T.StringType()


def parse_merged(df: DataFrame, column: str) -> DataFrame:
    """``column`` of JSON text replaced by values of its merged schema."""
    kind = infer_merged_schema(df, column)
    return df.withColumn(column, F.from_json(F.col(column), kind))


def _split(kind: T.DataType, col: Column, suffix: str) -> tuple[list[tuple[str, Column, T.DataType]], list[tuple[str, Column, T.DataType]]]:
    """(scalars, nested levels) reachable without crossing an array."""
    if isinstance(kind, T.StructType):
        scalars, levels = [], []
        for f in kind.fields:
            s, n = _split(f.dataType, col[f.name], f"{suffix}.{f.name}")
            scalars += s
            levels += n
        return scalars, levels
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return [], [(suffix, col, kind)]
    return [(suffix, col, kind)], []


def normalise(df: DataFrame, key: str, columns: list[str]) -> list[ChildTable]:
    """Child tables of the nested ``columns``, parents before children.

    rows: (record_key, parent_node, node, ordinal, s0, s1, ...). ``node`` is
    unique within a record; ordinals count from 0 in the stored array, nulls
    included (a null element is a row without scalars); the ordinal of a map
    entry is its place in the map. Null and empty arrays give no rows.
    """
    tables: list[ChildTable] = []

    def descend(source: DataFrame, node: Column, values: Column, kind: T.DataType, suffix: str, path: str, parent: str) -> None:
        if isinstance(kind, T.MapType):
            step = source.select("record_key", node.alias("parent_node"), F.posexplode(F.map_entries(values)).alias("ordinal", "entry"))
            here = F.concat("parent_node", F.lit(f"{suffix}["), F.col("entry.key").cast("string"), F.lit("]"))
            element, inner = F.col("entry.value"), kind.valueType
        else:
            step = source.select("record_key", node.alias("parent_node"), F.posexplode(values).alias("ordinal", "entry"))
            here = F.concat("parent_node", F.lit(f"{suffix}["), F.col("ordinal").cast("string"), F.lit("]"))
            element, inner = F.col("entry"), kind.elementType
        scalars, levels = _split(inner, element, "")
        names = {s: f"s{i}" for i, (s, _, _) in enumerate(scalars)}
        rows = step.select("record_key", "parent_node", here.alias("node"), "ordinal", *[c.alias(names[s]) for s, c, _ in scalars])
        tables.append(ChildTable(path, parent, rows, names))
        for sub, c, k in levels:
            below = step.select("record_key", here.alias("node"), c.alias("values"))
            descend(below, F.col("node"), F.col("values"), k, sub, f"{path}{sub or '.items'}", path)

    for name in columns:
        kind = df.schema[name].dataType
        source = df.select(F.col(key).alias("record_key"), F.col(name).alias("values")).filter(F.col("values").isNotNull())
        scalars, levels = _split(kind, F.col("values"), name)
        if scalars:
            names = {s: f"s{i}" for i, (s, _, _) in enumerate(scalars)}
            rows = source.select("record_key", F.lit(None).cast("string").alias("parent_node"), F.lit("").alias("node"), F.lit(0).alias("ordinal"), *[c.alias(names[s]) for s, c, _ in scalars])
            tables.append(ChildTable(name, "", rows, names))
        for sub, c, k in levels:
            descend(source.select("record_key", c.alias("values")), F.lit(""), F.col("values"), k, sub, sub, name if scalars else "")
    return tables


def leaf_rows(tables: list[ChildTable], key: str = "record_key", path: str = "node_path", value: str = "node_value") -> DataFrame:
    """One row for each scalar that isn't null, from all child tables."""
    parts = []
    for t in tables:
        if t.scalars:
            cells = F.array(*[F.struct(F.lit(s).alias("s"), F.col(c).cast("string").alias("v")) for s, c in t.scalars.items()])
            flat = t.rows.select("record_key", "node", F.inline(cells)).filter("v IS NOT NULL")
            parts.append(flat.select(F.col("record_key").alias(key), F.concat("node", "s").alias(path), F.col("v").alias(value)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
