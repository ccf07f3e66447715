"""Queries pN_ of the general data problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fields, flatten, pivot

ENTITY = ["entity_kind", "entity_id"]
NESTED = ["tables", "images", "metadata"]


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    q = _read(spark, d, "questions")
    return fields.split_packed_field(q, "question_uid", "correct_answer", "options", "answer_pos", "answer_value")


def _wide(spark: SparkSession, d: str, typed: bool) -> tuple[DataFrame, list[pivot.Attribute]]:
    attributes = pivot.attribute_list(_read(spark, d, "metadata_attributes"))
    latest = pivot.latest_values(_read(spark, d, "metadata_rows"), attributes, ENTITY)
    return pivot.pivot_wide(latest, attributes, ENTITY, typed), attributes


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    wide, attributes = _wide(spark, d, typed=False)
    return pivot.melt(wide, attributes, ENTITY)


def p3_wide(spark: SparkSession, d: str) -> DataFrame:
    wide, attributes = _wide(spark, d, typed=True)
    return wide.select(*ENTITY, *[F.col(f"`{a.name}`").alias(a.name.lower().replace(" ", "_")) for a in attributes])


def p3_attributes(spark: SparkSession, d: str) -> DataFrame:
    return pivot.discover_attributes(_read(spark, d, "metadata_rows"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    tables = flatten.normalise(_read(spark, d, "questions"), "question_uid", NESTED)
    return flatten.leaf_rows(tables, "question_uid")


def p5_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all child tables: their level, parent and ordinal."""
    tables = flatten.normalise(_read(spark, d, "questions"), "question_uid", NESTED)
    out = None
    for t in tables:
        part = t.rows.select(F.col("record_key").alias("question_uid"), F.lit(t.path).alias("level"), "parent_node", "node", "ordinal")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {f.__name__: f for f in (p1_found, p3_found, p3_wide, p3_attributes, p5_found, p5_nodes)}

_P3 = r"""
WITH attrs AS (SELECT attr_name, value_type, regexp_replace(lower(attr_name), '[^a-z0-9]', '', 'g') AS k FROM metadata_attributes),
names AS (SELECT DISTINCT attr_name AS raw, regexp_replace(lower(attr_name), '[^\p{L}\p{N}]', '', 'g') AS k FROM metadata_rows WHERE attr_name IS NOT NULL),
dist AS (SELECT n.raw, a.attr_name, a.value_type, levenshtein(n.k, a.k) AS d, length(n.k) AS len FROM names n, attrs a),
near AS (SELECT * FROM dist WHERE d <= 1 OR (d = 2 AND len >= 8)),
best AS (SELECT raw, min(d) AS d FROM near GROUP BY raw),
hit AS (SELECT raw, min(attr_name) AS attr_name, min(value_type) AS value_type FROM near JOIN best USING (raw, d) GROUP BY raw HAVING count(*) = 1),
base AS (SELECT entity_kind, entity_id, h.attr_name, value_type, recorded_at, row_id, regexp_replace(attr_value, '^\s+|\s+$', '', 'g') AS s
  FROM metadata_rows r JOIN hit h ON r.attr_name = h.raw WHERE entity_kind IS NOT NULL AND entity_id IS NOT NULL),
live AS (SELECT * FROM base WHERE lower(s) NOT IN ('', '-', '--', '?', '??', 'n/a', 'n.a.', 'na', 'nan', 'nil', 'none', 'null')),
num AS (SELECT *, CASE WHEN value_type = 'int' THEN regexp_extract(s, '^([+-]?\d+)(?:\.0*)?\s*(?:[\p{L}%°][\p{L}%°/]*\.?)?$', 1)
  WHEN value_type = 'decimal' THEN replace(regexp_extract(s, '^([+-]?(?:\d+(?:[.,]\d*)?|[.,]\d+))\s*(?:[\p{L}%°][\p{L}%°/]*\.?)?$', 1), ',', '.') END AS n FROM live),
parsed AS (SELECT *, CASE value_type
  WHEN 'text' THEN s
  WHEN 'bool' THEN CASE WHEN lower(s) IN ('true', 't', 'yes', 'y', '1') THEN 'true' WHEN lower(s) IN ('false', 'f', 'no', 'n', '0') THEN 'false' END
  WHEN 'date' THEN strftime(coalesce(
     try_strptime(regexp_extract(s, '^\d{4}[-/]\d{1,2}[-/]\d{1,2}'), ['%Y-%m-%d', '%Y/%m/%d']),
     try_strptime(regexp_extract(s, '^\d{8}$'), '%Y%m%d'),
     try_strptime(s, ['%d-%b-%Y', '%d %B %Y', '%B %d, %Y', '%d/%m/%Y'])), '%Y-%m-%d')
  ELSE CASE WHEN n <> '' THEN
     CASE WHEN CAST(n AS DECIMAL(30, 8)) = 0 THEN '0' ELSE
       CASE WHEN n LIKE '-%' THEN '-' ELSE '' END || regexp_replace(regexp_replace(CAST(abs(CAST(n AS DECIMAL(30, 8))) AS VARCHAR), '0+$', ''), '\.$', '') END END
  END AS v FROM num)
"""

_LEAVES = """
WITH t AS (SELECT question_uid, unnest(tables) AS x, generate_subscripts(tables, 1) - 1 AS i FROM questions),
h AS (SELECT question_uid, i, unnest(x.headers) AS v, generate_subscripts(x.headers, 1) - 1 AS j FROM t),
r AS (SELECT question_uid, i, unnest(x.rows) AS y, generate_subscripts(x.rows, 1) - 1 AS j FROM t),
c AS (SELECT question_uid, i, j, unnest(y) AS v, generate_subscripts(y, 1) - 1 AS k FROM r),
g AS (SELECT question_uid, unnest(images) AS x, generate_subscripts(images, 1) - 1 AS i FROM questions),
b AS (SELECT question_uid, i, unnest(x.bbox) AS v, generate_subscripts(x.bbox, 1) - 1 AS j FROM g),
n AS (SELECT question_uid, i, unnest(x.figure_data.nodes) AS y, generate_subscripts(x.figure_data.nodes, 1) - 1 AS j FROM g),
l AS (SELECT question_uid, i, j, unnest(y.links) AS z, generate_subscripts(y.links, 1) - 1 AS k FROM n),
m AS (SELECT question_uid, unnest(map_entries(metadata)) AS e FROM questions)
"""

ORACLE = {
    "p5_nodes": _LEAVES
    + """SELECT question_uid, level, parent_node, node, CAST(ordinal AS INT) AS ordinal FROM (
SELECT question_uid, 'tables' AS level, '' AS parent_node, 'tables[' || i || ']' AS node, i AS ordinal FROM t
UNION ALL SELECT question_uid, 'tables.headers', 'tables[' || i || ']', 'tables[' || i || '].headers[' || j || ']', j FROM h
UNION ALL SELECT question_uid, 'tables.rows', 'tables[' || i || ']', 'tables[' || i || '].rows[' || j || ']', j FROM r
UNION ALL SELECT question_uid, 'tables.rows.items', 'tables[' || i || '].rows[' || j || ']', 'tables[' || i || '].rows[' || j || '][' || k || ']', k FROM c
UNION ALL SELECT question_uid, 'images', '', 'images[' || i || ']', i FROM g
UNION ALL SELECT question_uid, 'images.bbox', 'images[' || i || ']', 'images[' || i || '].bbox[' || j || ']', j FROM b
UNION ALL SELECT question_uid, 'images.figure_data.nodes', 'images[' || i || ']', 'images[' || i || '].figure_data.nodes[' || j || ']', j FROM n
UNION ALL SELECT question_uid, 'images.figure_data.nodes.links', 'images[' || i || '].figure_data.nodes[' || j || ']', 'images[' || i || '].figure_data.nodes[' || j || '].links[' || k || ']', k FROM l
UNION ALL SELECT question_uid, 'metadata', '', 'metadata[' || e.key || ']', o FROM (SELECT question_uid, unnest(map_entries(metadata)) AS e, generate_subscripts(map_entries(metadata), 1) - 1 AS o FROM questions))""",
    "p3_found": _P3 + "SELECT entity_kind, entity_id, attr_name, arg_max(v, (coalesce(recorded_at, TIMESTAMP '0001-01-01'), row_id)) AS attr_value FROM parsed WHERE v IS NOT NULL GROUP BY 1, 2, 3",
    "p5_found": _LEAVES
    + """SELECT question_uid, node_path, node_value FROM (
SELECT question_uid, 'tables[' || i || '].headers[' || j || ']' AS node_path, v AS node_value FROM h
UNION ALL SELECT question_uid, 'tables[' || i || '].rows[' || j || '][' || k || ']', v FROM c
UNION ALL SELECT question_uid, 'images[' || i || '].type', x.type FROM g
UNION ALL SELECT question_uid, 'images[' || i || '].description', x.description FROM g
UNION ALL SELECT question_uid, 'images[' || i || '].figure_data.caption', x.figure_data.caption FROM g
UNION ALL SELECT question_uid, 'images[' || i || '].bbox[' || j || ']', CAST(v AS VARCHAR) FROM b
UNION ALL SELECT question_uid, 'images[' || i || '].figure_data.nodes[' || j || '].label', y.label FROM n
UNION ALL SELECT question_uid, 'images[' || i || '].figure_data.nodes[' || j || '].links[' || k || '].target', z.target FROM l
UNION ALL SELECT question_uid, 'images[' || i || '].figure_data.nodes[' || j || '].links[' || k || '].weight', z.weight FROM l
UNION ALL SELECT question_uid, 'metadata[' || e.key || ']', e.value FROM m) WHERE node_value IS NOT NULL""",
}
