"""Entity-attribute-value rows into one typed row per entity.

The attribute list and its types come first (a dictionary table, or discovered
from the rows); names are matched to it with a tolerance for small slips. The
rows are then reduced to the latest readable value of each entity and
attribute (combined before the shuffle, so a hot entity costs no more than
any other) and pivoted with one conditional aggregate per attribute.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import letters_digits, strip

#: Spellings of a missing value and of the two booleans.
PLACEHOLDERS = ("", "-", "--", "?", "??", "n/a", "n.a.", "na", "nan", "nil", "none", "null")
TRUE = ("true", "t", "yes", "y", "1")
FALSE = ("false", "f", "no", "n", "0")
SQL_TYPES = {"int": "bigint", "decimal": "decimal(38,10)", "bool": "boolean", "date": "date", "text": "string"}
#: An attribute list longer than this is refused: it becomes columns.
MAX_ATTRIBUTES = 2_000


@dataclass(frozen=True)
class Attribute:
    name: str
    kind: str

    @property
    def key(self) -> str:
        return "".join(ch for ch in self.name.lower() if ch.isalnum())


def attribute_list(dictionary: DataFrame, name: str = "attr_name", kind: str = "value_type") -> list[Attribute]:
    """The attributes of a dictionary table, in order of name."""
    rows = dictionary.filter(F.col(name).isNotNull()).groupBy(name).agg(F.min(kind).alias("k")).limit(MAX_ATTRIBUTES + 1).collect()
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    return [Attribute(r[0], r[1] if r[1] in SQL_TYPES else "text") for r in sorted(rows)]


def discover_attributes(rows: DataFrame, name: str = "attr_name", value: str = "attr_value", share: float = 0.9, least: int = 2) -> DataFrame:
    """Attributes found in the rows: (attr_key, attr_name, value_type, n).

    Names that agree in letters and digits are one attribute, spelled as most
    rows spell it; its type is the narrowest that reads ``share`` of its
    values that aren't placeholders. One row per distinct key.
    """
    base = rows.select(letters_digits(F.col(name)).alias("attr_key"), strip(F.col(name)).alias("attr_name"), strip(F.col(value)).alias("s")).filter("attr_key <> ''")
    kinds = ("bool", "int", "decimal", "date")
    read = with_readings(base, "s")
    by_name = read.groupBy("attr_key", "attr_name").agg(F.count("*").alias("n"), F.count("v_text").alias("has"), *[F.count(f"v_{k}").alias(k) for k in kinds])
    each = by_name.groupBy("attr_key").agg(F.max(F.struct("n", "attr_name"))["attr_name"].alias("attr_name"), F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in ("has", *kinds)])
    enough = lambda k: (F.col("has") > 0) & (F.col(k) >= share * F.col("has"))
    kind = F.when(enough("bool"), "bool").when(enough("int"), "int").when(enough("decimal"), "decimal").when(enough("date"), "date").otherwise("text")
    return each.filter(F.col("n") >= least).select("attr_key", "attr_name", kind.alias("value_type"), "n")


def match_attribute(key: Column, attributes: list[Attribute]) -> Column:
    """Index into ``attributes``, or null. ``key``: letters and digits of the
    name. A name within one edit (two, or a swap, from eight letters on) of
    just one attribute is that attribute. The distances are computed only for
    names that aren't known."""
    exact = F.create_map(*[x for i, a in enumerate(attributes) for x in (F.lit(a.key), F.lit(i))])
    near = F.array_compact(F.array(*[F.when(F.levenshtein(key, F.lit(a.key), 2) >= 0, F.struct(F.levenshtein(key, F.lit(a.key), 2).alias("d"), F.lit(i).alias("i"))) for i, a in enumerate(attributes)]))
    slip = F.aggregate(
        F.filter(near, lambda x: (x["d"] <= 1) | (F.length(key) >= 8)),
        F.struct(F.lit(3).alias("d"), F.lit(-1).alias("i")),
        lambda acc, x: F.when(x["d"] < acc["d"], x).when(x["d"] == acc["d"], F.struct(acc["d"].alias("d"), F.lit(-1).alias("i"))).otherwise(acc),
        lambda acc: F.when(acc["i"] >= 0, acc["i"]),
    )
    return F.coalesce(F.try_element_at(exact, key), slip)


_UNIT = r"\s*(?:[\p{L}%°][\p{L}%°/]*\.?)?$"
_INT = r"^([+-]?\d+)(?:\.0*)?" + _UNIT
_DECIMAL = r"^([+-]?(?:\d+(?:[.,]\d*)?|[.,]\d+))" + _UNIT
_CLOCK = r"(?:[T ]+\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?Z?)?$"
#: Patterns of dates: pattern, parts in the order of the format.
_DIGIT_DATES = (
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _CLOCK, "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _CLOCK, "$3-$2-$1"),
)
_NAMED_DATES = (
    (r"^(\d{1,2})[-/. ]+([A-Za-z]{3})[a-z]{0,6}\.?[-/., ]+(\d{4})" + _CLOCK, "$2 $1 $3"),
    (r"^([A-Za-z]{3})[a-z]{0,6}\.?[-/. ]+(\d{1,2}),?[-/ ]+(\d{4})" + _CLOCK, "$1 $2 $3"),
)


def _number(n: Column) -> Column:
    """Without plus sign and superfluous zeros; "" gives null."""
    for pattern, by in ((",", "."), (r"^\+", ""), (r"^(-?)0+(?=\d)", "$1"), (r"^(-?)\.", "$10."), (r"(\.\d*?)0+$", "$1"), (r"\.$", ""), (r"^-0$", "0")):
        n = F.regexp_replace(n, pattern, by)
    return F.nullif(n, F.lit(""))


def _rewrite(s: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda c, p: c.when(s.rlike(p[0]), F.regexp_replace(s, *p)), patterns, F.when(F.lit(False), F.lit("")))


def readings(s: Column) -> dict[str, Column]:
    """By kind, the canonical spelling of a stripped value, or null if it
    can't be read as that kind."""
    low = F.lower(s)
    date = F.coalesce(F.try_to_date(_rewrite(s, _DIGIT_DATES), "y-M-d"), F.try_to_date(F.initcap(_rewrite(s, _NAMED_DATES)), "MMM d y"))
    return {
        "int": _number(F.regexp_extract(s, _INT, 1)),
        "decimal": _number(F.regexp_extract(s, _DECIMAL, 1)),
        "bool": F.when(low.isin(*TRUE), "true").when(low.isin(*FALSE), "false"),
        "date": F.date_format(date, "yyyy-MM-dd"),
        "text": F.when(~low.isin(*PLACEHOLDERS), s),
    }


def with_readings(df: DataFrame, stripped: str) -> DataFrame:
    """``df`` with a column v_<kind> for each kind."""
    return df.select("*", *[c.alias(f"v_{k}") for k, c in readings(F.col(stripped)).items()])


def latest_values(rows: DataFrame, attributes: list[Attribute], entity: list[str], name: str = "attr_name", value: str = "attr_value", when: str = "recorded_at", tie: str = "row_id") -> DataFrame:
    """(entity..., attr, v): the readable value of latest ``when`` for each
    entity and attribute; ``tie`` (the larger wins) decides between equals, a
    null ``when`` counts as the earliest. v is null where no value can be
    read; unknown attributes have attr -1; rows of null entities are dropped.

    There is no filter on computed columns: it would be pushed down and make
    the readings run twice.
    """
    base = rows.dropna(subset=entity).select(*entity, letters_digits(F.col(name)).alias("k"), strip(F.col(value)).alias("s"), F.col(when).alias("t"), F.col(tie).alias("r"))
    known = base.select(*entity, F.coalesce(match_attribute(F.col("k"), attributes), F.lit(-1)).alias("attr"), "s", "t", "r")
    own = {k: [i for i, a in enumerate(attributes) if a.kind == k] for k in SQL_TYPES}
    read = readings(F.col("s"))
    choose = reduce(lambda c, k: c.when(F.col("attr").isin(*own[k]), read[k]), [k for k in own if own[k]], F.when(F.lit(False), F.lit(None).cast("string")))
    best = F.when(F.col("v").isNotNull(), F.struct("t", "r", "v"))
    known = known.select(*entity, "attr", "t", "r", choose.alias("v")).select(*entity, "attr", best.alias("m"))
    latest = known.groupBy(*entity, "attr").agg(F.max("m").alias("m"))
    return latest.select(*entity, "attr", F.col("m.v").alias("v"))


def pivot_wide(latest: DataFrame, attributes: list[Attribute], entity: list[str], typed: bool = True) -> DataFrame:
    """One row per entity, one column per attribute (named as the attribute;
    null where the entity has no readable value).

    The reduced rows are hash-partitioned by entity first: at most one row per
    attribute is left of each entity, and the aggregates need no exchange.
    """
    latest = latest.repartition(*entity)
    one = [F.max(F.when(F.col("attr") == i, F.col("v"))).alias(f"a{i}") for i in range(len(attributes))]
    wide = latest.groupBy(*entity).agg(*one)
    cast = lambda i, a: F.col(f"a{i}").try_cast(SQL_TYPES[a.kind]) if typed else F.col(f"a{i}")
    return wide.select(*entity, *[cast(i, a).alias(a.name) for i, a in enumerate(attributes)])


def melt(wide: DataFrame, attributes: list[Attribute], entity: list[str], name: str = "attr_name", value: str = "attr_value") -> DataFrame:
    """The filled cells of a wide table of strings, one row each."""
    cells = F.array(*[F.struct(F.lit(a.name).alias(name), F.col(f"`{a.name}`").alias(value)) for a in attributes])
    return wide.select(*entity, F.inline(cells)).filter(F.col(value).isNotNull())
