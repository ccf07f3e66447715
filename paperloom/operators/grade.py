"""Answer keys, marks, selections and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def answer_key(answer: Column) -> Column:
    """Sorted labels: first letters of the elements of a JSON array (repeats
    kept), or the distinct letters A to H of any other text; '' for null."""
    items = F.from_json(F.when(answer.rlike(r"(?s)^\s*\[.*\]\s*$") & F.try_parse_json(answer).isNotNull(), answer), "array<string>")
    array_key = F.array_join(F.sort_array(F.transform(items, lambda x: F.upper(F.substring(strip(x), 1, 1)))), ",")
    text_key = F.array_join(F.sort_array(F.array_distinct(F.regexp_extract_all(answer, F.lit("([A-H])"), F.lit(1)))), ",")
    return F.coalesce(F.when(items.isNotNull(), array_key), text_key, F.lit(""))


def leading_number(text: Column, default: float) -> Column:
    """The number a text starts with; ``default`` for none and for zero."""
    return F.coalesce(F.nullif(F.regexp_extract(text, _NUMBER, 1).try_cast("double"), F.lit(0.0)), F.lit(default))


def last_click(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """clicks: keys, label, ts, seq. The label clicked last."""
    return clicks.groupBy(*keys).agg(F.max_by("label", F.struct("ts", "seq")).alias("selected"))


def toggled(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """Labels clicked an odd number of times, sorted; '' for none."""
    each = clicks.groupBy(*keys, "label").agg((F.count("*") % 2 == 1).alias("on"))
    return each.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(F.when(F.col("on"), F.col("label")))), ",").alias("selected"))


def within_deadline(events: DataFrame, key: str, ts: str, minutes: int = 90) -> DataFrame:
    """Events at most ``minutes`` after the first event of their key."""
    start = events.groupBy(key).agg(F.min(ts).alias("_start"))
    return events.join(start, key).filter(F.col(ts) <= F.col("_start") + F.expr(f"INTERVAL {minutes} MINUTES")).drop("_start")


def graded(responses: DataFrame, key: DataFrame, on: str) -> DataFrame:
    """responses LEFT JOIN key (``answer_key``, ``c_marks``, ``n_marks``):
    adds ``status`` and ``score``. Nothing selected scores 0; a selection
    that isn't the key, or meets an empty key, loses the negative marks."""
    j = responses.join(key, on, "left")
    empty = F.coalesce("selected", F.lit("")) == ""
    right = (F.col("selected") == F.col("answer_key")) & (F.col("answer_key") != "")
    status = F.when(empty, "unanswered").when(right, "correct").otherwise("wrong")
    c, n = F.coalesce("c_marks", F.lit(1.0)), F.coalesce("n_marks", F.lit(0.0))
    return j.withColumn("status", status).withColumn("score", F.when(empty, 0.0).when(right, c).otherwise(-n))


def totals(rows: DataFrame, by: list[str]) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    return rows.groupBy(*by).agg(F.sum("score").alias("score"), n("correct").alias("n_correct"), n("wrong").alias("n_wrong"), n("unanswered").alias("n_unanswered"))


def short_answer(kind: Column, answer: Column, expected: Column, low: Column, high: Column, ignore_case: Column) -> Column:
    """Equal, Set or Range match of a short answer."""
    a = F.when(ignore_case, F.lower(strip(answer))).otherwise(strip(answer))
    e = F.when(ignore_case, F.transform(expected, lambda x: F.lower(strip(x)))).otherwise(F.transform(expected, strip))
    number = a.try_cast("double")
    return F.when(kind == "Range", number.between(low, high)).when(kind == "Set", F.array_contains(e, a)).otherwise(F.get(e, 0) == a)
