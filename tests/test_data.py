"""Packed fields, attribute pivots and nested records."""

import datetime as dt

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.operators import fields, flatten, pivot


@pytest.mark.parametrize(
    ("field", "options", "want"),
    [
        ("a, c | g;h", None, ["a", "c", "g", "h"]),
        ('"the ""odd"" one",two', None, ['the "odd" one', "two"]),
        ("['the \"odd\" one', 'two']", None, ['the "odd" one', "two"]),
        ('["a \\"b\\" c", "d"]', None, ['a "b" c', "d"]),
        ("47,937", None, ["47,937"]),
        ("19,314", ["19", "314"], ["19", "314"]),
        ("33/18", ["33", "18"], ["33", "18"]),
        ("0.4 or 2/5", None, ["0.4", "2/5"]),
        ("3 m/s/4 m/s", None, ["3 m/s", "4 m/s"]),
        ("only x and y are z", ["only x and y are z"], ["only x and y are z"]),
        ("only x and y are z and w", ["only x and y are z", "w"], ["only x and y are z", "w"]),
        ("“B”;“D”", None, ["B", "D"]),
        ("B C A", None, ["B", "C", "A"]),
        ("A  C", None, ["A", "C"]),
        (" ;; ", None, []),
        ("b ; ; c", None, ["b", "c"]),
        ("{x;y}", None, ["x", "y"]),
        ("(a), (b)", None, ["a", "b"]),
        ("it's 5", None, ["it's 5"]),
        ("b; 'c, d'", None, ["b", "c, d"]),
        ("x, 'a, b', z", None, ["x", "a, b", "z"]),
        ("‘a’, ‘b, c’", None, ["a", "b, c"]),
        ("«a, b»; c", None, ["a, b", "c"]),
        ("“a”, “b, c”", None, ["a", "b, c"]),
        ("f(x, y); g", None, ["f(x, y)", "g"]),
        ("(2, 3); (4, 5)", None, ["2, 3", "4, 5"]),
        ("it's 5; it's 6", None, ["it's 5", "it's 6"]),
        ("don't; 'x; y'", None, ["don't", "x; y"]),
        ('5" pipe, 6" pipe', None, ['5" pipe', '6" pipe']),
        ('"a, b", c, "the ""odd"" one"', None, ["a, b", "c", 'the "odd" one']),
        ('"""odd"", one"; ""; b', None, ['"odd", one', "b"]),
        ("grey stone,", ["grey stone", "slate"], ["grey stone"]),
        ("", None, []),
        (None, None, []),
        ("x" * 100_000 + ";y", None, ["x" * 100_000, "y"]),
    ],
)
def test_split(field, options, want):
    got = fields.split_values(pa.array(["47,937", field, "5"], pa.string()), pa.array([None, options, None], pa.list_(pa.string())))
    assert got.to_pylist() == [["47,937"], want, ["5"]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("abcxyz é漢", min_size=1, max_size=8).map(str.strip).filter(lambda s: len(s) > 1 and "  " not in s and " or " not in s), min_size=1, max_size=5), min_size=1, max_size=6), st.sampled_from([";", "|", "、", ", "]))
def test_split_round_trip(rows, sep):
    assert fields.split_values(pa.array([sep.join(r) for r in rows])).to_pylist() == rows


def test_split_frame(spark):
    df = spark.createDataFrame([(1, "a;b", ["a"], "x"), (2, None, None, "y"), (3, " ", [], "z"), (3, "c", None, "z"), (4, ";", None, "w")], "u long, f string, o array<string>, pos string")
    got = sorted(map(tuple, fields.split_packed_field(df, "u", "f", "o").collect()))
    assert got == [(1, 0, "a"), (1, 1, "b"), (3, 0, "c")]
    assert fields.split_packed_field(df.limit(0), "u", "f").count() == 0


ATTRIBUTES = [pivot.Attribute("Correct Marks", "decimal"), pivot.Attribute("Think Time", "int"), pivot.Attribute("Paper Date", "date"), pivot.Attribute("Option Shuffling", "bool"), pivot.Attribute("Label", "text")]


@pytest.mark.parametrize(
    ("name", "value", "want"),
    [
        ("correct_marks", "+01,50 Marks.", ("Correct Marks", "1.5")),
        ("Corect Marks", ".25", ("Correct Marks", "0.25")),
        ("Correct aMrks", "-0.0", ("Correct Marks", "0")),
        ("correctMarks:", "-1", ("Correct Marks", "-1")),
        ("Think Time", "007 sec", ("Think Time", "7")),
        ("Think Time", "1.0", ("Think Time", "1")),
        ("Think Time", "1.5", None),
        ("Think Time", "as printed", None),
        ("Paper Date", "3 December 2031", ("Paper Date", "2031-12-03")),
        ("Paper Date", "December 3, 2031", ("Paper Date", "2031-12-03")),
        ("Paper Date", "03-Dec-2031", ("Paper Date", "2031-12-03")),
        ("Paper Date", "20311203", ("Paper Date", "2031-12-03")),
        ("Paper Date", "2031/12/03", ("Paper Date", "2031-12-03")),
        ("Paper Date", "2031-12-03 10:00:00", ("Paper Date", "2031-12-03")),
        ("Paper Date", "2031-02-30", None),
        ("Option Shuffling", " Y ", ("Option Shuffling", "true")),
        ("Label", " Part A\n", ("Label", "Part A")),
        ("Label", "n/a", None),
        ("Shelf", "1", None),
        (None, "1", None),
        ("Label", None, None),
    ],
)
def test_pivot_value(spark, name, value, want):
    df = spark.createDataFrame([("q", 1, name, value, dt.datetime(2030, 1, 1), 1, "clash")], "entity_kind string, entity_id long, attr_name string, attr_value string, recorded_at timestamp, row_id long, attr string")
    wide = pivot.pivot_wide(pivot.latest_values(df, ATTRIBUTES, ["entity_kind", "entity_id"]), ATTRIBUTES, ["entity_kind", "entity_id"], typed=False)
    got = [tuple(r)[2:] for r in pivot.melt(wide, ATTRIBUTES, ["entity_kind", "entity_id"]).collect()]
    assert got == ([want] if want else [])
    assert wide.count() == 1


def test_pivot_latest_and_empty(spark):
    t = lambda d: dt.datetime(2030, 1, d)
    rows = [("q", 1, "Label", "old", t(1), 1), ("q", 1, "Label", "new", t(3), 2), ("q", 1, "label", "NA", t(4), 3), ("q", 1, "Label", "tie", t(3), 5), ("q", 1, "Label", "none", None, 9), ("q", None, "Label", "x", t(1), 7)]
    df = spark.createDataFrame(rows, "entity_kind string, entity_id long, attr_name string, attr_value string, recorded_at timestamp, row_id long")
    wide = pivot.pivot_wide(pivot.latest_values(df, ATTRIBUTES, ["entity_kind", "entity_id"]), ATTRIBUTES, ["entity_kind", "entity_id"])
    assert [r["Label"] for r in wide.collect()] == ["tie"]
    assert dict(wide.dtypes)["Paper Date"] == "date"
    none = pivot.latest_values(df.limit(0), ATTRIBUTES, ["entity_kind", "entity_id"])
    assert pivot.pivot_wide(none, ATTRIBUTES, ["entity_kind", "entity_id"]).count() == 0
    found = {r.attr_key: (r.attr_name, r.value_type) for r in pivot.discover_attributes(df).collect()}
    assert found["label"] == ("Label", "text")


def leaves(x, path):
    if x is None:
        return
    if isinstance(x, dict):
        for k, v in x.items():
            yield from leaves(v, f"{path}.{k}")
    elif isinstance(x, list):
        for i, v in enumerate(x):
            yield from leaves(v, f"{path}[{i}]")
    else:
        yield path, str(x)


def test_flatten(spark):
    schema = "u long, a array<struct<h: array<string>, n: struct<c: string, d: array<array<double>>>>>, m map<string,string>, node string"
    rows = [
        (1, [{"h": ["x", None, ""], "n": {"c": "cap", "d": [[1.0, None], [], None]}}, None, {"h": None, "n": None}], {"k 1": "v", "z": None}, "clash"),
        (2, [], {}, None), (3, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    tables = flatten.normalise(df, "u", ["a", "m"])
    got = sorted((r[1], r[2]) for r in flatten.leaf_rows(tables).collect())
    want = sorted([*leaves(rows[0][1], "a"), ("m[k 1]", "v")])
    assert got == want
    by = {t.path: t for t in tables}
    assert by["a.n.d"].parent == "a" and by["a.n.d.items"].parent == "a.n.d"
    parents = {r.node for r in by["a"].rows.collect()}
    assert {r.parent_node for r in by["a.n.d"].rows.collect()} <= parents
    assert by["a"].rows.count() == 3
    assert flatten.leaf_rows(flatten.normalise(df.limit(0), "u", ["a", "m"])).count() == 0


def test_merged_schema(spark):
    df = spark.createDataFrame([(1, '{"a": [{"b": 1}]}'), (2, '{"a": [{"c": "x"}], "d": true}'), (3, "no json"), (4, None)], "u long, j string")
    parsed = flatten.parse_merged(df.filter("u < 3"), "j")
    got = sorted((r[0], r[1], r[2]) for r in flatten.leaf_rows(flatten.normalise(parsed, "u", ["j"])).collect())
    assert got == [(1, "j.a[0].b", "1"), (2, "j.a[0].c", "x"), (2, "j.d", "true")]
