import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogue_enrich.functions.encoding import base_name, data_url, join_path, ledger_line
from catalogue_enrich.functions.geometry import thumbnail_size
from catalogue_enrich.functions.json_text import json_string
from catalogue_enrich.functions.pyformat import py_dict, py_repr, render
from catalogue_enrich.functions.response import is_unresolved, parse_response

TEXTS = [
    "plain", "it's", 'say "x"', "both ' and \"", "back\\slash", "a\nb\r\tc", "nbsp x", "zero​width",
    "ü€😀", "\x00\x1f\x7f", "{target_group}", "", "line sep", "private", "soft­hyphen", "\U000e0001",
]


def column(spark, values, expression, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[1] for r in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_repr(spark):
    assert column(spark, TEXTS, py_repr) == [repr(t) for t in TEXTS]
    assert column(spark, [None], py_repr) == ["None"]


@settings(max_examples=15, deadline=None)
# Up to the Cyrillic block: which later code points are assigned differs between the JVM
# and the Python at hand.
@given(st.lists(st.text(st.characters(max_codepoint=0x52F, exclude_categories=["Cs", "Cn"])), max_size=20))
def test_repr_of_any_text(spark, texts):
    assert column(spark, texts, py_repr) == [repr(t) for t in texts]
    assert [json.loads(t) for t in column(spark, texts, json_string)] == texts


def test_dict(spark):
    dicts = [{"a": "it's", "b": None}, {}, {None: "x"}]
    values = [[(k, v) for k, v in d.items()] for d in dicts] + [None]
    got = column(spark, values, py_dict, "v array<struct<id:string,label:string>>")
    assert got == [str(d) for d in dicts] + ["None"]


def test_template(spark):
    template = "{{x}} {a}/{b!r}{a}"
    row = spark.createDataFrame([("{b}", "it's"), (None, None)], "a string, b string")
    got = [r[0] for r in row.select(render(template, {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == [template.format(a="{b}", b="it's"), template.format(a=None, b=None)]


@pytest.mark.parametrize("template", ["{nope}", "{}", "{0}", "{a.b}", "{a[0]}"])
def test_template_with_an_unknown_field(spark, template):
    with pytest.raises(KeyError):
        render(template, {"a": F.lit("x")})


def test_template_with_a_format(spark):
    with pytest.raises(ValueError):
        render("{a:>10}", {"a": F.lit("x")})


def expected_response(text):
    if text is None:
        return "error", None
    try:
        root = json.loads(text)
    except json.JSONDecodeError:
        return "raw", text
    if not isinstance(root, dict):
        return "error", None
    return ("value", root["response"]) if "response" in root else ("raw", text)


ANSWERS = [
    '{"response": "kiste"}', '{"response": ["#ff0000", "#00ff00"]}', '{"response": null}', "not json",
    '{"answer": "x"}', "[1]", '"x"', "5", "null", "true", None, '{"response": "None"}', "", " ", "{}",
    ' {"response": "a"} \n', '{"response": "a"} x', '{"response": "a"}, {"response": "b"}', '{"response": "a"}]',
    '{"response": "a"}}', "]", "}", "1], [2", '1}, {"v": 2', '{"response": "a", "response": "b"}', "{'response': 1}",
    '{"response": "a\tb"}', '{"response": "ü \\u00fc \\" \\n"}', '{"response": {"b": 1, "a": [null]}}',
    '{"response": 5}', '{"response": true}', '{"response": []}', '{"response": "x",}', '\ufeff{"response": "x"}',
    "1, 2", '1, "y": 2', '{"response": "nach ] und } x"}', "it's \"quoted\" \\ text",
]


def test_response(spark):
    got = column(spark, ANSWERS, parse_response)
    for text, row in zip(ANSWERS, got):
        kind, value = expected_response(text)
        assert row["kind"] == kind, text
        if kind == "error":
            assert row["result_json"] is None and row["result"] is None
        else:
            assert json.loads(row["result_json"]) == value, text
        if isinstance(value, str):
            assert row["result"] == value and row["result_list"] is None
        if isinstance(value, list):
            assert row["result_list"] == value and row["result"] is None


WORDS = st.text(st.characters(exclude_categories=["Cs"]), max_size=6)
NUMBERS = st.integers(-(10**20), 10**20) | st.floats(allow_nan=False, allow_infinity=False)
LEAVES = st.none() | st.booleans() | NUMBERS | WORDS
VALUES = st.recursive(LEAVES, lambda v: st.lists(v, max_size=3) | st.dictionaries(WORDS, v, max_size=3), max_leaves=5)
ROOTS = VALUES | st.fixed_dictionaries({"response": VALUES}, optional={"more": VALUES})
AROUND = st.sampled_from(["", "", "", " ", "\n", "x", "}", "]", ",", "{", "[", '"', "1", ", 1", ': 1', "], [2", '}, {"v": 1'])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(AROUND, ROOTS, AROUND), min_size=20, max_size=60))
def test_response_like_a_json_parser(spark, cases):
    texts = [before + json.dumps(root) + after for before, root, after in cases]
    for text, row in zip(texts, column(spark, texts, parse_response)):
        kind, value = expected_response(text)
        assert row["kind"] == kind, text
        assert (row["result_json"] and json.loads(row["result_json"])) == value, text


def test_unresolved(spark):
    values = ["null", '"None"', None, '"none"', '["None"]', '"x"']
    assert column(spark, values, is_unresolved) == [True, True, True, False, False, False]


def thumbnail(width, height, box=500):
    if width <= box and height <= box:
        return width, height
    aspect = width / height

    def closest(exact, error):
        return max(min((int(exact), -int(-exact // 1)), key=error), 1)

    if aspect > 1:
        return box, closest(box / aspect, lambda n: abs(aspect - box / n) if n else 0)
    return closest(box * aspect, lambda n: abs(aspect - n / box)), box


def test_thumbnail(spark):
    sizes = [(1000, 400), (30, 40), (500, 500), (5000, 3), (3, 5000), (501, 500), (1600, 1067), (640, 481)]
    sizes += [(w, h) for w in range(499, 1500, 67) for h in range(499, 1500, 59)]
    rows = spark.createDataFrame(sizes, "w int, h int")
    got = rows.select("w", "h", thumbnail_size(F.col("w"), F.col("h")).alias("o")).collect()
    assert [tuple(r["o"]) for r in got] == [thumbnail(r["w"], r["h"]) for r in got]
    assert thumbnail(1000, 400) == (500, 200) and thumbnail(5000, 3) == (500, 1)


def test_data_url_is_one_line(spark):
    url = column(spark, [bytearray(b"x" * 500)], data_url, "v binary")[0]
    assert url.startswith("data:image/jpeg;base64,eHh4") and "\n" not in url and "\r" not in url


def test_names(spark):
    assert column(spark, ["/a/b.json", "b", "a\\b\\c.json", "a/"], base_name) == ["b.json", "b", "c.json", ""]
    parts = [("in/", "a.json"), ("in", "a.json"), ("in", "/a"), ("", "a"), ("in\\x", "a")]
    rows = spark.createDataFrame(parts, "a string, b string")
    got = [r[0] for r in rows.select(join_path(F.col("a"), F.col("b"))).collect()]
    assert got == ["in/a.json", "in/a.json", "/a", "a", "in/x/a"]
    line = spark.range(1).select(ledger_line(F.lit("7"), F.lit(None), F.lit("u,v"))).first()[0]
    assert line == "7,None,u,v"
