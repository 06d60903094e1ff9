"""Broken JSON: shapes with the only sensible reading, shapes without one, and every cut of a valid text."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lamina.functions import jsonx
from lamina.functions.jsonrepair import mend

BROKEN = [
    ('{"a": 1,}', {"a": 1}), ('{"a": [1, 2,],}', {"a": [1, 2]}), ('{"a" 1}', {"a": 1}), ('{"a": 1 "b": 2}', {"a": 1, "b": 2}), ('{"a": "x" "b": "y"}', {"a": "x", "b": "y"}),
    ('{"a": "x"\n"b": "y"}', {"a": "x", "b": "y"}), ('["a" "b" 3]', ["a", "b", 3]), ("{'a': 'b'}", {"a": "b"}), ("{'a': \"it's\"}", {"a": "it's"}),
    ("{a: 1, b_c: 'd'}", {"a": 1, "b_c": "d"}), ('{a: true, b: False, c: None, d: undefined, e: NaN}', {"a": True, "b": False, "c": None, "d": None, "e": None}), ('{“a”: “b”}', {"a": "b"}),
    ('{"a": "he said "yes" to it"}', {"a": 'he said "yes" to it'}), ('{"a": "line one\nline two\t"}', {"a": "line one\nline two\t"}), ('{"a": "c:\\dir\\q"}', {"a": "c:\\dir\\q"}), ('{"a": "\\x41\\\'"}', {"a": "A'"}),
    ('{"a": 1, "b": [1, 2', {"a": 1, "b": [1, 2]}), ('{"a": "cut of', {"a": "cut of"}), ('{"a": 1, "b', {"a": 1}), ('{"a": 1, "b":', {"a": 1, "b": None}), ('{"a": {"b": {"c": [{"d": 1', {"a": {"b": {"c": [{"d": 1}]}}}),
    ('{"a": [1, 2}', {"a": [1, 2]}), ('[{"a": 1, "b": 2]', [{"a": 1, "b": 2}]), ('{"a": 1]}', {"a": 1}), ('{"a": 1}}', {"a": 1}), ('{"a": , "b": 2}', {"a": None, "b": 2}), ('[1,,2]', [1, 2]),
    ('{"a": 1, // one\n "b": 2 /* two */, # three\n "c": 3}', {"a": 1, "b": 2, "c": 3}), ('Sure! Here it is:\n```json\n{"a": 1,}\n```\nAnything else?', {"a": 1}), ('```\n[1, 2\n```', [1, 2]),
    ('{"a": .5, "b": +1, "c": 1_000, "d": 0x1F, "e": 5., "f": 007}', {"a": 0.5, "b": 1, "c": 1000, "d": 31, "e": 5.0, "f": "007"}), ('{"a": some words, "b": 1}', {"a": "some words", "b": 1}), ('{"a" = 1, "b" => 2}', {"a": 1, "b": 2}),
    ('{"a": 12345678901234567890.10}', {"a": 12345678901234567890.10}), ('{"a": 1, "a": 2}', {"a": 2}), ('{"a" "b"}', {"a": "b"}), ('{"k": "v", "long": [{"x": 1,}, {"x": 2,},],}', {"k": "v", "long": [{"x": 1}, {"x": 2}]}), ("[True, False, None]", [True, False, None]),
]


@pytest.mark.parametrize("text,want", BROKEN)
def test_mended(text, want):
    assert json.loads(mend(text)) == want


@pytest.mark.parametrize("text", ["", "no", None, "{maybe}", '["a": 1]', "{: 1}", '{"a", "b"}'])
def test_no_reading(text):
    assert mend(text) is None


def value(r, depth=0):
    kind = r.randrange(7 if depth < 3 else 5)
    if kind == 5:
        return [value(r, depth + 1) for _ in range(r.randrange(4))]
    if kind == 6:
        return {r.choice(["a", "b c", "é", "key"]) + str(i): value(r, depth + 1) for i in range(r.randrange(4))}
    return [None, True, r.randrange(-99, 99), r.random(), r.choice(["", "x", "two words", "\u00e9\n\"q\" \\ end", "a: b, c", "// no", "{x]"])][kind]


def test_valid_stays():
    r = random.Random(1)
    for _ in range(1500):
        v = r.choice([[value(r)], {"k": value(r)}])
        assert json.loads(mend(json.dumps(v, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])))) == v


def test_every_cut_is_read():
    """A text that ends anywhere gives JSON, and every whole member before the cut."""
    r = random.Random(2)
    for _ in range(60):
        v = {"first": 1, "rest": value(r)}
        text = json.dumps(v, ensure_ascii=False)
        for n in range(1, len(text)):
            got = json.loads(mend(text[:n]))
            assert isinstance(got, dict) and (n <= len('{"first": 1,') or got["first"] == 1)


def test_linear_time_and_depth():
    assert mend('{"a": "' + "x" * 500_000) is not None
    assert mend("[" * 100_000) is None  # too deep for a reader
    assert mend('{"a": "' + 'q" z ' * 20_000 + '"}') is not None


def test_stage(spark):
    rows = [(0, '{"a": 1}', 9), (1, "{'a': 1", 9), (2, "no", 9), (3, None, 9)]
    df = spark.createDataFrame(rows, "id long, raw string, stage_id int")
    got = {r.id: (r.raw, r.stage) for r in jsonx.repair_stage(df, "raw").collect()}
    assert got == {0: ('{"a": 1}', "strict"), 1: ('{"a": 1}', "repaired"), 2: ("no", "failed"), 3: (None, "failed")}
    assert jsonx.repair_stage(df.filter(F.lit(False)), "raw").collect() == []
