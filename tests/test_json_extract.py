"""G1-G4: JSON objects in free text, differential against the plain-Python contract."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from traitlens.constants import TRAIT_KEYS
from traitlens.functions.jsonx import count_json_objects, extract_json_objects


def contract(text):
    """The reference behaviour stated in Python: regex fragments + strict json.loads."""
    out = []
    for frag in re.findall(r"\{.*?\}", text, re.DOTALL):
        try:
            obj = json.loads(frag)
        except json.JSONDecodeError:
            continue
        if isinstance(obj, dict):
            out.append(obj)
    return out


def _render(v):
    if v is None:
        return None
    if isinstance(v, str):
        return v
    return json.dumps(v, separators=(",", ":"))


CORPUS = [
    'prose [{"category1":"셔츠","color":"흰색"},\n{"category1":\n"바지"}] prose',
    '{"a":{"b":1}}',
    '{"category1":"x}y"}',
    "{}",
    '{"category1":1,"color":true,"style":null}',
    '{"category1":["a","b"]}',
    "{'category1':'x'}",
    '{"category1":"x",}',
    '{category1:"x"}',
    '{"category1":01}',
    '{"category1":"\\q"}',
    '{/*c*/"category1":"x"}',
    '{"category1":"a\nb"}',
    '{"category1":"x","category1":"y"}',
    '{"Category1":"x"}',
    "no json",
    '{"category1":"x"',
    'two {"color":"red"} and {"color":"blue","occasion":"formal"} done',
]


def _spark_objects(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", extract_json_objects(F.col("t")).alias("o"), count_json_objects(F.col("t")).alias("n")).collect()
    return {r.i: ([tuple(o) for o in r.o], r.n) for r in rows}


def test_corpus_matches_contract(spark):
    got = _spark_objects(spark, CORPUS)
    for i, text in enumerate(CORPUS):
        expected = [tuple(_render(o.get(k)) for k in TRAIT_KEYS) for o in contract(text)]
        objs, n = got[i]
        assert objs == expected, text
        assert n == len(expected)


def test_nan_and_infinity_are_rejected(spark):
    # Python accepts bare NaN/Infinity; Spark would quote them.  Decision: invalid fragment.
    got = _spark_objects(spark, ['{"category1":NaN}', '{"category1":Infinity}'])
    assert got[0] == ([], 0) and got[1] == ([], 0)


def test_null_text_gives_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    r = df.select(extract_json_objects(F.col("t")).alias("o")).first()
    assert r.o is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_strings_match_contract(spark, seed):
    rnd = random.Random(seed)
    alphabet = ['{', '}', '"', "'", ",", ":", "\n", " ", "category1", "color", "x", "1", "[", "]", "true"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    # well-formed objects mixed in so that valid parses are frequent
    texts += [
        "pre " + json.dumps({"category1": rnd.choice(["a", "b"]), "color": rnd.choice(["r", "g"])}) + " post"
        for _ in range(50)
    ]
    got = _spark_objects(spark, texts)
    for i, text in enumerate(texts):
        if re.search(r"NaN|Infinity", text):
            continue
        expected = [tuple(_render(o.get(k)) for k in TRAIT_KEYS) for o in contract(text)]
        assert got[i][0] == expected, repr(text)


def test_overflowing_numbers_and_half_surrogates_make_a_fragment_invalid(spark):
    from pyspark.sql import functions as F

    from traitlens.functions.jsonx import extract_json_objects

    texts = ['{"color": 1e400}', '{"color": -1e400}', r'{"color": "\ud800"}', r'{"color": "\udc00 x"}', r'{"color": "\ud83d\ude00"}', '{"color": 1.50}', '{"color": "Infinity"}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [[o.color for o in r.o] for r in df.select(extract_json_objects(F.col("t"), ("color",)).alias("o")).collect()]
    assert got == [[], [], [], [], ["\U0001f600"], ["1.5"], ["Infinity"]]


def test_unclosed_braces_are_scanned_in_linear_time(spark):
    import time

    from traitlens.functions.jsonx import count_json_objects

    def seconds(text):
        df = spark.createDataFrame([(text,)], "t string").select(count_json_objects("t").alias("n"))
        started = time.time()
        return df.first().n, time.time() - started

    seconds("{}")
    assert seconds("{" * 1_000_000)[0] == 0
    half, whole = ("{" * n + '"a"}' + "{" * n + '{"a": 1}' + "{" * n for n in (500_000, 1_000_000))
    (n, first), (m, second) = seconds(half), seconds(whole)
    assert n == m == 0 and second < 20 and second < 4 * first + 2
    assert seconds('{"a": 1}' + "{" * 1_000_000)[0] == 1
