"""FN-01 weight parser on the fixture values (FIXTURES.md F1)."""

import pytest

from jobtide.functions.scalar import parse_weight, to_number

CASES = [
    ("от 3 до 8", 5), ("от 4", 4), ("до 7", 1), ("", 1), ("abc", 1), ("-2", 1),
    ("99999", 10000), ("2.9", 2), ("1e3", 1000), ("от 20000", 20000), ("от 0", 0),
    ("nan", 1), ("inf", 1), ("1_000", 1000), (None, 1), ("5", 5), (" 7 ", 7),
    ("от  2  до  4", 3), ("до 7 и от 3", 1), ("ОТ 5", 1), ("0.5", 1), ("Infinity", 1),
    ("5d", 1), ("5f", 1), ("7D", 1), ("0x10p1", 1), ("\t8\n", 8),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_parse_weight(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_weight("s").alias("w")).first()["w"] == expected


def test_parse_weight_is_builtin(spark):
    df = spark.createDataFrame([("от 3 до 8",)], "s string").select(parse_weight("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("text,expected", [
    ("5", 5.0), (" 2.5\t", 2.5), ("-.5e1", -5.0), ("1_000", None), ("5d", None), ("7F", None), ("0x10p1", None),
    ("NAN", None), (" nan", None), ("", None), (None, None), ("1,5", None),
])
def test_to_number(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(to_number("s").alias("x")).first()["x"] == expected


# --- property test: every text is generated together with its weight -------------------------

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_n = st.integers(0, 30000)
_case = st.one_of(
    st.tuples(_n, _n).map(lambda p: (f"от {p[0]} до {p[1]}", sum(p) // 2)),
    _n.map(lambda n: (f"от {n}", n)),
    _n.map(lambda n: (f"до {n}", 1)),
    st.integers(1, 10000).flatmap(lambda n: st.sampled_from([(f"{n}", n), (f" {n}.75 ", n), (f"{n}e0", n)])),
    st.integers(10001, 10**9).map(lambda n: (f"{n}", 10000)),
    st.integers(-10**6, 0).map(lambda n: (f"{n}", 1)),
    st.sampled_from([(None, 1), ("", 1), ("abc", 1), ("nan", 1), ("-inf", 1), ("от", 1), ("до", 1), ("от x до 5", 1)]),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(_case, min_size=200, max_size=200))
def test_parse_weight_of_generated_texts(spark, cases):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, s string")
    got = {r["i"]: r["w"] for r in df.select("i", parse_weight("s").alias("w")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
