"""Tag balance by windows against the stack of the message validators."""

from __future__ import annotations

import random

import pytest

from spanloom.functions import xmlcalls
from spanloom.operators import quality

HAND = [
    None, "", "no tag", "<", "<<", "a < b > c", "<a>", "</a>", "</a><a>", "<a></b>", "<a><b></a></b>", "</a></a><b></b>", "<br><IMG src='x'></br>", "<x/>", "<x />", "</x/>", "<a b='<c>'></a>",
    "<a <b></a>", "<a", "<a ", "<!-- <a> --><b></b>", "<!-- <a>", "<!--><a>", "<!--<!--x--><a>-->", "<a><!-- > -->", "<工具>x</工具>", "<a b>", "<a:b-c_1>\n</a:b-c_1>", "<1></1>", "<a\t/>", "\U0001f600<a>\U0001f600</b>", "<a>>", "x --> <a>", "<é>", "<aé>",
]
PARTS = ["<a>", "</a>", "<b>", "</b>", "<br>", "</br>", "<c/>", "<c />", "<d x='1'>", "</d>", "<!--", "-->", "<", ">", " ", "/", "text", "<a ", "\n", "工", "<工>", "</工>", " "]


@pytest.mark.parametrize("strict", [True, False])
def test_windows_find_what_the_stack_finds(spark, strict):
    draw = random.Random(11)
    texts = HAND + ["".join(draw.choices(PARTS, k=draw.randrange(1, 40))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: (r.n_errors, r.errors) for r in quality.tag_balance(df, "k", "t", strict).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = xmlcalls.tag_errors(t or "", strict)
        assert got[k] == (len(want), want), t


def test_one_shuffle_and_no_python(spark):
    df = spark.createDataFrame([(1, "<a>")], "k long, t string")
    plan = quality.tag_balance(df, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_long_texts(spark):
    """Deep nesting, and openers of tags and comments that never end: time in proportion to the length."""
    n = 100_000
    texts = ["<a>" * n + "</a>" * (n - 1), "</a>" * n, "<a " * n, "<!-- " * n, "<" * n, "<a " * n + ">", "<a x" * n + "<!--" * n]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: r.n_errors for r in quality.tag_balance(df, "k", "t").select("k", "n_errors").collect()}
    assert got == {0: 1, 1: n, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0}
    assert len(xmlcalls.tag_errors("<a x" * n)) == 0
