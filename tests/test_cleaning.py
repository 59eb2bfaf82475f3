import re

import pytest
from pyspark.sql import functions as F

from glotta.functions import text as fx
from glotta.operators.cleaning import clean_text, nonempty_cleaned, strip_wiki_trailers


def run(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", expression(F.col("t")).alias("o")).orderBy("i").collect()]


def test_pixels(spark):
    got = run(spark, fx.clean_pixels, ["200px|thumb", "300px", "12 px", "a1px2px|b", "1234pxx", "px|"])
    assert got == ["thumb", "", "12 px", "ab", "x", "px|"]


# The cleaning patterns that the expected values below come from.
def test_box_assign(spark):
    values = ["name = Ana rest", "a|b", "x =y z", "ñu=1 k", "a==b", "= b", "a  = b", "a=b=c"]
    want = [re.sub(r"\w+\s?=\s?\w*|\|", "", v) for v in values]
    assert run(spark, fx.clean_box_assign, values) == want


@pytest.mark.parametrize("letter", ["a", "é", "я", "漢", "9", "_"])
def test_long_words(spark, letter):
    values = [f"x {letter * n} y" for n in (39, 40, 41, 80)]
    assert run(spark, fx.remove_long_words, values) == [values[0], "x  y", "x  y", "x  y"]


def test_urls(spark):
    values = ["see http://foo.com/a?b#c now", "https://www.x.org.", "ftp://foo.com", "http://foo.comé/x", "http://foo"]
    # Fixed value: the URL pattern.
    pattern = (r"https?://(www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b"
               r"([-a-zA-Z0-9()@:%_+.~#?&/=]*)")
    assert run(spark, fx.remove_urls, values) == [re.sub(pattern, "", v) for v in values]


def test_order_of_rules(spark):
    # The assignment rule runs before the URL rule and takes the query string apart.
    values = ["http://foo.com/x?a=b tail", "100px|a=1|" + "w" * 45 + " http://a.io end"]
    assert run(spark, fx.clean, values) == ["http://foo.com/x? tail".replace("http://foo.com/x?", ""), "  end"]


def test_guarded_steps_equal_the_plain_chain(spark):
    values = ["plain", "", "10px|x", "a=b", "x|y", "http://a.bc/d", "é" * 40, "1px|k=v| https://q.rs " + "z" * 50, None]
    df = spark.createDataFrame([(v,) for v in values], "text string")
    assert clean_text(df).filter(~F.col("cleaned_text").eqNullSafe(fx.clean(F.col("text")))).count() == 0
    assert clean_text(df).count() == len(values)


def test_long_runs_are_linear(spark):
    # A run of 300,000 word characters or digits without a match must not take n^2 steps.
    assert [len(v) for v in run(spark, fx.clean_box_assign, ["w" * 300_000])] == [300_000]
    assert [len(v) for v in run(spark, fx.clean_pixels, ["7" * 300_000])] == [300_000]


def test_wiki_trailers_on_every_line(spark):
    df = spark.createDataFrame([("a\nCategoría: X\n* fr: Y\nb Category:Z",)], "text string")
    assert strip_wiki_trailers(df).first()["stripped_text"] == "a\n\n\nb "


def test_nonempty_cleaned(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "i int, cleaned_text string")
    assert [tuple(r) for r in nonempty_cleaned(df).collect()] == [(1, "a")]


def test_strip_ends(spark):
    assert run(spark, fx.strip_ends, ["\n\t a b  \n", "x"]) == ["a b", "x"]
