import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listing_analytics.functions import text as tx

quick = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
plain = st.text(alphabet=st.sampled_from("abzAZéßñ0129 /-&'\t\n\\|_., "), max_size=30)


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").collect()]


@quick
@given(st.lists(plain, min_size=40, max_size=40))
def test_title_case_is_python_title(spark, values):
    assert run(spark, values, tx.title_case) == [v.strip().title() for v in values]


def test_title_case_fixture(spark):
    assert run(spark, [" digital counterfeit items IDs/DLs "], tx.title_case) == ["Digital Counterfeit Items Ids/Dls"]


def normal(v):
    v = " ".join(p for p in v.split("\n") if p)
    v = " ".join(p for p in v.split(" ") if p)
    return v.lower().replace("\t", "").replace("\\", "").strip()


@quick
@given(st.lists(plain, min_size=40, max_size=40))
def test_normalise_text(spark, values):
    assert run(spark, values, tx.normalise_text) == [normal(v) for v in values]


def test_normalise_text_fixture(spark):
    assert run(spark, ["A\tB  c\\d\n\n E"], tx.normalise_text) == ["ab cd e"]


@quick
@given(st.lists(st.text(alphabet="0123456789ab ,.|", max_size=15), min_size=40, max_size=40))
def test_numbers(spark, values):
    first = [re.search(r"[0-9]+", v) for v in values]
    assert run(spark, values, tx.first_integer) == [float(m.group()) if m else None for m in first]
    digits = ["".join(re.findall(r"[0-9]", v)) for v in values]
    assert run(spark, values, tx.all_digits) == [int(d) if d else 0 for d in digits]
    assert run(spark, values, tx.digit_sum) == [sum(map(int, d)) for d in digits]


@quick
@given(st.lists(plain, min_size=40, max_size=40))
def test_tokens_and_words(spark, values):
    assert run(spark, values, tx.tokens) == [re.findall(r"(?u)\b\w\w+\b", v.lower()) for v in values]
    assert run(spark, values, tx.words) == [v.split() for v in values]
    assert run(spark, values, tx.strip) == [v.strip() for v in values]


def test_edge_rows(spark):
    assert run(spark, ["12", "3|45", "0", "a| 7 ", "x"], tx.last_number) == [12, 45, 0, 7, None]
    assert run(spark, ["5 stars", "2/5", "10/10", ""], tx.star_to_sentiment) == ["positive", "negative", "negative", None]
    assert run(spark, ["12.50", "1,234", "abc"], tx.first_integer) == [12.0, 1.0, None]
    assert run(spark, ["out of 5", "1 of 10", ""], tx.all_digits) == [5, 110, 0]
    assert run(spark, ["Feedback 12 of 30", "none"], tx.first_number_word) == ["12", None]
    assert run(spark, ["User hasn't filled in this info", "hi"], tx.blank_placeholder) == ["", "hi"]
    assert run(spark, [None], lambda c: tx.listing_text(F.lit("x"), c)) == ["No description available"]
