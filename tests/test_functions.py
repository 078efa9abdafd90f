"""Scalar functions."""

import itertools

import pytest
from pyspark.sql import functions as F

from jobstrata.functions.html import visible, visible_text
from jobstrata.functions.text import instant, norm_id, norm_sha, sql_literal, strip
from jobstrata.functions.urls import url_job_key, url_match_keys

UUID = "0A1b2c3d-1111-2222-3333-444455556666"


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_ids_and_names(spark):
    got = column(spark, [" {AbC} ", "{}", "", None, "\t0012\n", " x​"], norm_id)
    assert got == ["abc", None, None, None, "0012", "x"]
    assert column(spark, [" AB c\n", "  ", None], norm_sha) == ["abc", None, None]
    assert column(spark, [" a b\t", "", None], strip) == ["a b", "", None]


def test_instants_of_all_forms_are_equal(spark):
    same = ["2025-01-07T11:38:30Z", "2025-01-07T13:38:30+02:00", "2025-01-07 11:38:30 UTC", "2025-01-07T11:38:30.000Z",
            "2025-01-07T06:38:30-05:00", "2025-01-07 11:38:30", " 1736249910 "]
    got = column(spark, same + ["", None, "soon"], instant)
    assert len(set(got[:7])) == 1 and got[0] is not None
    assert got[7:] == [None, None, None]


def test_sql_literals(spark):
    assert column(spark, [None, "", "it's", "a\nb"], sql_literal) == ["NULL", "''", "'it''s'", "'a\nb'"]


@pytest.mark.parametrize("url, key", [
    (f"https://x.test/a/{UUID}/apply", UUID), ("https://x.test/job/1234567-abc", "1234567"), ("https://x.test/jobs/7654321", "7654321"),
    ("https://x.test/p/123456789012345", "123456789012345"), ("https://x.test/jobs/1234/job", "1234"), ("https://x.test/p/12345678", "12345678"),
    ("https://x.test/en/JR123/x", "JR123"), ("https://x.test/R-99/x", "R-99"), ("https://x.test/REQ_ab1/x", "REQ_ab1"), ("https://x.test/req-7", "req-7"), ("https://x.test/r-123?a", "r-123"),
    ("https://x.test/search/1234567890x", "1234567890"), ("https://x.test/a/apply/", "apply"), ("https://x.test/a/b;p=1?q=2#f", "b"),
    ("https://x.test", "https://x.test"), ("https://x.test/a b|c", "a b|c"), ("mailto:me", "me"),
])
def test_job_key_rules(spark, url, key):
    assert column(spark, [url], url_job_key) == [key]


def test_job_key_of_nothing(spark):
    assert column(spark, ["", None], url_job_key) == [None, None]
    assert column(spark, ["", None], url_match_keys) == [[], []]


def test_match_keys_equal_the_pairwise_rule(spark):
    urls = ["https://a.test/jobs/1/apply", "https://a.test/jobs/2/apply/", f"https://b.test/{UUID}", f"https://c.test/x/{UUID}//",
            "https://d.test/abc", "https://e.test/abc", "https://d.test/abc/", "https://f.test/job/1234567", "https://g.test/jobs/1234567/x", "https://h.test"]
    keys = dict(zip(urls, column(spark, urls, url_job_key)))
    sets = dict(zip(urls, column(spark, urls, url_match_keys)))
    for a, b in itertools.product(urls, urls):
        rule = a.rstrip("/") == b.rstrip("/") or (keys[a] == keys[b] and len(keys[a]) >= 4)
        assert bool(set(sets[a]) & set(sets[b])) == rule, (a, b)


@pytest.mark.parametrize("markup, text", [
    ("<p>a<b>x</b></p>", "a\nx"), ("<nav>hid<p>den", ""), ("</nav>shown", "shown"), ("<div><script>var x='</p>'</script>a</div>", "a"),
    ("<NAV>x</NAV>y", "y"), ("<nav><nav>x</nav>y</nav>z", "z"), ("a<!-- c -->b", "a\nb"), ("<iframe/>x", "x"),
    ("<p>&amp; &copy; &lt;</p>", "& © <"), ("<p> a b </p>", "a b"), ("<p>AT&T", ""), ("", ""), (None, ""),
])
def test_visible_text(markup, text):
    assert visible(markup) == text


def test_visible_text_column(spark):
    assert column(spark, ["<p>a</p>", None, "x" * 100_000], visible_text) == ["a", "", "x" * 100_000]
