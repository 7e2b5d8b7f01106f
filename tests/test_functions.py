from urllib.parse import urlsplit

import pytest

from postlake.functions import domain, lenient_int, strip_ws, word_count, ends_with_question
from postlake.functions import to_class

ODD_URLS = ["https://GitHub.com:443/x", "http://user:pw@h.com:80/p", "//host/x", "github.com/x",
            "http://[::1]:80", "http://[bad/x", " https://a.com", "", "HTTP://A.B", "a+b://x.y", "1http://x",
            "http:/x", "mailto:x@y", "http://x.com?y", "http://x.com#f", "\thttp://a\nb.com/", "http://[bad]/x",
            "https://m.example.com/en/1#top", "ftp://files.example.org:21/a"]


def python_domain(url):
    if not isinstance(url, str) or not url:
        return "no_url"
    try:
        return urlsplit(url).netloc.lower().split(":")[0] or "no_url"
    except Exception:  # noqa: BLE001
        return "no_url"


def test_domain_matches_urlsplit(spark):
    df = spark.createDataFrame([(u,) for u in ODD_URLS] + [(None,)], "url string")
    got = {r.url: r.d for r in df.select("url", domain("url").alias("d")).collect()}
    for u in ODD_URLS + [None]:
        assert got[u] == python_domain(u), u


TEXTS = ["  a b  ", "a\u00a0b\u2003c", "x\n", "\x1cy\x1f", "", "   ", "one", "tab\tsep\u3000arated\u2028x"]


def test_strip_and_words_match_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select("t", strip_ws("t").alias("s"), word_count("t").alias("n")).collect()
    for r in got:
        assert r.s == r.t.strip(), repr(r.t)
        assert r.n == len(r.t.split()), repr(r.t)


@pytest.mark.parametrize("text,expected", [("12.7", 12), ("-3.9", -3), ("nan", 0), ("abc", 0), (None, 0),
                                           ("1e3", 1000), ("12d", 0), ("inf", 0), (" 7 ", 7)])
def test_lenient_int(spark, text, expected):
    assert spark.createDataFrame([(text,)], "s string").select(lenient_int("s").alias("v")).first().v == expected


def test_question_and_threshold(spark):
    df = spark.createDataFrame([("a?", 0.5), ("a? ", 0.49999), ("a?\n", 1.0)], "t string, p double")
    r = df.select(ends_with_question("t").alias("q"), to_class("p").alias("c")).collect()
    assert [x.q for x in r] == [1, 0, 1]
    assert [x.c for x in r] == [1, 0, 1]
