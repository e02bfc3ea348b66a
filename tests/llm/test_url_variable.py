"""Variable places of the URL templates."""

import pytest
import duckdb
from pyspark.sql import functions as F

from starloom.llm import url_templates
from starloom.llm.queries import ORACLES, QUERIES

WORDS = ["es", "en", "de", "it", "pt", "nl", "sv", "da"]


def judged(spark, urls, times=1, **options):
    pages = spark.createDataFrame([(i, *u) for i, u in enumerate(urls * times)], "page_id long, url string, bad boolean")
    rows = url_templates.judge(pages, keep=("url",), label=F.col("bad"), **options).collect()
    assert len(rows) == len(urls) * times
    got = {}
    for r in rows:
        got.setdefault(r.url, set()).add((r.template, r.verdict))
    assert all(len(v) == 1 for v in got.values())
    return {u: v.pop() for u, v in got.items()}


@pytest.mark.parametrize("blocked", [["es"], ["es", "fr"]])
def test_clean_words_of_a_small_host_stay_under_the_registered_rules(spark, blocked):
    words = [*WORDS, "fr"] if "fr" in blocked else WORDS
    urls = [(f"http://a.net/{w}/{i}", None) for w in words for i in range(4)]
    once, twice = judged(spark, urls), judged(spark, urls, 2)
    assert once == twice
    assert {u.split("/")[3] for u, (_, verdict) in once.items() if verdict == "block"} == set(blocked)
    assert {t for u, (t, _) in once.items() if u.split("/")[3] not in blocked} == {"/*/{number}"}


def test_user_names_are_generalised_however_large_the_host(spark):
    def urls(pages):
        users = [chr(97 + i % 26) * 3 + chr(97 + i // 26) for i in range(40)]
        return [(f"http://u.org/{u}/{i}", True if k < 12 else None) for k, u in enumerate(users) for i in range(pages)]

    for pages in (1, 3, 30):
        got = judged(spark, urls(pages))
        assert set(got.values()) == {("/*/{number}", "block")}


def test_words_that_differ_stay_out_of_the_variable_place(spark):
    urls = [(f"http://s.org/{w}/{i}", w == "es") for w in WORDS for i in range(4)] + [(f"http://s.org/fi/{i}", None) for i in range(4)]
    got = judged(spark, urls)
    assert got["http://s.org/es/1"] == ("/es/{number}", "block")
    assert got["http://s.org/en/1"] == got["http://s.org/fi/1"] == ("/*/{number}", "allow")


def test_labels_that_differ_far_down(spark):
    """Branches are told apart at the seventh segment, and paths of a thousand
    segments are walked only where labelled ones differ."""
    deep = "/".join(chr(97 + i) * 3 for i in range(6))
    long = "/".join(["x"] * 1000)
    table = [(f"http://d.org/{deep}/bad/{i}", True) for i in range(30)] + [(f"http://d.org/{deep}/good/{i}", False) for i in range(30)]
    table += [(f"http://d.org/{deep}/bad/{i}", None) for i in range(30, 33)] + [(f"http://d.org/{deep}/good/{i}", None) for i in range(30, 33)]
    table += [(f"http://l.org/{long}/bad/{i}", True) for i in range(20)] + [(f"http://l.org/{long}/good/{i}", False) for i in range(20)] + [(f"http://l.org/{long}/bad/99", None)]
    table += [(f"http://m.org/{long}/{w}", None) for w in ("p", "q")] + [(f"http://s.org/{long}", True)]
    pages = spark.createDataFrame(table, "url string, bad boolean")
    rows = {r.url: r for r in url_templates.judge(pages.unionByName(pages), keep=("url",), label=F.col("bad")).collect()}
    for i in range(30, 33):
        assert rows[f"http://d.org/{deep}/bad/{i}"].verdict == "block" and rows[f"http://d.org/{deep}/good/{i}"].verdict == "allow"
    assert rows[f"http://l.org/{long}/bad/99"].verdict == "block"
    assert rows[f"http://l.org/{long}/good/3"].verdict == "allow"
    assert rows[f"http://m.org/{long}/p"].template.endswith("/**") and rows[f"http://s.org/{long}"].template.endswith("/**")


def test_registered_rules_can_reject_by_template(spark):
    """Pages that no rule fits share a template with blocked ones: numbers in
    place of the language."""
    table = [f"http://a.net/es/{i}" for i in range(40)] + [f"http://a.net/{w}" for w in ("es", "fr", "en")]
    rows = {r.url: r for r in url_templates.judge(spark.createDataFrame([(u,) for u in table], "url string"), keep=("url",), rules=(("a.net", "/es/1", "block"), ("a.net", "/es/2", "block"))).collect()}
    assert rows["http://a.net/es/17"].rule is not None and rows["http://a.net/es/33"].rule is None
    assert rows["http://a.net/es/33"].template == rows["http://a.net/es/17"].template == "/es/{number}"
    assert rows["http://a.net/es/33"].verdict == "block" and rows["http://a.net/en"].verdict == "allow"


def test_url_filter_oracle(spark):
    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.001/pages.parquet'")
    want = con.execute(ORACLES["op6_url_filter"]).fetchall()
    got = QUERIES["op6_url_filter"](spark, "/root/testdata/sf0.001").select(*[d[0] for d in con.description]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len(got) > 20
