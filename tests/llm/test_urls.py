import pytest

from delaystar.llm import urls
from tests.llm.helpers import duckdb_rows

PAGE = "page_id bigint, url string, html string"
CASES = [
    # url, host, path, rule, verdict
    ("http://www.Example.com/en/1?x=/fr/", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
    ("https://a.b.example.com/en/x#y", "a.b.example.com", "/en/x", "example.com/en/", "block"),
    ("https://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
    ("https://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("https://spam-farm.example.com/xxx", "spam-farm.example.com", "/xxx", "com/", "allow"),
    ("https://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("https://x.net/es", "x.net", "/es", None, "allow"),
    ("https://com", "com", "", None, "allow"),
    ("https://x.com:80/", "x.com:80", "/", None, "allow"),
    ("http://a?b://c/d", "a", "", None, "allow"),
    ("x://y://z/w", "y:", "//z/w", None, "allow"),
    ("no scheme.com/en/", "", "", None, "allow"),
    ("spam-farm without scheme", "", "", None, "block"),
    ("https://spam-farm.example.org/en/7", "spam-farm.example.org", "/en/7", None, "block"),
    ("https://PORN.org", "porn.org", "", None, "block"),
    ("https://essex.org/sextant/alphabet", "essex.org", "/sextant/alphabet", None, "allow"),
    ("https://poker.org/poker/poker", "poker.org", "/poker/poker", None, "allow"),
    ("https://poker.org/casino", "poker.org", "/casino", None, "block"),
    ("https://a.org/xxx9/9xxx/a-xxx", "a.org", "/xxx9/9xxx/a-xxx", None, "block"),
    ("https://a.org/\u00e9sex\u00e9 bet", "a.org", "/\u00e9sex\u00e9 bet", None, "block"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("https://a.org/" + "x" * 100_000 + "/spam/bet", "a.org", "/" + "x" * 100_000 + "/spam/bet", None, "block"),
]


def _pages(spark, more=""):
    return spark.createDataFrame([(i, c[0], None, *("z" for _ in more.split())) for i, c in enumerate(CASES)],
                                 PAGE + "".join(f", {c} string" for c in more.split()))


def test_cases(spark):
    got = {r["page_id"]: r for r in urls.judge_urls(_pages(spark, "host verdict")).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert tuple(got[i])[1:5] == (host, path, rule, verdict), CASES[i][0][:60]


def test_sql_twin(spark):
    pages = _pages(spark)
    pages = pages.unionByName(pages)
    names, want = duckdb_rows(urls.oracle(), pages=pages.toPandas())
    got = urls.judge_urls(pages).select(names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_overlapping_terms_are_all_found():
    assert urls.term_hits("a-spam-farm-b", ("farm", "spam-farm"), ("spam", "am")) == (2, 1)


@pytest.mark.parametrize("least, verdict", [(1, "block"), (2, "block"), (3, "allow")])
def test_number_of_soft_terms(spark, least, verdict):
    one = spark.createDataFrame([(1, "https://a.org/poker-bet", None)], PAGE)
    assert urls.judge_urls(one, min_soft=least).first()["verdict"] == verdict


def test_longest_rule_counts_host_and_path_together(spark):
    rules = [("a.b.org", "/", "allow"), ("org", "/long/path/", "block")]
    one = spark.createDataFrame([(None, "https://x.a.b.org/long/path/y", None)], PAGE)
    row = urls.judge_urls(one, rules=rules).first()
    assert (row["page_id"], row["rule"], row["verdict"]) == (None, "org/long/path/", "block")


def test_empty_table(spark):
    assert urls.judge_urls(spark.createDataFrame([], PAGE)).count() == 0
