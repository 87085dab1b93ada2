from hourwise.llm import url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judged(spark, urls, rules=RULES, **options):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    r = spark.createDataFrame(rules, "host string, path string, action string")
    return {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter.judge(pages, r, **options).collect()}


def test_hosts_paths_and_precedence(spark):
    got = judged(spark, [
        "http://a.Example.NET/en/x?q=1#f", "https://example.net/de/", "http://example.net", "http://notexample.com/de/1",
        "http://www.example.com/de/1", "no scheme", None, "", "ftp://x.org/fr/://net/", "http://net/?a", "HTTP://É.NET/", "a://b.net#/"])
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/de/", "net/", "block")
    assert got[2] == ("example.net", "", None, "allow")
    assert got[3] == ("notexample.com", "/de/1", None, "allow")
    assert got[4] == ("www.example.com", "/de/1", "example.com/de/", "block")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("x.org", "/fr/://net/", "org/fr/", "allow")
    assert got[9] == ("net", "/", "net/", "block")
    assert got[10] == ("É.net", "/", "net/", "block")
    assert got[11] == ("b.net", "", None, "allow")


def test_long_urls_ties_repeats_and_odd_rules(spark):
    long_host, long_path = "a." * 20_000 + "net", "/" + "p/" * 50_000
    rules = RULES + [("b.c", "/x", "allow"), ("c", "/xyz", "block"), (None, "/", "block"), ("dup.com", None, "allow"), ("dup.com", "", "block")]
    got = judged(spark, [f"http://{long_host}{long_path}", "http://b.c/xyz", "http://dup.com", "http://dup.com"], rules)
    assert got[0][2:] == ("net/", "block")
    assert got[1][2:] == ("b.c/x", "allow")  # as long as c/xyz, and the longer host
    assert got[2] == got[3] == ("dup.com", "", "dup.com", "block")


def test_empty_tables(spark):
    assert judged(spark, ["http://a.net/"], rules=[(None, "/", "block")]) == {0: ("a.net", "/", None, "allow")}
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    assert url_filter.judge(pages, rules).collect() == []


def test_default_verdict_and_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://q.com/"), (1, "http://q.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    assert [x.verdict for x in url_filter.judge(pages, rules, default="block").collect()] == ["block", "block"]
