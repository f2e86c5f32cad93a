from cartwheel.llm import url_filter as U

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
PAGES = [
    (1, "http://a.org/x", "<head><link rel=\"canonical\" href='http://b.net/fr/9'></head>"),
    (2, "https://c.org/y?q=1#f", "<META HTTP-EQUIV='refresh' content=\"0; url=/z\">"),
    (3, "http://c.org/z", "<link href=http://a.org/x rel=canonical>"),
    (4, "http://d.org/1", "<link rel=canonical href='http://good.com/'>"),
    (5, "http://e.org/", "<link rel=canonical href='http://d.org/1'>"),
    (6, "http://g.org/", "<!-- <link rel=canonical href='http://b.net/fr/9'> -->"),
    (7, None, None), (8, "nothing", "<link rel=canonical href='http://b.net/fr/9'>"),
    (9, "https://a.org/x#frag", None), (10, "HTTP://WWW.Example.com/en/q", ""),
    (11, "http://h.net/fr/x", "<link rel=canonical href='http://good.com/'>"),
    (12, "http://i.org/", "<link rel=canonical href='http://h.net/fr/x'>"),
    (13, "http://example.com", ""), (14, "http://xexample.com/en/", ""), (15, "http://m.example.com/en/?a/b", ""),
    (16, "http://j.org/", "<script><link rel=canonical href='http://b.net/fr/9'></script>"), (16, "http://j.org/", ""),
]


def test_rules_aliases_and_precedence(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES],
                                  "page_id bigint, url string, html string, host string, node string")
    got = U.judge_urls(pages.drop("html"), RULES, U.page_edges(pages)).collect()
    verdicts = {r.page_id: (r.filter.rule, r.filter.verdict) for r in got}
    assert len(got) == len(PAGES) and got[0].host == "x"
    assert verdicts == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "allow"), 5: (None, "allow"),
        6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "block"),
        10: ("www.example.com/en/", "allow"), 11: ("net/fr/", "block"), 12: (None, "allow"),
        13: (None, "allow"), 14: ("com/", "allow"), 15: ("example.com/en/", "block"), 16: (None, "allow")}
    seven = next(r for r in got if r.page_id == 7)
    assert (seven.filter.host, seven.filter.path) == ("", "")


def test_long_redirect_chain_and_hub(spark):
    edges = [(f"http://c{i}.org/", f"http://c{i + 1}.org/") for i in range(150)] + [("http://c150.org/", "http://x.net/es/1")]
    edges += [(f"http://hub{i}.org/", "http://center.org/") for i in range(300)] + [("http://center.org/", "http://y.net/fr/")]
    urls = spark.createDataFrame([(u,) for e in edges for u in e] + [("http://free.org/",)], "url string")
    got = U.judge_urls(urls, RULES, spark.createDataFrame(edges, "src_url string, dst_url string")).collect()
    assert {r.filter.verdict for r in got if r.url != "http://free.org/"} == {"block"}
    assert next(r for r in got if r.url == "http://free.org/").filter.verdict == "allow"


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert U.judge_urls(pages, RULES, U.page_edges(pages)).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    assert U.judge_urls(some, (), U.page_edges(pages)).first().filter.verdict == "allow"
