from cartwheel.llm import html_text as H

SCHEMA = "page_id bigint, url string, html string, host string, winners string"


def page(main, side="<div class='side-7'><p>" + "link words here " * 3 + "</p></div>"):
    return f"<html><body><nav>menu</nav>{side}<div class='content c{len(main)}'>{main}</div><footer>foot</footer></body></html>"


def test_boilerplate_and_white_space():
    got = H.main_text("""<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
        <header><h1>Site</h1></header><nav>m</nav><div class="cookie-notice">we use</div><main><header><h1>Title</h1></header>
        <div class="content"><p>Hello <b>wor</b>ld &amp; &lt;you&gt;&nbsp;x<br>new
        line<p>second<!-- gone --><script>var t="</p>";</script><div class="ad-slot">buy</div><ul><li>one<li>two</ul>
        <form>f<input></form></div><section id="comments"><p>great post</p></section></main>
        <aside>side</aside><footer>foot</footer></body></html>""", [])
    assert got == "Title Hello world & <you> x new line second one two"


def test_broken_markup():
    assert H.main_text("<article><p><b>one<p>two</article><footer>x", []) == "one two"
    assert H.main_text("just text &copy; &am", []) == "just text © &am"
    assert H.main_text("<div><p>a < b and c > d</p></div", []) == "a < b and c > d"
    assert H.main_text("<article>x<script>never closed <p>hidden", []) == "x"
    assert H.main_text("<article " + "a='" * 2000, []) is not None
    assert H.main_text("<div>" * 3000 + "deep", []) == "deep"
    assert H.main_text("", []) == "" and H.main_text("<nav>only</nav>", []) == ""


def test_host_votes_set_a_misleading_page_right(spark):
    article = "<p>" + "the article itself goes on and on " * 4 + "</p>"
    long_side = "<div class='side-9'><p>" + "sidebar text that is longer than it should be " * 4 + "</p></div>"
    rows = [(i, f"http://Host.org/{i}", page(article)) for i in range(10)]
    short = "<p>" + "a short article of this host here " * 3 + "</p>"
    rows += [(50, "http://host.org/x", page(short, long_side)), (51, "http://other.org/x", page(short, long_side))]
    rows += [(60, None, page(article)), (61, "http://host.org/n", None), (62, "http://host.org/e", ""), (0, "http://Host.org/0", page(article))]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    # digits in classes are generalised, so c123 and c99 are one template
    paths = {r.host: r.winners for r in H.host_paths(frame).collect()}
    assert paths["host.org"][0] == "/body/div.c#.content"
    got = {r.page_id: r.text for r in H.extract(frame).collect()}
    assert got[0] == " ".join("the article itself goes on and on".split() * 4)
    assert got[50].startswith("a short article") and got[51].startswith("sidebar text")
    assert got[60] == got[0] and got[61] == "" and got[62] == ""
    out = H.extract(frame)
    assert out.columns == [*frame.columns, "text"] and out.count() == len(rows)
    assert H.extract(frame.limit(0)).count() == 0
