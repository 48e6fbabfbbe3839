"""Page extraction (W1–W12) on hand-made HTML (FIXTURES.md §5)."""

from pyspark.sql import functions as F

from jobmart.functions import dom
from jobmart.functions.variant import get
from jobmart.operators import pages as P

GOOD = '{"@type": "JobPosting", "title": "Dev", "hiringOrganization": {"name": "Acme"}, "jobLocation": {"address": {"addressLocality": "HN"}}}'


def _script(body):
    return f'<script type="application/ld+json">{body}</script>'


def test_jsonld_blocks_pick_first(spark):
    rows = [
        (0, "<html></html>"),
        (1, _script(GOOD)),
        (2, _script("{broken") + _script(GOOD)),
        (3, _script('[{"@type": "JobPosting"}]') + _script('{"@type": "WebSite"}')),
        (4, _script('{"@type": ["Thing", "JobPosting"], "title": "X"}')),
    ]
    df = spark.createDataFrame(rows, "id int, html string").select(
        "id",
        F.size(P.jsonld_blocks(F.col("html"))).alias("n"),
        get(P.pick_job_posting(P.jsonld_blocks(F.col("html"))), "$.title", "string").alias("pick"),
        P.jsonld_first(F.col("html")).isNotNull().alias("has_first"),
    )
    got = {r.id: (r.n, r.pick, r.has_first) for r in df.collect()}
    assert got == {
        0: (0, None, False),
        1: (1, "Dev", True),
        2: (1, "Dev", False),
        3: (2, None, True),
        4: (1, "X", True),
    }


def test_validity(spark):
    bodies = [
        GOOD,
        GOOD.replace('"Dev"', '""'),
        GOOD.replace('{"name": "Acme"}', "{}"),
        GOOD.replace('{"address": {"addressLocality": "HN"}}', "[]"),
        "[1]",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "b string").select(
        P.is_valid_posting(F.try_parse_json("b"))
    )
    assert [r[0] for r in df.collect()] == [True, False, False, False, False]


def test_challenge_and_dom(spark):
    html = (
        '<div class="x nw-company-hero__text y"><a href="/c">Acme &amp; Co</a></div>'
        '<h2 class="nw-company-hero__title">T2</h2>'
        '<div class="text-left job-desc"><p>Desc</p></div><p>Please VERIFY you are human</p>'
    )
    df = spark.createDataFrame([(html,)], "html string").select(
        P.dom_record(F.col("html")).alias("d"), P.is_challenge_page(F.col("html")).alias("blocked")
    )
    r = df.first()
    assert r.blocked is True
    assert r.d.title == "T2"
    assert r.d.company == "Acme & Co"
    assert r.d.description_html == "<p>Desc</p>"
    assert r.d.salary == ""


def test_links_resolved_distinct(spark):
    html = '<a href="/a">1</a><a class="k" href="b.html">2</a><a href="/a">3</a><a href="https://x.org/viec-lam/9">4</a><a href="#t">5</a>'
    pages = spark.createDataFrame([(1, "https://site.vn/jobs/list?p=2#top", html)], "page_id int, url string, html string")
    got = [(r.pos, r.link) for r in P.extract_links(pages).collect()]
    assert got == [
        (0, "https://site.vn/a"),
        (1, "https://site.vn/jobs/b.html"),
        (2, "https://x.org/viec-lam/9"),
        (3, "https://site.vn/jobs/list?p=2#t"),
    ]
    only = [r.link for r in P.extract_links(pages, markers=["/viec-lam/"]).collect()]
    assert only == ["https://x.org/viec-lam/9"]


def test_first_seen_links(spark):
    rows = [(3, "https://vn.joboko.com/viec-lam-a-xvi1#top"), (1, " https://vn.joboko.com/viec-lam-a-xvi1 "),
            (2, "https://vn.joboko.com/viec-lam-a-xvi1?u=1"), (0, "https://vn.joboko.com/viec-lam-a-xvi2b")]
    df = spark.createDataFrame(rows, "pos int, url string")
    got = sorted((r.link, r.first_pos) for r in P.first_seen_links(df).collect())
    assert got == [("https://vn.joboko.com/viec-lam-a-xvi1", 1), ("https://vn.joboko.com/viec-lam-a-xvi1?u=1", 2)]


def test_dom_nesting_tokens_descendants_and_entities():
    html = (
        '<div class="text-left job-desc-header">no</div><div class="text-left job-desc">one<div>two</div>three</div>'
        '<div class="nw-company-hero__text">Caf&eacute; &#38; Co</div><a href="/l">Login</a><H1>T<br>x</H1>'
        "<p class='job-base-infos text-left'>1 &lt; 2"
    )
    names = [*P.S.DOM_TEXT_SELECTORS, *P.S.DOM_HTML_SELECTORS]
    got = dict(zip(names, dom.fields_of(html), strict=True))
    assert got["description_html"] == "one<div>two</div>three"
    assert got["company"] == "Café & Co" and got["title"] == "Tx" and got["salary"] == "1 < 2"
    assert dom.fields_of(None) == dom.fields_of("") == ("",) * 7


def test_link_forms(spark):
    html = (
        "<A HREF='../x'>1</A><a data-href=\"/no\" href=\"/y?a=1&amp;b=2\">2</a><a title='>' href=z>3</a>"
        "<a data-href='/no'>4</a><link href='/no'>"
    )
    pages = spark.createDataFrame([(1, "https://h.vn/a/b/c", html)], "page_id int, url string, html string")
    assert [r.link for r in P.extract_links(pages).collect()] == [
        "https://h.vn/a/x", "https://h.vn/y?a=1&b=2", "https://h.vn/a/b/z",
    ]


def test_only_pages_without_a_block_are_parsed(spark):
    from jobmart.operators import pages as P

    block = '<script type="application/ld+json">{"@type": "JobPosting"}</script>'
    rows = [(1, block), (2, "<h1> x </h1>"), (3, "<h1></h1>"), (4, None), (5, block + "<h1></h1>")]
    kept = P.not_postings(spark.createDataFrame(rows, "id int, html string"))
    assert sorted(r.id for r in kept.collect()) == [3, 4]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Generate explode")


def test_dom_places_and_nesting():
    names = list(dom.TEXT_FIELDS) + list(dom.MARKUP_FIELDS)
    fields = lambda html: dict(zip(names, dom.fields_of(html), strict=True))
    got = fields("\n<div class='text-left x job-desc'>a\n<b>b</div>c</div><h1>one<br/>&amp;</h1><h1>two</h1>")
    assert got["description_html"] == "a\n<b>b" and got["title"] == "one&"
    # An ancestor that is closed already is none; an element open to the end ends there.
    got = fields("<p class=nw-company-hero__text>t</p><a>no</a><div class='text-left job-benefit'><i>z")
    assert got["company"] == "t" and got["benefits_html"] == "<i>z"
    assert fields("<p class=nw-company-hero__text>t<span><a>yes</a></span></p>")["company"] == "yes"
    deep = "<div>" * 20000 + "<h1>t</h1>" + "</p>" * 20000 + "</div>" * 20000
    assert fields(deep)["title"] == "t"


def test_links_of_several_sites_in_one_scan(spark):
    page = '<a href="/x/1">a</a><a HREF=\'/y/2#z\'>b</a><a href="/x/1">c</a><a href="/q">d</a>'
    rows = [(1, "a", "https://a.vn/l/", page), (2, "b", "https://b.vn/l/", page), (3, "c", "https://c.vn/", page),
            (4, "a", "https://a.vn/", None), (5, None, "https://a.vn/", page), (6, "b", "https://b.vn/", "")]
    pages = spark.createDataFrame(rows, "id int, site string, url string, html string")
    links = P.extract_site_links(pages, {"a": ["/x/"], "b": ["/y/", "/q"]}, ["site", "id"])
    assert sorted(tuple(r) for r in links.collect()) == [
        ("a", 1, 0, "https://a.vn/x/1"), ("b", 2, 0, "https://b.vn/y/2#z"), ("b", 2, 1, "https://b.vn/q"),
    ]
    assert links._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    for site in ("a", "b"):
        one = P.extract_links(pages.where(F.col("site") == site), "id", markers={"a": ["/x/"], "b": ["/y/", "/q"]}[site])
        assert sorted(tuple(r) for r in one.collect()) == sorted(
            tuple(r) for r in links.where(F.col("site") == site).select("id", "pos", "link").collect()
        )


def test_each_page_is_made_and_parsed_once(spark):
    """A filter on what is made or parsed holds no second copy of it."""
    from tests.conftest import SMOKE_DIR

    from jobmart.sources import documents

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    pages = documents.jsonld_pages(spark, SMOKE_DIR)
    assert plan(P.jsonld_records(pages)).count("<html><head><title>") == 1
    landed = spark.createDataFrame([("https://vn.joboko.com/viec-lam-x-xvi1", "<h1>a</h1>")], "url string, html string")
    records = P.dom_records(landed)
    assert records._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.jobId, r.dom.title) for r in records.collect()] == [("joboko_1", "a")]


def test_markup_places_after_tags_of_all_forms():
    html = "<!-- x -->\n<B>é</B><script>if (a<b) c</h1></script><p a=1>\r\n<section class='text-left job-requirement'><I>k</I><br/>&amp;</section ></p>"
    assert dom.fields_of(html)[5] == "<I>k</I><br/>&amp;"
