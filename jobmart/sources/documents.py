"""Raw documents in the three source shapes, derived from the test tables.

* ``api_jobs``: one raw API job struct per order (nested arrays of structs
  built from the order's line items, parts and suppliers).
* ``api_response_pages``: those jobs serialised as search-response JSON
  text, 50 jobs per page (the API's page size), including wrong-typed
  ``data`` fields and non-object elements.
* ``jsonld_pages`` / ``dom_pages``: HTML detail pages carrying JSON-LD
  blocks or DOM fields, built from feed rows.

Per-order line lists are bounded by the order (≤ 17 lines here, ≤ 7 in
TPC-H) and pages by the page size, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import schemas as S
from jobmart.functions.variant import evaluate_once
from jobmart.sources.feed import feed_base, read_table

API_PAGE_SIZE = 50


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its lines sorted by (linenumber, partkey, suppkey) with
    part and supplier-nation attributes."""
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name").withColumnRenamed("n_name", "s_nation")
    lines = (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .join(supplier, F.col("l_suppkey") == supplier.s_suppkey)
        .join(nation, F.col("s_nationkey") == nation.n_nationkey)
    )
    line = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "p_name", "p_brand", "p_type", "s_nation"
    )
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list(line)).alias("lines")
    )


def _api_job(k, lines) -> F.Column:
    """Raw API job struct for order key ``k`` and its sorted ``lines``."""
    ln = lambda x: x["l_linenumber"]
    locations = F.transform(
        lines,
        lambda x: F.struct(
            F.when(ln(x) % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("Warehouse "), x["l_suppkey"].cast("string"))).alias("address"),
            F.when(ln(x) % 3 == 0, x["s_nation"]).when(ln(x) % 3 == 1, F.lit("")).alias("cityName"),
            F.concat(F.lit("VN-"), x["s_nation"]).alias("cityNameVI"),
        ),
    )
    children = F.transform(
        lines, lambda x: F.struct(F.when(ln(x) % 4 == 0, F.lit("")).otherwise(x["p_name"]).alias("name"))
    )
    industries = F.transform(
        lines, lambda x: F.struct(F.when(ln(x) % 5 == 0, F.lit(None)).otherwise(x["p_type"]).alias("industryV3Name"))
    )
    skills = F.transform(
        lines, lambda x: F.struct(F.when(ln(x) % 4 == 3, F.lit("")).otherwise(x["p_type"]).alias("skillName"))
    )
    benefits = F.transform(
        lines,
        lambda x: F.struct(
            F.when(ln(x) % 5 == 4, F.lit("")).otherwise(x["p_brand"]).alias("benefitName"),
            F.when(ln(x) % 6 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" \t"), x["p_name"], F.lit("\r\n"), x["p_brand"], F.lit("\n#"), ln(x).cast("string"), F.lit("\r  ")))
            .alias("benefitValue"),
        ),
    )
    first_brand = F.get(lines, 0)["p_brand"]
    return F.struct(
        k.alias("jobId"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lit("")).otherwise(
            F.concat(F.lit("https://jobs.example.com/"), k.cast("string"))
        ).alias("jobUrl"),
        F.col("o_orderpriority").alias("jobTitle"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("Orders of "), F.col("c_name"))).alias("jobDescription"),
        F.when(k % 4 == 1, F.lit(None)).otherwise(F.col("r_name")).alias("jobRequirement"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("jobLevel"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(k % 10).alias("yearsOfExperience"),
        F.struct(
            F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, F.lit("")).otherwise(first_brand).alias("parentName"),
            children.alias("children"),
        ).alias("jobFunction"),
        industries.alias("industriesV3"),
        F.col("c_name").alias("companyName"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("companyProfile"),
        F.lit(None).cast("string").alias("companySize"),
        F.lit("").alias("companyLogo"),
        F.when(k % 2 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("contactName"),
        locations.alias("workingLocations"),
        skills.alias("skills"),
        benefits.alias("benefits"),
        F.struct(
            F.when(k % 3 == 0, F.lit(S.SALARY_RANGE_TYPE)).when(k % 3 == 1, F.lit("Negotiable")).alias("type"),
            F.when(k % 10 == 3, F.lit(None)).otherwise(F.floor("o_totalprice").cast("double")).alias("min"),
            (F.floor("o_totalprice") + 1000).cast("double").alias("max"),
            F.when(k % 4 == 0, F.lit(None)).otherwise(F.lit("VND")).alias("currency"),
        ).alias("salary"),
        F.when(k % 2 == 0, F.lit(None)).otherwise(F.lit("Negotiable")).alias("prettySalary"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("onlineOn"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd").alias("expiredDate"),
    )


def api_jobs(spark: SparkSession, sf_dir: str, with_lines: bool = True) -> DataFrame:
    """(job struct): one raw API job per order; orders without lines get an
    empty line list. The struct follows ``schemas.API_JOB``. Queries that use no list
    of the job pass ``with_lines=False`` and read no line items."""
    base = feed_base(spark, sf_dir)
    lines = order_lines(spark, sf_dir)
    none = F.array().cast(lines.schema["lines"].dataType)
    if with_lines:
        joined = base.join(lines, "o_orderkey", "left").withColumn("lines", F.coalesce("lines", none))
    else:
        joined = base.withColumn("lines", none)
    k = F.col("o_orderkey")
    return joined.select(k, _api_job(k, F.col("lines")).alias("job"))


def api_response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, body): search responses as JSON text, ``API_PAGE_SIZE`` jobs each.

    Page p % 5 == 0 appends a non-object element (a job without id, which the conform
    step rejects). For each page p % 7 == 3 there is one more response, malformed by
    p % 3: ``data`` is a text, an object, or the body is cut off; it yields no job.
    """
    jobs = api_jobs(spark, sf_dir)
    page = F.floor(F.col("o_orderkey") / API_PAGE_SIZE)
    grouped = jobs.groupBy(page.alias("page")).agg(
        F.array_join(F.collect_list(F.to_json("job")), ",").alias("items")
    )
    p = F.col("page")
    body = F.when(
        p % 5 == 0, F.concat(F.lit('{"data": ['), F.col("items"), F.lit(", 1]}"))
    ).otherwise(F.concat(F.lit('{"data": ['), F.col("items"), F.lit("]}")))
    broken = (
        F.when(p % 3 == 0, F.lit('{"data": "oops"}'))
        .when(p % 3 == 1, F.lit('{"data": {"jobId": 1}}'))
        .otherwise(F.lit('{"data": [{"jobId": 1'))
    )
    bodies = F.when(p % 7 == 3, F.array(body, broken)).otherwise(F.array(body))
    return grouped.select("page", F.explode(bodies).alias("body"))


def _slug(c: F.Column) -> F.Column:
    return F.lower(F.regexp_replace(c, "[^A-Za-z0-9]+", "-"))


def _script(body: F.Column) -> F.Column:
    return F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))


def _spread(spark: SparkSession, base: DataFrame) -> DataFrame:
    """The narrow rows over all cores before they become pages: the tables are one file,
    while landed pages come in many."""
    return base.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")


def jsonld_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, url, html): job detail pages with JSON-LD blocks.

    By ``k % 8``: 0 one JobPosting (location object; where ``k % 16 == 8`` the location
    is a text, the salary a number above 1e7 in E-notation, skills and industry are
    lists); 1 ``@type`` list and a
    location list; 2 a WebSite block only; 3 a broken block before a good
    one; 4 no block (and an empty h1 when ``k % 3 == 0``); 5 a top-level
    array block then a WebSite block; 6 an empty title; 7 an empty
    organisation and location list. ``k % 13 == 5`` adds a bot-check text.
    """
    base = _spread(spark, feed_base(spark, sf_dir))
    k = F.col("o_orderkey")
    k8 = k % 8
    org = F.struct(F.col("c_name").alias("name"))
    loc_obj = F.struct(F.struct(F.col("n_name").alias("addressLocality")).alias("address"))
    title = F.col("o_orderpriority")
    jp_obj = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), title.alias("title"), org.alias("hiringOrganization"),
        loc_obj.alias("jobLocation"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("datePosted"),
        F.struct(F.lit("VND").alias("currency"), F.struct(
            F.floor("o_totalprice").alias("minValue"), (F.floor("o_totalprice") + 1000).alias("maxValue")
        ).alias("value")).alias("baseSalary"),
    ))
    big = (F.floor("o_totalprice") + 25_000_000).cast("double")
    jp_other_forms = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), title.alias("title"), org.alias("hiringOrganization"),
        F.col("n_name").alias("jobLocation"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("datePosted"),
        F.array(F.lit("sales"), F.lit(""), F.col("r_name")).alias("skills"),
        F.array(F.col("c_mktsegment"), F.col("r_name")).alias("industry"),
        F.struct(F.lit("VND").alias("currency"), F.struct(
            big.alias("minValue"), (big * 2).alias("maxValue")
        ).alias("value")).alias("baseSalary"),
    ))
    jp_list_type = F.to_json(F.struct(
        F.array(F.lit("Thing"), F.lit("JobPosting")).alias("@type"), title.alias("title"),
        org.alias("hiringOrganization"),
        F.array(F.struct(F.struct(F.col("n_name").alias("addressLocality"),
                                  F.lit(None).cast("string").alias("addressRegion")).alias("address")),
                F.struct(F.struct(F.lit(None).cast("string").alias("addressLocality"),
                                            F.col("r_name").alias("addressRegion")).alias("address"))).alias("jobLocation"),
    ))
    website = F.to_json(F.struct(F.lit("WebSite").alias("@type"), F.col("c_name").alias("name")))
    jp_empty_title = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), F.lit("").alias("title"), org.alias("hiringOrganization"),
        loc_obj.alias("jobLocation"),
    ))
    jp_empty_org = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), title.alias("title"),
        F.struct(F.lit(None).cast("string").alias("name")).alias("hiringOrganization"),
        F.array().cast("array<string>").alias("jobLocation"),
    ))
    blocks = (
        F.when(k % 16 == 8, _script(jp_other_forms))
        .when(k8 == 0, _script(jp_obj))
        .when(k8 == 1, _script(jp_list_type))
        .when(k8 == 2, _script(website))
        .when(k8 == 3, F.concat(_script(F.lit('{"@type": "JobPosting", "title": ')), _script(jp_obj)))
        .when(k8 == 4, F.lit(""))
        .when(k8 == 5, F.concat(_script(F.concat(F.lit("["), jp_obj, F.lit("]"))), _script(website)))
        .when(k8 == 6, _script(jp_empty_title))
        .otherwise(_script(jp_empty_org))
    )
    h1 = F.when((k8 == 4) & (k % 3 == 0), F.lit("")).otherwise(title)
    challenge = F.when(k % 13 == 5, F.lit("<div>Please Verify You Are Human</div>")).otherwise(F.lit(""))
    html = F.concat(
        F.lit("<html><head><title>"), title, F.lit("</title>"), blocks, F.lit("</head><body>"),
        challenge, F.lit("<h1>"), h1, F.lit("</h1></body></html>"),
    )
    url = F.concat(
        F.lit("https://www.topcv.vn/viec-lam/"), _slug(title), F.lit("/"), k.cast("string"), F.lit(".html?ta=x")
    )
    # Made once a row: a filter on the page would else hold its whole expression, for each test.
    return evaluate_once(base, html, "html").select(k, url.alias("url"), "html")


def dom_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, html): detail pages whose fields are DOM elements only.

    All seven fields occur, with nested elements of one tag, attributes in any order
    and quotes, named and numeric entities, void elements and comments; decoys carry
    longer class names that only begin like the real ones. By ``k % 3`` the company is
    an anchor in the hero text, the hero text itself, or in the side bar (then a login
    anchor elsewhere on the page must not be taken); ``k % 4 == 1`` has no ``h1``,
    ``k % 5 == 2`` takes the second selector for place and salary."""
    base = _spread(spark, feed_base(spark, sf_dir))
    k = F.col("o_orderkey")
    name, nation, region = F.col("c_name"), F.col("n_name"), F.col("r_name")

    def text(*parts) -> F.Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    title = (
        F.when(k % 4 == 1, text("<p CLASS='x nw-company-hero__title'> ", F.col("o_orderpriority"), " &amp; caf&eacute; </p>"))
        .otherwise(text("<H1 id=t>\n", F.col("o_orderpriority"), " &amp; caf&#233;<br></H1>"))
    )
    company = (
        F.when(k % 3 == 0, text('<div class="nw-company-hero__text">by <b><a href="/c">', name, "</a></b></div>"))
        .when(k % 3 == 1, text("<div class=nw-company-hero__text>", name, " &lt;VN&gt;</div>"))
        .otherwise(text('<div class="nw-sidebar-company__title"><span>', name, "</span></div>"))
    )
    place = (
        F.when(k % 5 == 2, text('<ul class="job-work-places text-left"><li>', nation, "</li></ul>"))
        .otherwise(text('<span class="nw-company-hero__address">', nation, "</span>"))
    )
    salary = (
        F.when(k % 5 == 2, text('<div class="nw-job-list__main">', F.floor("o_totalprice").cast("string"), "</div>"))
        .otherwise(text('<div class="big text-left job-base-infos">', F.floor("o_totalprice").cast("string"), " <i>VND</i></div>"))
    )
    html = text(
        "<!doctype html><html><head><title>x</title></head><body><!-- <h1>no</h1> -->",
        '<div class="text-left job-desc-header">decoy</div><div class="nw-company-hero__text-x">decoy</div>',
        title, company, '<p><a href="/login">Login</a></p>', place, salary,
        '<div data-x="a>b" class="text-left job-desc">part one<div>inner ', region, "</div>part two</div>",
        '<section class="job-requirement text-left"><p>', F.col("c_mktsegment"), "</p><section>deep</section>end</section>",
        '<div class="text-left job-benefit">', F.lit("none &amp; all"), "</div></body></html>",
    )
    return evaluate_once(base, html, "html").select(k, "html")


# Hosts and the markers that select their links.
LISTING_SITES = {"topcv": S.JSONLD_LINK_MARKERS, "joboko": S.DOM_LINK_MARKERS}


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, site, url, html): a listing page per order with links in many forms:
    case, quotes, entities, ``..`` segments, other attributes, repeats, other targets."""
    base = feed_base(spark, sf_dir).select("o_orderkey")
    k = F.col("o_orderkey").cast("string")
    site = F.when(F.col("o_orderkey") % 2 == 0, F.lit("topcv")).otherwise(F.lit("joboko"))
    url = F.concat(F.lit("https://www."), site, F.lit(".vn/list/all/page.html?p="), k)
    html = F.concat(
        F.lit('<A HREF="/viec-lam/a-'), k, F.lit(".html?x=1&amp;y=2\">a</A>"),
        F.lit("<a class='b' href='../viec-lam/b-"), k, F.lit("'>b</a>"),
        F.lit('<a href="/viec-lam/c" data-href="/viec-lam/no">c</a><a data-href="/viec-lam/no">d</a>'),
        F.lit("<a title='a > b' href=./viec-lam-"), k, F.lit(">e</a><a href=\"/about\">f</a>"),
        F.lit('<a href=" /viec-lam/a-'), k, F.lit('.html?x=1&#38;y=2 ">again</a><a href="/vacancies/'), k, F.lit('">g</a>'),
        F.lit("<abbr href='/viec-lam/no'>h</abbr>"),
    )
    return base.select("o_orderkey", site.alias("site"), url.alias("url"), html.alias("html"))


def job_link_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, url): listing links as a crawler would collect them — every page
    URL of the ``pages`` table plus two detail-page links per order (a plain
    one and a variant chosen by ``k % 6``: fragment, query, bad id suffix,
    padded, other host, relative-looking)."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url").select(
        F.col("page_id").alias("pos"), F.col("url")
    )
    base = feed_base(spark, sf_dir).select("o_orderkey", "o_orderpriority")
    k = F.col("o_orderkey")
    plain = F.concat(
        F.lit("https://vn.joboko.com/viec-lam-"), _slug(F.col("o_orderpriority")), F.lit("-xvi"), k.cast("string")
    )
    k6 = k % 6
    variant = (
        F.when(k6 == 0, plain)
        .when(k6 == 1, F.concat(plain, F.lit("#top")))
        .when(k6 == 2, F.concat(plain, F.lit("?u=1")))
        .when(k6 == 3, F.concat(plain, F.lit("b")))
        .when(k6 == 4, F.concat(F.lit("  "), plain, F.lit("#x ")))
        .otherwise(F.concat(F.lit("https://other.example/viec-lam-a-xvi"), k.cast("string")))
    )
    offset = F.lit(10_000_000_000)
    feed = base.select(
        F.explode(
            F.array(
                F.struct((offset + k * 2).alias("pos"), plain.alias("url")),
                F.struct((offset + k * 2 + 1).alias("pos"), variant.alias("url")),
            )
        ).alias("c")
    ).select("c.pos", "c.url")
    return pages.unionByName(feed)


def with_salary_signal(fact: DataFrame) -> DataFrame:
    """``fact`` with a ``salary_avg`` that depends on location and level (a step by digits
    of each one's MD5, none for null), and, for the rest, on the posting's own salary."""
    step = lambda c: F.coalesce(F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("int") % 5, F.lit(0))
    return fact.withColumn(
        "salary_avg", F.col("salary_avg") % 10_000 + step("location") * 5_000 + step("level") * 9_000 + 1
    )
