"""Web-page extraction over a ``(id, url, html)`` table.

The crawlers ran these steps in a browser per page; here they are regex and
VARIANT expressions evaluated per row inside Spark tasks, so a page table of
any size is processed in parallel with no shuffle. The only shuffle is the
cross-page first-seen dedup of links (``first_seen_links``), an aggregate on
the link with map-side partial aggregation.

Links and JSON-LD blocks are found by regular expressions that take tags and
attributes in any case, values in double, single or no quotes, and decode the
entities a link can hold (Hard 3). DOM fields (W8) come from a parser
(``jobmart.functions.dom``). Resolved links are not percent-encoded the way a
browser's ``a.href`` is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart import schemas as S
from jobmart.functions.dom import dom_record
from jobmart.functions.text import (
    contains_any,
    decode_entities,
    dom_job_id,
    dom_link_kept,
    drop_fragment,
    jsonld_job_id,
    strip_ws,
)
from jobmart.functions.variant import evaluate_once, get, is_job_posting, truthy

# The value of an anchor's own href attribute: a space before it, so that data-href is
# another attribute, and quoted values of other attributes are skipped whole.
# Possessive, so that the matcher loops instead of recursing over a long tag.
_SKIP = r"""(?:(?!\shref\s*=)(?:[^>"']|"[^"]*+"|'[^']*+'))*+"""
HREF_PATTERN = rf"""(?i)<a(?=\s){_SKIP}\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
JSONLD_PATTERN = r"""(?is)<script[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""
_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


def _origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)


def _without_dots(url: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute URL's path."""
    head = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    parts = F.split(path, "/")

    def step(acc: Column, part: Column) -> Column:
        up = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", acc).otherwise(F.array_append(acc, part))

    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step)
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    clean = F.concat(head, F.array_join(kept, "/"), open_end, tail)
    return F.when((head != "") & path.rlike(r"/\.\.?(/|$)"), clean).otherwise(url)


def resolve_url(href: Column, base: Column) -> Column:
    """Resolve ``href`` against the page URL ``base`` (scheme, host-relative,
    path-relative, query and fragment forms, ``.`` and ``..`` segments)."""
    base_no_frag = F.substring_index(base, "#", 1)
    base_no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    has_path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    directory = F.when(has_path == "", F.concat(_origin(base), F.lit("/"))).otherwise(
        F.regexp_extract(base_no_query, r"^(.*/)", 1)
    )
    full = (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(_origin(base), href))
        .when(href.startswith("#"), F.concat(base_no_frag, href))
        .when(href.startswith("?"), F.concat(base_no_query, href))
        .when(href == "", base_no_frag)
        .otherwise(F.concat(directory, href))
    )
    return _without_dots(full)


def hrefs(html: Column) -> Column:
    """The href of every anchor in document order, trimmed, entities decoded."""
    tags = F.regexp_extract_all(html, F.lit(HREF_PATTERN), F.lit(0))
    value = lambda tag: F.concat(*[F.regexp_extract(tag, HREF_PATTERN, k) for k in (1, 2, 3)])
    return F.transform(tags, lambda tag: strip_ws(decode_entities(value(tag))))


def extract_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", markers: list[str] | None = None) -> DataFrame:
    """Anchors whose raw ``href`` contains one of ``markers`` (all anchors
    when ``markers`` is None), resolved to absolute, distinct in document
    order per page -> (id, pos, link)."""
    found = hrefs(F.col(html_col))
    if markers:
        found = F.filter(found, lambda h: contains_any(h, markers))
    pages = evaluate_once(pages, found, "_hrefs")
    links = F.array_distinct(F.transform("_hrefs", lambda h: resolve_url(h, F.col(url_col))))
    return pages.select(F.col(id_col), F.posexplode(links).alias("pos", "link"))


def extract_site_links(pages: DataFrame, sites: dict[str, list[str]], keep: list[str], site_col: str = "site",
                       url_col: str = "url", html_col: str = "html") -> DataFrame:
    """W1 for several sites in one scan: anchors whose raw ``href`` contains one of the
    markers of the page's own site, resolved, distinct in document order per page ->
    (the columns ``keep``, pos, link). Pages of other sites give no rows."""
    own = F.lit(None)
    for site, markers in sites.items():
        own = F.when(F.col(site_col) == site, F.array(*(F.lit(m) for m in markers))).otherwise(own)
    pages = pages.where(F.col(site_col).isin(list(sites)))
    found = F.filter(hrefs(F.col(html_col)), lambda h: F.exists(own, lambda m: F.contains(h, m)))
    pages = evaluate_once(pages, found, "_hrefs")
    links = F.array_distinct(F.transform("_hrefs", lambda h: resolve_url(h, F.col(url_col))))
    return pages.select(*keep, F.posexplode(links).alias("pos", "link"))


def first_seen_links(candidates: DataFrame, url_col: str = "url", pos_col: str = "pos") -> DataFrame:
    """W2 across a whole listing: keep detail-page links (trimmed, right prefix,
    id pattern), drop the fragment, and keep each link once at its first
    position. Query-string variants stay distinct."""
    kept = candidates.where(dom_link_kept(url_col)).select(
        drop_fragment(strip_ws(url_col)).alias("link"), F.col(pos_col)
    )
    return kept.groupBy("link").agg(F.min(pos_col).alias("first_pos"))


def jsonld_blocks(html: Column) -> Column:
    """Every ld+json script body, parsed; unparsable blocks are skipped."""
    raw = F.regexp_extract_all(html, F.lit(JSONLD_PATTERN), 1)
    return F.filter(F.transform(raw, lambda b: F.try_parse_json(b)), lambda v: v.isNotNull())


def jsonld_first(html: Column) -> Column:
    """The first ld+json block only; missing or unparsable -> null."""
    return F.try_parse_json(F.regexp_extract(html, JSONLD_PATTERN, 1))


def pick_job_posting(blocks: Column) -> Column:
    """First object block whose ``@type`` is JobPosting (or a list with it)."""
    return F.get(F.filter(blocks, is_job_posting), 0)


def is_valid_posting(ld: Column) -> Column:
    """Title, hiringOrganization.name and jobLocation all truthy.

    A non-object block (array, scalar) has no ``$.title``, so it fails the
    first test without a separate type check.
    """
    title = get(ld, "$.title", "variant")
    org_name = get(ld, "$.hiringOrganization.name", "variant")
    location = get(ld, "$.jobLocation", "variant")
    return truthy(title) & truthy(org_name) & truthy(location)


def is_challenge_page(html: Column, keywords: list[str] | None = None) -> Column:
    """The lower-cased page contains any bot-check keyword."""
    return contains_any(F.lower(html), keywords or S.CHALLENGE_KEYWORDS)


def is_posting_page(json_ld: Column, dom: Column) -> Column:
    """W10 (negated): keep when a JobPosting was found or the DOM has a title."""
    has_title = F.coalesce(dom["title"] != "", F.lit(False))
    return json_ld.isNotNull() | has_title


def not_postings(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages without a JobPosting block and without a DOM title; only pages
    without a block are parsed as HTML."""
    html = F.col(html_col)
    found = evaluate_once(pages, pick_job_posting(jsonld_blocks(html)), "_ld")
    rest = found.where(F.col("_ld").isNull())
    # A page that depends on ``_ld``: else the parse moves below it, to every page.
    rest = rest.withColumn("_dom", dom_record(F.when(F.col("_ld").isNull(), html)))
    return rest.where(~is_posting_page(F.col("_ld"), F.col("_dom"))).drop("_ld", "_dom")


def dom_records(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Detail pages -> raw DOM-source records
    (jobId, url, json_ld, dom, html_length, source), non-postings dropped."""
    html = F.col(html_col)
    keyed = pages.select(dom_job_id(url_col).alias("jobId"), F.col(url_col).alias("url"), html.alias("_html"))
    keyed = keyed.where(F.col("jobId").isNotNull())
    parsed = evaluate_once(keyed, pick_job_posting(jsonld_blocks(F.col("_html"))), "json_ld")
    # Also once: the filter below would else hold a second HTML parse of each page.
    parsed = evaluate_once(parsed, dom_record(F.col("_html")), "dom")
    rec = parsed.where(is_posting_page(F.col("json_ld"), F.col("dom"))).select(
        "jobId", "url", "json_ld", "dom",
        F.length("_html").cast("bigint").alias("html_length"),
        F.lit(S.SOURCE_DOM).alias("source"),
        F.lit(False).alias("synced_to_datalake"),
    )
    return rec


def jsonld_records(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Detail pages -> JSON-LD-source records
    (jobId, jobUrl, source, json_ld); challenge pages, pages without a first
    block and invalid postings are dropped."""
    html = F.col(html_col)
    rec = pages.where(~is_challenge_page(html)).select(
        jsonld_job_id(url_col).alias("jobId"),
        F.col(url_col).alias("jobUrl"),
        F.lit(S.SOURCE_JSONLD).alias("source"),
        html.alias("_html"),
    )
    rec = evaluate_once(rec, jsonld_first(F.col("_html")), "json_ld").drop("_html")
    ld = F.col("json_ld")
    # A block with a title is no empty one, so it is not tested for that.
    return rec.where(is_valid_posting(ld))
