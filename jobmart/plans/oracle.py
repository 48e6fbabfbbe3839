"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on views named after the driver's tables. The job feed is
rebuilt here from the same base columns as ``jobmart.sources.feed``; column
names match the Spark results one to one.
"""

from __future__ import annotations

# Orders joined to customer/nation/region, with the derived salary text,
# city and posted date of the job feed.
FEED_CTE = """
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderdate AS od,
         o.o_orderpriority AS prio, c.c_name, c.c_mktsegment, n.n_name, r.r_name,
         CAST(floor(o.o_totalprice) AS BIGINT) AS lo,
         CAST(floor(o.o_totalprice) AS BIGINT) + (o.o_custkey % 10) * 1000 AS hi
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
feed AS (
  SELECT *,
    CASE k % 6
      WHEN 0 THEN CAST(lo AS VARCHAR)
      WHEN 1 THEN '$' || CAST(lo // 1000 AS VARCHAR) || ',' || lpad(CAST(lo % 1000 AS VARCHAR), 3, '0')
      WHEN 2 THEN CAST(lo // 1000 AS VARCHAR) || '-' || CAST(hi // 1000 AS VARCHAR) || ' trieu'
      WHEN 3 THEN 'Thoa thuan'
      WHEN 4 THEN CAST(lo // 1000 AS VARCHAR) || '.' || lpad(CAST(lo % 1000 AS VARCHAR), 3, '0') || '.000'
    END AS smin_txt,
    CASE k % 6
      WHEN 0 THEN CAST(hi AS VARCHAR)
      WHEN 1 THEN '$' || CAST(hi // 1000 AS VARCHAR) || ',' || lpad(CAST(hi % 1000 AS VARCHAR), 3, '0')
      WHEN 2 THEN CAST(lo // 1000 AS VARCHAR) || '-' || CAST(hi // 1000 AS VARCHAR) || ' trieu'
      WHEN 3 THEN 'Thoa thuan'
      WHEN 4 THEN CAST(hi // 1000 AS VARCHAR) || '.' || lpad(CAST(hi % 1000 AS VARCHAR), 3, '0') || '.000'
    END AS smax_txt,
    CASE WHEN k % 7 = 0 THEN r_name WHEN k % 7 = 1 THEN '' ELSE n_name END AS city,
    CASE WHEN k % 11 IN (0, 2) THEN NULL ELSE CAST(od AS DATE) END AS posted_date
  FROM base
),
fact AS (
  SELECT CAST(k AS VARCHAR) AS job_id, prio AS job_title, c_name AS company_name, city,
         COALESCE(TRY_CAST(regexp_replace(smin_txt, '[^0-9.]', '', 'g') AS DOUBLE), 0.0) AS salary_min,
         COALESCE(TRY_CAST(regexp_replace(smax_txt, '[^0-9.]', '', 'g') AS DOUBLE), 0.0) AS salary_max,
         posted_date, city AS location, c_mktsegment AS level,
         'VND' AS salary_currency, 'VietnamWorks' AS source, k, ck
  FROM feed
)
"""

# Part types of each order's lines (the feed's skills), one row per line.
SKILL_LINES_CTE = """
skill_lines AS (
  SELECT l.l_orderkey AS k, l.l_linenumber, l.l_partkey, p.p_type, p.p_name, p.p_brand
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)
"""


def with_feed(body: str, *extra_ctes: str) -> str:
    ctes = ",".join([FEED_CTE, *extra_ctes])
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}

SQL["jobs_fact"] = with_feed(
    """
SELECT job_id, job_title, company_name, city, salary_min, salary_max, posted_date,
       (salary_min + salary_max) / 2 AS salary_avg, location, level, salary_currency, source
FROM fact
"""
)

SQL["job_skills"] = with_feed(
    """
SELECT CAST(s.k AS VARCHAR) AS job_id, s.p_type AS skill_name
FROM skill_lines s JOIN base b ON s.k = b.k
WHERE s.p_type IS NOT NULL
""",
    SKILL_LINES_CTE,
)

# Raw API jobs: per-line values and per-order aggregates in line order.
API_CTE = """
api_lines AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk,
         p.p_name, p.p_brand, p.p_type, sn.n_name AS s_nation,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) AS pos
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
),
api_agg AS (
  SELECT k,
    string_agg(CASE WHEN ln % 3 = 0 THEN NULL ELSE 'Warehouse ' || CAST(sk AS VARCHAR) END, '|' ORDER BY pos) AS addresses,
    string_agg(CASE WHEN ln % 4 = 0 THEN NULL ELSE p_name END, ', ' ORDER BY pos) AS children,
    string_agg(CASE WHEN ln % 5 = 0 THEN NULL ELSE p_type END, '|' ORDER BY pos) AS industries,
    string_agg(CASE WHEN ln % 4 = 3 THEN NULL ELSE p_type END, '|' ORDER BY pos) AS skills,
    string_agg(CASE WHEN ln % 5 = 4 THEN NULL
                    ELSE p_brand || ': ' || CASE WHEN ln % 6 = 0 THEN ''
                                                 ELSE p_name || ' ' || p_brand || ' #' || CAST(ln AS VARCHAR) END
               END, '|' ORDER BY pos) AS benefits,
    count(*) FILTER (WHERE ln % 5 <> 4) AS n_benefits,
    max(CASE WHEN pos = 1 THEN p_brand END) AS first_brand
  FROM api_lines GROUP BY k
),
api_city_first AS (
  SELECT k, city, min(pos) AS pos FROM (
    SELECT k, pos, COALESCE(NULLIF(CASE WHEN ln % 3 = 0 THEN s_nation WHEN ln % 3 = 1 THEN '' END, ''),
                            'VN-' || s_nation) AS city
    FROM api_lines) GROUP BY k, city
),
api_cities AS (SELECT k, string_agg(city, '|' ORDER BY pos) AS cities FROM api_city_first GROUP BY k),
api_raw AS (
  SELECT b.*, COALESCE(a.addresses, '') AS addresses, COALESCE(a.children, '') AS children,
         COALESCE(a.industries, '') AS industries, COALESCE(a.skills, '') AS skills,
         COALESCE(a.benefits, '') AS benefits, COALESCE(a.n_benefits, 0) AS n_benefits,
         COALESCE(c.cities, '') AS cities,
         CASE WHEN b.k % 4 = 0 THEN NULL WHEN b.k % 4 = 1 THEN '' ELSE a.first_brand END AS parent
  FROM base b LEFT JOIN api_agg a ON a.k = b.k LEFT JOIN api_cities c ON c.k = b.k
),
api AS (
  SELECT CAST(k AS VARCHAR) AS jobId, 'VietnamWorks' AS source,
    CASE WHEN k % 5 IN (0, 1) THEN 'https://www.vietnamworks.com/job-' || CAST(k AS VARCHAR) || '-jv'
         ELSE 'https://jobs.example.com/' || CAST(k AS VARCHAR) END AS jobUrl,
    prio AS jobTitle, c_name AS companyName,
    CASE WHEN k % 4 = 0 THEN '' ELSE 'Orders of ' || c_name END AS jobDescription,
    CASE WHEN k % 4 = 1 THEN '' ELSE r_name END AS jobRequirement,
    CASE WHEN k % 9 = 0 THEN '' ELSE c_mktsegment END AS jobLevel,
    CASE WHEN parent <> '' AND children <> '' THEN parent || ' > ' || children
         WHEN parent <> '' THEN parent ELSE children END AS jobFunction,
    industries, addresses AS workingLocations, cities, skills, benefits, CAST(n_benefits AS BIGINT) AS n_benefits,
    CASE WHEN k % 3 = 0 THEN CAST(lo AS DOUBLE) ELSE 0.0 END
      * CASE WHEN k % 3 = 0 AND k % 10 = 3 THEN 0.0 ELSE 1.0 END AS salaryMin,
    CASE WHEN k % 3 = 0 THEN CAST(lo + 1000 AS DOUBLE) ELSE 0.0 END AS salaryMax,
    CASE WHEN k % 4 = 0 THEN 'USD' ELSE 'VND' END AS salaryCurrency,
    CASE WHEN k % 3 = 0 THEN '' ELSE n_name END AS companyProfile,
    '' AS companySize, '' AS companyLogo,
    CASE WHEN k % 2 = 0 THEN '' ELSE c_name END AS contactName,
    CASE WHEN k % 2 = 0 THEN '' ELSE 'Negotiable' END AS prettySalary,
    CAST(CASE WHEN k % 8 = 0 THEN 0 ELSE k % 10 END AS BIGINT) AS yearsOfExperience,
    strftime(od, '%Y-%m-%d') AS postedDate,
    strftime(CAST(od AS DATE) + 30, '%Y-%m-%d') AS expiredDate,
    k
  FROM api_raw
)
"""


def with_api(body: str) -> str:
    return with_feed(body, API_CTE)


SQL["unnest_response"] = with_api(
    """
SELECT jobId, source, jobUrl, jobTitle, jobLevel, jobFunction, industries, workingLocations, cities,
       skills, benefits, salaryMin, salaryMax, salaryCurrency, prettySalary, yearsOfExperience,
       postedDate, expiredDate, companyProfile, contactName, jobDescription
FROM api
"""
)
SQL["location_lists"] = with_api("SELECT jobId, workingLocations, cities FROM api")
SQL["function_label"] = with_api("SELECT jobId, jobFunction FROM api")
SQL["benefit_strings"] = with_api("SELECT jobId, benefits, n_benefits FROM api")
SQL["industry_names"] = with_api("SELECT jobId, skills, industries FROM api")
SQL["salary_gate"] = with_api("SELECT jobId, salaryMin, salaryMax, salaryCurrency FROM api")
SQL["defaults_url"] = with_api(
    """
SELECT jobId, source, jobUrl, jobTitle, companyName, jobDescription, jobRequirement, jobLevel,
       companyProfile, companySize, companyLogo, contactName, prettySalary, yearsOfExperience,
       postedDate, expiredDate, '2024-02-01 00:00:00' AS crawled_at
FROM api
"""
)

_CLEAN = "regexp_replace(regexp_replace({c}, '\\r?\\n', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
SQL["clean_text"] = f"""
SELECT 'documents' AS origin, doc_id AS row_id, CAST(NULL AS BIGINT) AS turn,
       COALESCE({_CLEAN.format(c='text')}, '') AS clean
FROM documents
UNION ALL
SELECT 'conversations' AS origin, conv_id AS row_id, turn,
       COALESCE({_CLEAN.format(c='text')}, '') AS clean
FROM conversations
"""

# ---------------------------------------------------------------------------
# Web pages
# ---------------------------------------------------------------------------
JP_CTE = """
jp AS (
  SELECT k, prio, c_name, c_mktsegment, n_name, r_name, lo, od, k % 8 AS k8, k % 13 = 5 AS challenge,
         k % 16 = 8 AS other_forms,
         CASE WHEN k % 8 IN (0, 3) THEN CASE WHEN k % 16 = 8 THEN lo + 25000000.0 ELSE lo * 1.0 END ELSE 0.0 END AS jp_min,
         CASE WHEN k % 8 IN (0, 3) THEN CASE WHEN k % 16 = 8 THEN (lo + 25000000.0) * 2 ELSE lo + 1000.0 END ELSE 0.0 END AS jp_max
  FROM base
)
"""

_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
_HREFS = "regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)"
_ORIGIN = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
_RESOLVE = f"""
CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
     WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1) || href
     WHEN starts_with(href, '/') THEN {_ORIGIN} || href
     WHEN starts_with(href, '#') THEN split_part(url, '#', 1) || href
     WHEN starts_with(href, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || href
     WHEN href = '' THEN split_part(url, '#', 1)
     ELSE CASE WHEN regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) = ''
               THEN {_ORIGIN} || '/'
               ELSE regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '^(.*/)', 1) END || href
END"""

SQL["page_links"] = f"""
WITH a AS (
  SELECT page_id, url, unnest(hs) AS href, generate_subscripts(hs, 1) AS i
  FROM (SELECT page_id, url, {_HREFS} AS hs FROM pages)
),
r AS (SELECT page_id, {_RESOLVE} AS link, i FROM a),
f AS (SELECT page_id, link, min(i) AS fi FROM r GROUP BY page_id, link)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY fi) - 1 AS pos, link FROM f
"""

CANDIDATES_CTE = """
cand AS (
  SELECT page_id AS pos, url FROM pages
  UNION ALL
  SELECT 10000000000 + k * 2 AS pos,
         'https://vn.joboko.com/viec-lam-' || lower(regexp_replace(prio, '[^A-Za-z0-9]+', '-', 'g')) || '-xvi' || CAST(k AS VARCHAR) AS url
  FROM base
  UNION ALL
  SELECT 10000000000 + k * 2 + 1 AS pos,
         CASE k % 6
           WHEN 0 THEN p WHEN 1 THEN p || '#top' WHEN 2 THEN p || '?u=1' WHEN 3 THEN p || 'b'
           WHEN 4 THEN '  ' || p || '#x '
           ELSE 'https://other.example/viec-lam-a-xvi' || CAST(k AS VARCHAR) END AS url
  FROM (SELECT k, 'https://vn.joboko.com/viec-lam-' || lower(regexp_replace(prio, '[^A-Za-z0-9]+', '-', 'g')) || '-xvi' || CAST(k AS VARCHAR) AS p FROM base)
)
"""
_DOM_ID = "CASE WHEN regexp_extract({u}, '-xvi(\\d+)(?:$|[?#])', 1) <> '' THEN 'joboko_' || regexp_extract({u}, '-xvi(\\d+)(?:$|[?#])', 1) END"
_TOPCV_ID = "'topcv_' || split_part(regexp_extract({u}, '[^/]*$', 0), '.', 1)"

SQL["link_filter"] = with_feed(
    f"""
SELECT link, min(pos) AS first_pos, {_DOM_ID.format(u='link')} AS job_id
FROM (
  SELECT split_part(s, '#', 1) AS link, pos FROM (SELECT {_STRIP.format(x='url')} AS s, pos FROM cand)
  WHERE s <> '' AND starts_with(s, 'https://vn.joboko.com/viec-lam') AND regexp_matches(s, '-xvi\\d+(?:$|[?#])')
)
GROUP BY link
""",
    CANDIDATES_CTE,
)

_TOPCV_URL = "'https://www.topcv.vn/viec-lam/' || lower(regexp_replace(prio, '[^A-Za-z0-9]+', '-', 'g')) || '/' || CAST(k AS VARCHAR) || '.html?ta=x'"
SQL["url_ids"] = with_feed(
    f"""
SELECT url, {_DOM_ID.format(u='url')} AS joboko_id, {_TOPCV_ID.format(u='url')} AS topcv_id
FROM (SELECT url FROM cand UNION ALL SELECT {_TOPCV_URL} AS url FROM base)
""",
    CANDIDATES_CTE,
)

SQL["jsonld_blocks"] = with_feed(
    """
SELECT k AS job_id, 0 AS pos,
       CASE k8 WHEN 1 THEN '["Thing","JobPosting"]' WHEN 2 THEN 'WebSite' WHEN 5 THEN NULL ELSE 'JobPosting' END AS block_type
FROM jp WHERE k8 <> 4
UNION ALL
SELECT k AS job_id, 1 AS pos, 'WebSite' AS block_type FROM jp WHERE k8 = 5
""",
    JP_CTE,
)

SQL["jsonld_first"] = with_feed(
    """
SELECT k AS job_id, CASE WHEN k8 IN (0, 1, 7) THEN prio WHEN k8 = 6 THEN '' END AS title
FROM jp WHERE k8 NOT IN (3, 4)
""",
    JP_CTE,
)

SQL["jsonld_pick"] = with_feed(
    """
SELECT k AS job_id, CASE WHEN k8 = 6 THEN '' ELSE prio END AS title,
       CASE WHEN k8 = 7 THEN NULL ELSE c_name END AS company
FROM jp WHERE k8 IN (0, 1, 3, 6, 7)
""",
    JP_CTE,
)

SQL["valid_postings"] = with_feed(
    """
SELECT 'topcv_' || CAST(k AS VARCHAR) AS jobId, prio AS jobTitle, c_name AS companyName,
       CASE WHEN k8 = 0 THEN n_name ELSE n_name || '|' || r_name END AS cities,
       CAST(jp_min AS DOUBLE) AS salaryMin, CAST(jp_max AS DOUBLE) AS salaryMax,
       CASE WHEN k8 = 0 THEN strftime(od, '%Y-%m-%d') END AS postedDate,
       CASE WHEN other_forms THEN 'sales|' || r_name ELSE '' END AS skills,
       CASE WHEN other_forms THEN c_mktsegment || '|' || r_name ELSE '' END AS industries
FROM jp WHERE k8 IN (0, 1) AND NOT challenge
""",
    JP_CTE,
)

# Pages hold at most an h1; the detail pages' fields come from the base columns.
SQL["dom_fields"] = with_feed(
    """
SELECT 'pages' AS origin, page_id,
       trim(replace(replace(replace(replace(
         regexp_replace(regexp_extract(html, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS title,
       '' AS company, '' AS locations, '' AS salary, '' AS description_html, '' AS requirements_html, '' AS benefits_html
FROM pages
UNION ALL
SELECT 'detail', k, prio || ' & café',
       CASE k % 3 WHEN 1 THEN c_name || ' <VN>' ELSE c_name END,
       n_name, CASE WHEN k % 5 = 2 THEN CAST(lo AS VARCHAR) ELSE CAST(lo AS VARCHAR) || ' VND' END,
       'part one<div>inner ' || r_name || '</div>part two',
       '<p>' || c_mktsegment || '</p><section>deep</section>end', 'none &amp; all'
FROM base
"""
)

SQL["listing_links"] = with_feed(
    """
SELECT site, k AS list_id, CAST(row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS BIGINT) AS pos,
       'https://www.' || site || '.vn' || path AS link
FROM (
  SELECT k, site, unnest(paths) AS path, unnest(range(len(paths))) AS i FROM (
    SELECT k, CASE WHEN k % 2 = 0 THEN 'topcv' ELSE 'joboko' END AS site, CASE WHEN k % 2 = 0
      THEN ['/viec-lam/a-' || k || '.html?x=1&y=2', '/list/viec-lam/b-' || k, '/viec-lam/c']
      ELSE ['/viec-lam/a-' || k || '.html?x=1&y=2', '/list/viec-lam/b-' || k, '/viec-lam/c',
            '/list/all/viec-lam-' || k, '/vacancies/' || k] END AS paths
    FROM base
  )
)
"""
)

SQL["page_length"] = "SELECT page_id, CAST(length(html) AS BIGINT) AS html_length FROM pages"

SQL["not_posting"] = with_feed("SELECT k AS job_id FROM jp WHERE k8 = 4 AND k % 3 = 0", JP_CTE)

_BLOCKED = (
    "(contains(lower({b}), 'xác minh bạn là con người') OR contains(lower({b}), 'verify you are human')"
    " OR contains(lower({b}), 'captcha') OR contains(lower({b}), 'cloudflare'))"
)
SQL["challenge_filter"] = with_feed(
    f"""
SELECT 'pages' AS origin, page_id AS row_id, {_BLOCKED.format(b='html')} AS blocked FROM pages
UNION ALL
SELECT 'documents' AS origin, doc_id AS row_id, {_BLOCKED.format(b='text')} AS blocked FROM documents
UNION ALL
SELECT 'detail' AS origin, k AS row_id, challenge AS blocked FROM jp
""",
    JP_CTE,
)

# ---------------------------------------------------------------------------
# Event log: upserts, landing, counters
# ---------------------------------------------------------------------------
_EV = "event_id, ts, user_id, event_type, value, props"
_CUT = "TIMESTAMP '2024-01-15 00:00:00'"

SQL["upsert_last_wins"] = f"""
SELECT {_EV} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

# Events of which one in eleven lacks the key.
_KEYED = """
kv AS (SELECT event_id, ts, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, event_type, value, props FROM events)
"""

SQL["key_rejects"] = "SELECT event_id, ts, event_type FROM events WHERE event_id % 11 = 0 OR user_id IS NULL"

SQL["upsert_fields"] = f"""
WITH {_KEYED}, u AS (
  SELECT user_id, ts, event_id,
         CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_type <> 'view' THEN value END AS value,
         CASE WHEN event_type <> 'click' THEN props END AS props,
         event_id % 2 = 0 AS flag, ts >= {_CUT} AS new
  FROM kv WHERE user_id IS NOT NULL
    AND CASE WHEN ts >= {_CUT} THEN user_id % 5 <> 0 ELSE user_id % 3 <> 0 END
)
SELECT user_id,
       arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type IS NOT NULL) AS event_type,
       arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL) AS value,
       arg_max(props, (ts, event_id)) FILTER (WHERE props IS NOT NULL) AS props,
       max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
       CASE WHEN bool_or(new) THEN false ELSE arg_max(flag, (ts, event_id)) END AS synced_to_datalake
FROM u GROUP BY user_id
"""

SQL["insert_if_absent"] = f"""
WITH {_KEYED}, ex AS (
  SELECT {_EV} FROM kv WHERE event_type = 'signup' AND user_id IS NOT NULL AND user_id % 3 <> 0
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
),
nb AS (
  SELECT {_EV} FROM kv
  WHERE event_type <> 'signup' AND user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM ex)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
)
SELECT {_EV} FROM ex UNION ALL SELECT {_EV} FROM nb
"""

SQL["upsert_counts"] = f"""
WITH {_KEYED},
     b AS (SELECT user_id, count(*) AS n FROM kv WHERE ts >= {_CUT} AND user_id IS NOT NULL GROUP BY user_id),
     e AS (SELECT DISTINCT user_id FROM kv WHERE ts < {_CUT} AND user_id % 3 <> 0)
SELECT CAST(sum(n) AS BIGINT) AS batch_rows, CAST(count(*) AS BIGINT) AS batch_keys,
       CAST(count(*) FILTER (WHERE e.user_id IS NULL) AS BIGINT) AS inserted,
       CAST(count(*) FILTER (WHERE e.user_id IS NOT NULL) AS BIGINT) AS updated,
       (SELECT count(*) FROM kv WHERE ts >= {_CUT} AND user_id IS NULL) AS rejected
FROM b LEFT JOIN e ON b.user_id = e.user_id
"""

SQL["new_keys"] = """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events)
SELECT DISTINCT b.day, b.user_id FROM d b
WHERE NOT EXISTS (SELECT 1 FROM d s WHERE s.user_id = b.user_id AND s.day < b.day)
"""

SQL["batch_cap"] = """
SELECT event_id, day, CASE WHEN rn <= 50 THEN rn END AS rank, rn > 50 AS pending
FROM (SELECT event_id, CAST(ts AS DATE) AS day,
             row_number() OVER (PARTITION BY CAST(ts AS DATE)
               ORDER BY CASE WHEN event_id % 13 <> 0 THEN date_trunc('hour', ts) END NULLS FIRST, event_id) AS rn
      FROM events)
"""

SQL["unsynced"] = "SELECT event_id, user_id FROM events WHERE event_id % 3 <> 0"

SQL["landing_paths"] = """
WITH d AS (
  SELECT event_id,
         COALESCE(CASE WHEN event_id % 10 <> 0 THEN 'evt_' || CAST(event_id AS VARCHAR) END,
                  'oid_' || CAST(event_id AS VARCHAR)) AS doc_key,
         COALESCE(CASE WHEN event_type <> 'error' THEN event_type END, 'unknown') AS source,
         CASE WHEN event_id % 18 = 0 THEN TIMESTAMP '2024-01-20 12:00:00'
              WHEN event_id % 9 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS lts
  FROM events
)
SELECT event_id, doc_key, source, CAST(lts AS DATE) AS day,
       source || '/' || strftime(lts, '%Y/%m/%d') || '/' || doc_key || '.json' AS path
FROM d
"""

SQL["load_counters"] = """
WITH f AS (
  SELECT event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
),
d AS (SELECT CAST(e.ts AS DATE) AS day, f.event_id IS NOT NULL AS saved
      FROM events e LEFT JOIN f ON e.event_id = f.event_id)
SELECT day, CAST(count(*) AS BIGINT) AS found, CAST(count(*) FILTER (WHERE saved) AS BIGINT) AS saved
FROM d GROUP BY ROLLUP (day)
"""

SQL["sync_counts"] = """
SELECT source, CAST(count(*) AS BIGINT) AS synced
FROM (SELECT COALESCE(CASE WHEN event_type <> 'error' THEN event_type END, 'unknown') AS source
      FROM events WHERE event_id % 3 <> 0)
GROUP BY ROLLUP (source)
"""

SQL["latest_partition"] = f"""
SELECT {_EV} FROM events
WHERE event_id % 17 <> 0 AND CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_id % 17 <> 0)
"""
SQL["legacy_snapshot"] = """
SELECT event_id, 'o' || event_id AS doc_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS at FROM events
"""
SQL["landing_dedup"] = """
SELECT event_type AS source, CAST(ts AS DATE) AS day, user_id AS doc_key, ts, event_id, value FROM events
WHERE event_type IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) = 1
"""
SQL["landed_ledger"] = """
SELECT CASE WHEN event_id % 10 <> 0 THEN 'evt_' ELSE 'oid_' END || event_id AS doc_key, event_id,
       CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 2 END AS run,
       COALESCE(CASE WHEN event_type <> 'error' THEN event_type END, 'unknown') AS source
FROM events WHERE event_id % 3 <> 0
"""
SQL["snapshot_roundtrip"] = f"SELECT {_EV} FROM events"
SQL["json_documents"] = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at, 'é ' || event_type AS note FROM events
"""
SQL["land_collections"] = f"SELECT 'raw_' || (event_id % 3) AS collection, {_EV} FROM events"
SQL["snapshot_runs"] = f"SELECT 'raw_' || (event_id % 2) AS collection, '02' AS run, {_EV} FROM events"
SQL["run_counts"] = f"""
SELECT 'raw_' || (event_id % 2) AS collection, run, count(*) AS landed, count(*) AS stored
FROM events JOIN (VALUES ('01'), ('02')) runs(run) ON run = '02' OR ts < {_CUT}
GROUP BY 1, 2
"""
SQL["parquet_roundtrip"] = SQL["jobs_fact"]
SQL["csv_sample"] = SQL["jobs_fact"] + "\nORDER BY job_id LIMIT 200"
SQL["skills_roundtrip"] = SQL["job_skills"]
SQL["skills_sample"] = SQL["job_skills"] + "\nORDER BY job_id, skill_name LIMIT 200"

SQL["union_sources"] = with_feed(
    """
SELECT jobId AS job_id, 'VietnamWorks' AS source, jobTitle AS job_title, companyName AS company_name,
       replace(cities, '|', ', ') AS city, salaryMin AS salary_min, salaryMax AS salary_max,
       CAST(od AS DATE) AS posted_date, (salaryMin + salaryMax) / 2 AS salary_avg
FROM api JOIN base USING (k)
UNION ALL
SELECT 'topcv_' || CAST(k AS VARCHAR), 'TopCV', prio, c_name,
       CASE WHEN k8 = 0 THEN n_name ELSE n_name || ', ' || r_name END,
       jp_min, jp_max, CASE WHEN k8 = 0 THEN CAST(od AS DATE) END, (jp_min + jp_max) / 2
FROM jp WHERE k8 IN (0, 1) AND NOT challenge
UNION ALL
SELECT 'joboko_' || CAST(k AS VARCHAR), 'Joboko', prio,
       CASE WHEN k8 IN (0, 1, 3, 6) THEN c_name END,
       CASE WHEN k8 IN (0, 3, 6) THEN n_name WHEN k8 = 1 THEN n_name || ', ' || r_name ELSE '' END,
       jp_min, jp_max, CASE WHEN k8 IN (0, 3) THEN CAST(od AS DATE) END, (jp_min + jp_max) / 2
FROM jp WHERE NOT (k8 = 4 AND k % 3 = 0)
""",
    API_CTE,
    JP_CTE,
)

# Streams whose files arrive in the order of time: the batch merges' results.
SQL["stream_first_wins"] = f"""
SELECT {_EV} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
"""
SQL["stream_last_wins"] = SQL["upsert_last_wins"]
SQL["stream_landing"] = f"SELECT {_EV} FROM events WHERE event_id % 3 <> 0"

# Model inputs
SQL["train_source"] = with_feed(
    """
SELECT job_id, location, level, (salary_min + salary_max) / 2 AS salary_avg
FROM fact WHERE (salary_min + salary_max) / 2 > 0
"""
)
SQL["string_index"] = with_feed(
    """
SELECT location, CAST(row_number() OVER (ORDER BY n DESC, location) - 1 AS DOUBLE) AS loc_idx
FROM (SELECT location, count(*) AS n FROM fact WHERE (salary_min + salary_max) / 2 > 0 GROUP BY location)
"""
)


_MD5_SPLIT = "('0x' || substr(md5(job_id), 1, 8))::BIGINT % 100 < 80"
_ROWS = f"""
train_rows AS (
  SELECT job_id, location, level, (salary_min + salary_max) / 2 AS salary_avg, {_MD5_SPLIT} AS is_train
  FROM fact WHERE (salary_min + salary_max) / 2 > 0
),
feats AS (
  SELECT t.*, coalesce(l.m, o.m) AS location_mean, coalesce(v.m, o.m) AS level_mean
  FROM train_rows t
  LEFT JOIN (SELECT location, avg(salary_avg) AS m FROM train_rows WHERE is_train GROUP BY 1) l ON l.location = t.location
  LEFT JOIN (SELECT level, avg(salary_avg) AS m FROM train_rows WHERE is_train GROUP BY 1) v ON v.level = t.level
  CROSS JOIN (SELECT avg(salary_avg) AS m FROM train_rows WHERE is_train) o
)
"""
SQL["hash_split"] = with_feed("SELECT job_id, is_train FROM train_rows", _ROWS)
SQL["feature_rows"] = with_feed("SELECT job_id, is_train, salary_avg, location_mean, level_mean FROM feats", _ROWS)
SQL["rmse"] = with_feed(
    """
SELECT round(sqrt(avg(pow(salary_avg - location_mean, 2)) FILTER (WHERE NOT is_train)), 2) AS rmse,
       count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test
FROM feats
""",
    _ROWS,
)
SQL["salary_model"] = with_feed(
    """
SELECT count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test, true AS within
FROM train_rows
""",
    _ROWS,
)
_STEP = "coalesce(('0x' || substr(md5({c}), 1, 4))::BIGINT % 5, 0)"
_SIGNAL = f"""
signal AS (
  SELECT job_id, location, level, {_MD5_SPLIT} AS is_train,
    (salary_min + salary_max) / 2 % 10000 + {_STEP.format(c="location")} * 5000 + {_STEP.format(c="level")} * 9000 + 1 AS y
  FROM fact WHERE (salary_min + salary_max) / 2 > 0
),
cells AS (
  SELECT s.is_train, s.y, coalesce(m.m, o.m) AS cell_mean
  FROM signal s
  LEFT JOIN (SELECT location, level, avg(y) AS m FROM signal WHERE is_train GROUP BY 1, 2) m
    ON m.location IS NOT DISTINCT FROM s.location AND m.level IS NOT DISTINCT FROM s.level
  CROSS JOIN (SELECT avg(y) AS m FROM signal WHERE is_train) o
)
"""
SQL["salary_signal"] = with_feed(
    """
SELECT count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test,
       round(sqrt(avg(pow(y - cell_mean, 2)) FILTER (WHERE NOT is_train)), 2) AS cells_rmse,
       round(stddev_pop(y) FILTER (WHERE NOT is_train), 2) AS spread, true AS near_cells, true AS below_spread
FROM cells
""",
    _SIGNAL,
)
SQL["model_reload"] = with_feed("SELECT job_id, true AS same FROM train_rows", _ROWS)

SQL["salary_parse"] = with_feed(
    """
SELECT CAST(b.k AS VARCHAR) AS jobId, f.salary_min AS from_text, CAST(b.lo * 100 AS DOUBLE) AS from_whole,
       CAST(b.lo * 100 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS from_real
FROM base b JOIN fact f ON f.k = b.k
"""
)
SQL["city_fallback"] = with_feed("SELECT CAST(k AS VARCHAR) AS jobId, city FROM feed")
SQL["optional_columns"] = with_feed(
    """
SELECT CAST(b.k AS VARCHAR) AS job_id, CAST(NULL AS VARCHAR) AS job_title, CAST(NULL AS VARCHAR) AS company_name,
       b.r_name AS city, CAST(0 AS DOUBLE) AS salary_min, f.salary_max, CAST(NULL AS DATE) AS posted_date,
       f.salary_max / 2 AS salary_avg, b.r_name AS location, CAST(NULL AS VARCHAR) AS level,
       CAST(NULL AS VARCHAR) AS salary_currency, CAST(NULL AS VARCHAR) AS source
FROM base b JOIN fact f ON f.k = b.k
"""
)

# Stored tables and streams with state end up with the same rows as the batch merges.
SQL["stored_upsert"] = SQL["upsert_fields"]
SQL["stored_insert"] = SQL["insert_if_absent"]
SQL["landed_objects"] = SQL["landing_dedup"]
SQL["state_last_wins"] = SQL["stream_last_wins"]
SQL["state_first_wins"] = SQL["stream_first_wins"]
SQL["stream_new_keys"] = f"""
SELECT user_id, CAST(CASE WHEN min(ts) < {_CUT} THEN 1 ELSE 2 END AS INTEGER) AS run
FROM events GROUP BY user_id
"""
SQL["landing_progress"] = f"""
WITH d AS (
  SELECT CAST(ts >= {_CUT} AS BIGINT) AS batch, event_id % 3 <> 0 AS wanted,
         COALESCE(CASE WHEN event_type <> 'error' THEN event_type END, 'unknown') AS source FROM events
), b AS (SELECT batch, count(*) AS batch_found, count(*) FILTER (wanted) AS batch_landed FROM d GROUP BY batch)
SELECT batch, source, count(*) AS landed, any_value(batch_found) AS batch_found, any_value(batch_landed) AS batch_landed
FROM d JOIN b USING (batch) WHERE wanted GROUP BY batch, source
"""
SQL["file_rejects"] = """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, min(event_id) AS id FROM events GROUP BY 1)
SELECT day, 'read' AS outcome, n FROM d
UNION ALL
SELECT day, CASE id % 5 WHEN 2 THEN 'empty' WHEN 4 THEN 'no document' ELSE 'not json' END, 1 FROM d
"""
SQL["file_times"] = """
SELECT event_id, 'source=' || event_type || '/dt=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS folder, true AS same FROM events
"""
SQL["skill_report"] = with_feed(
    """
SELECT skill_name, count(*) AS postings, round(avg((salary_min + salary_max) / 2), 4) AS mean_salary
FROM (SELECT DISTINCT CAST(s.k AS VARCHAR) AS job_id, s.p_type AS skill_name
      FROM skill_lines s JOIN base b ON s.k = b.k WHERE s.p_type IS NOT NULL) JOIN fact USING (job_id)
GROUP BY skill_name
""",
    SKILL_LINES_CTE,
)
SQL["label_encoder"] = with_feed(
    f"""
, encoded AS (
  SELECT job_id, nullif(location, '') AS location, {_MD5_SPLIT} AS is_train FROM fact
), labels AS (
  SELECT location, row_number() OVER (ORDER BY count(*) DESC, location) - 1 AS i
  FROM encoded WHERE is_train AND location <> 'ASIA' GROUP BY location
)
SELECT e.job_id, e.location, CAST(coalesce(i, (SELECT count(*) FROM labels)) AS DOUBLE) AS loc_idx
FROM encoded e LEFT JOIN labels USING (location) WHERE NOT is_train
"""
)
