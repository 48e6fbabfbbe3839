"""Schemas of the raw documents and the marts, plus fixed values.

Raw documents are schemaless upstream; declaring the schema here (instead of
inferring it) keeps one stray value such as ``salary: "oops"`` from turning
a whole column into strings and avoids the inference scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values the upstream crawlers and ETL use,
# so they are stated as plain text in their natural order.
# ---------------------------------------------------------------------------
SOURCE_API = "VietnamWorks"
SOURCE_JSONLD = "TopCV"
SOURCE_DOM = "Joboko"
SOURCE_UNKNOWN = "unknown"

DEFAULT_CURRENCY = "USD"
SALARY_RANGE_TYPE = "Range"
JOB_URL_TEMPLATE_PREFIX = "https://www.vietnamworks.com/job-"
JOB_URL_TEMPLATE_SUFFIX = "-jv"
CITY_SEPARATOR = ", "
FUNCTION_SEPARATOR = " > "
BENEFIT_SEPARATOR = ": "

SALARY_STRIP_PATTERN = "[^0-9.]"

DOM_LINK_PREFIX = "https://vn.joboko.com/viec-lam"
DOM_ID_PATTERN = r"-xvi(\d+)(?:$|[?#])"
DOM_ID_PREFIX = "joboko_"
JSONLD_ID_PREFIX = "topcv_"
JSONLD_LINK_MARKERS = ["/viec-lam/"]
DOM_LINK_MARKERS = ["/viec-lam", "/vacancies", "/viec-lam-"]

CHALLENGE_KEYWORDS = [
    "xác minh bạn là con người",
    "verify you are human",
    "captcha",
    "cloudflare",
]

JOB_POSTING_TYPE = "JobPosting"
SAMPLE_ROWS = 200
PAGE_BATCH_CAP = 50

# DOM fields: per field, CSS selectors tried in order (first non-empty wins).
DOM_TEXT_SELECTORS = {
    "title": ["h1", ".nw-company-hero__title"],
    "company": [".nw-company-hero__text a", ".nw-company-hero__text", ".nw-sidebar-company__title"],
    "locations": [".nw-company-hero__address", ".text-left.job-work-places"],
    "salary": [".text-left.job-base-infos", ".nw-job-list__main"],
}
DOM_HTML_SELECTORS = {
    "description_html": [".text-left.job-desc"],
    "requirements_html": [".text-left.job-requirement"],
    "benefits_html": [".text-left.job-benefit"],
}

# ---------------------------------------------------------------------------
# Raw API job (one element of a search response's ``data`` array).
# ---------------------------------------------------------------------------
API_JOB = T.StructType(
    [
        T.StructField("jobId", T.LongType()),
        T.StructField("jobUrl", T.StringType()),
        T.StructField("jobTitle", T.StringType()),
        T.StructField("jobDescription", T.StringType()),
        T.StructField("jobRequirement", T.StringType()),
        T.StructField("jobLevel", T.StringType()),
        T.StructField("yearsOfExperience", T.LongType()),
        T.StructField(
            "jobFunction",
            T.StructType(
                [
                    T.StructField("parentName", T.StringType()),
                    T.StructField(
                        "children",
                        T.ArrayType(T.StructType([T.StructField("name", T.StringType())])),
                    ),
                ]
            ),
        ),
        T.StructField(
            "industriesV3",
            T.ArrayType(T.StructType([T.StructField("industryV3Name", T.StringType())])),
        ),
        T.StructField("companyName", T.StringType()),
        T.StructField("companyProfile", T.StringType()),
        T.StructField("companySize", T.StringType()),
        T.StructField("companyLogo", T.StringType()),
        T.StructField("contactName", T.StringType()),
        T.StructField(
            "workingLocations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("address", T.StringType()),
                        T.StructField("cityName", T.StringType()),
                        T.StructField("cityNameVI", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "skills", T.ArrayType(T.StructType([T.StructField("skillName", T.StringType())]))
        ),
        T.StructField(
            "benefits",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("benefitName", T.StringType()),
                        T.StructField("benefitValue", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "salary",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("min", T.DoubleType()),
                    T.StructField("max", T.DoubleType()),
                    T.StructField("currency", T.StringType()),
                ]
            ),
        ),
        T.StructField("prettySalary", T.StringType()),
        T.StructField("onlineOn", T.StringType()),
        T.StructField("expiredDate", T.StringType()),
    ]
)

# Flattened (conformed) posting: the one schema all three sources map to.
POSTING_DDL = (
    "jobId string, source string, jobUrl string, jobTitle string, jobDescription string, "
    "jobRequirement string, jobLevel string, jobFunction string, industries array<string>, "
    "companyName string, companyProfile string, companySize string, companyLogo string, "
    "contactName string, workingLocations array<string>, cities array<string>, "
    "skills array<string>, benefits array<string>, salaryMin double, salaryMax double, "
    "salaryCurrency string, prettySalary string, yearsOfExperience bigint, "
    "postedDate string, expiredDate string, crawled_at timestamp"
)

DOM_RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in list(DOM_TEXT_SELECTORS) + list(DOM_HTML_SELECTORS)]
)

JOBS_FACT_DDL = (
    "job_id string, job_title string, company_name string, city string, "
    "salary_min double, salary_max double, posted_date date, salary_avg double, "
    "location string, level string, salary_currency string, source string"
)
JOB_SKILLS_DDL = "job_id string, skill_name string"

# Markers of complete snapshot runs: the folder below a landing root, and its rows.
RUN_MARKERS = "complete_runs"
RUN_MARKER_DDL = "collection string, run string, landed bigint"
