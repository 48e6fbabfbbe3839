"""Conform raw documents of the three sources to one posting schema.

* ``unnest_response`` (S7/V1): search-response JSON -> one row per job.
* ``conform_api`` (V3–V13): raw API job struct -> flattened posting.
* ``conform_jsonld`` / ``conform_dom``: page-derived records -> postings.
* ``union_sources`` (S8): ``unionByName`` over the conformed sources.

All steps are narrow (per-row) transformations; the only shuffles in the
pipeline are the later key merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart import schemas as S
from jobmart.functions import arrays as A
from jobmart.functions.text import parse_salary_text
from jobmart.functions.variant import get, safe_list

_LOCATION = "struct<address string, cityName string, cityNameVI string>"
_NAMED = "struct<{}: string>"


def api_job_from_variant(v: Column) -> Column:
    """V1: typed job struct from a VARIANT job, one guarded field at a time.

    A non-object job gives all-null fields (id null -> rejected later); a
    wrong-typed list gives an empty list; a wrong-typed object gives nulls.
    """
    return F.struct(
        get(v, "$.jobId", "string").alias("jobId"),
        get(v, "$.jobUrl", "string").alias("jobUrl"),
        get(v, "$.jobTitle", "string").alias("jobTitle"),
        get(v, "$.jobDescription", "string").alias("jobDescription"),
        get(v, "$.jobRequirement", "string").alias("jobRequirement"),
        get(v, "$.jobLevel", "string").alias("jobLevel"),
        get(v, "$.yearsOfExperience", "bigint").alias("yearsOfExperience"),
        F.struct(
            get(v, "$.jobFunction.parentName", "string").alias("parentName"),
            safe_list(v, "$.jobFunction.children", _NAMED.format("name")).alias("children"),
        ).alias("jobFunction"),
        safe_list(v, "$.industriesV3", _NAMED.format("industryV3Name")).alias("industriesV3"),
        get(v, "$.companyName", "string").alias("companyName"),
        get(v, "$.companyProfile", "string").alias("companyProfile"),
        get(v, "$.companySize", "string").alias("companySize"),
        get(v, "$.companyLogo", "string").alias("companyLogo"),
        get(v, "$.contactName", "string").alias("contactName"),
        safe_list(v, "$.workingLocations", _LOCATION).alias("workingLocations"),
        safe_list(v, "$.skills", _NAMED.format("skillName")).alias("skills"),
        safe_list(v, "$.benefits", "struct<benefitName string, benefitValue string>").alias("benefits"),
        F.struct(
            get(v, "$.salary.type", "string").alias("type"),
            get(v, "$.salary.min", "double").alias("min"),
            get(v, "$.salary.max", "double").alias("max"),
            get(v, "$.salary.currency", "string").alias("currency"),
        ).alias("salary"),
        get(v, "$.prettySalary", "string").alias("prettySalary"),
        get(v, "$.onlineOn", "string").alias("onlineOn"),
        get(v, "$.expiredDate", "string").alias("expiredDate"),
    )


def unnest_response(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """Response text -> (job variant) rows; a non-list ``data`` -> no rows."""
    parsed = F.try_parse_json(F.col(body_col))
    return pages.select(F.explode(safe_list(parsed, "$.data")).alias("job_v"))


def _default_text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def salary_gate(salary: Column) -> tuple[Column, Column, Column]:
    """V9: min/max only for a ``Range`` salary (else 0); currency defaults to USD.

    No currency conversion happens anywhere; the currency is carried along.
    """
    is_range = F.coalesce(salary["type"] == S.SALARY_RANGE_TYPE, F.lit(False))
    low = F.when(is_range, F.coalesce(salary["min"].cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
    high = F.when(is_range, F.coalesce(salary["max"].cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
    currency = F.coalesce(salary["currency"], F.lit(S.DEFAULT_CURRENCY))
    return low, high, currency


def job_url(job: Column) -> Column:
    """Falsy URL -> the site's canonical job URL built from the id."""
    fallback = F.concat(
        F.lit(S.JOB_URL_TEMPLATE_PREFIX), job["jobId"].cast("string"), F.lit(S.JOB_URL_TEMPLATE_SUFFIX)
    )
    return F.coalesce(F.nullif(job["jobUrl"], F.lit("")), fallback)


def conform_api(df: DataFrame, job_col: str = "job", ingest_ts: Column | None = None) -> DataFrame:
    """Raw API job struct -> flattened posting (``schemas.POSTING_DDL``).

    ``ingest_ts`` defaults to ``current_timestamp()``; pass a column (for
    example the landed file's modification time) to make re-runs repeat.
    """
    job = F.col(job_col)
    low, high, currency = salary_gate(job["salary"])
    return df.select(
        job["jobId"].cast("string").alias("jobId"),
        F.lit(S.SOURCE_API).alias("source"),
        job_url(job).alias("jobUrl"),
        job["jobTitle"].alias("jobTitle"),
        _default_text(job["jobDescription"]).alias("jobDescription"),
        _default_text(job["jobRequirement"]).alias("jobRequirement"),
        _default_text(job["jobLevel"]).alias("jobLevel"),
        A.function_label(job["jobFunction"]).alias("jobFunction"),
        A.industry_names(job["industriesV3"]).alias("industries"),
        job["companyName"].alias("companyName"),
        _default_text(job["companyProfile"]).alias("companyProfile"),
        _default_text(job["companySize"]).alias("companySize"),
        _default_text(job["companyLogo"]).alias("companyLogo"),
        _default_text(job["contactName"]).alias("contactName"),
        A.address_list(job["workingLocations"]).alias("workingLocations"),
        A.city_list(job["workingLocations"]).alias("cities"),
        A.skill_names(job["skills"]).alias("skills"),
        A.benefit_strings(job["benefits"]).alias("benefits"),
        low.alias("salaryMin"),
        high.alias("salaryMax"),
        currency.alias("salaryCurrency"),
        _default_text(job["prettySalary"]).alias("prettySalary"),
        F.coalesce(job["yearsOfExperience"].cast("bigint"), F.lit(0).cast("bigint")).alias("yearsOfExperience"),
        job["onlineOn"].alias("postedDate"),
        job["expiredDate"].alias("expiredDate"),
        (ingest_ts if ingest_ts is not None else F.current_timestamp()).alias("crawled_at"),
    )


def split_rejects(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings without an id go to a rejects output instead of the
    text ``"None"`` the crawler would store."""
    ok = F.col("jobId").isNotNull()
    return postings.where(ok), postings.where(~ok)


def _plain_text(v: Column) -> Column:
    """A variant that is itself a string; null for any other value."""
    return F.when(F.schema_of_variant(v) == "STRING", get(v, "$", "string"))


def _text_list(ld: Column, path: str, split: bool) -> Column:
    """A list of texts, or one text (comma-separated where ``split``), as a list."""
    one = F.coalesce(_plain_text(get(ld, path, "variant")), F.lit(""))
    single = F.split(one, r"\s*,\s*") if split else F.array(one)
    return F.filter(F.coalesce(get(ld, path, "array<string>"), single), A.is_truthy_text)


def _amount(ld: Column, path: str) -> Column:
    """A salary bound: the number itself (its text form ``2.5E7`` must not be stripped),
    else parsed text, else a scalar ``baseSalary.value``, else 0."""
    bound = get(ld, f"$.baseSalary.value.{path}", "double")
    text = parse_salary_text(get(ld, f"$.baseSalary.value.{path}", "string"))
    return F.coalesce(F.abs(bound), text, F.abs(get(ld, "$.baseSalary.value", "double")), F.lit(0.0))


def _jsonld_fields(ld: Column) -> dict[str, Column]:
    """Posting fields read from a schema.org JobPosting variant.

    title, hiringOrganization.name/logo, jobLocation (object or list) address
    locality/region/street, baseSalary min/max value and currency,
    datePosted, validThrough, skills (comma text), industry.
    """
    locations = F.coalesce(
        get(ld, "$.jobLocation", "array<variant>"), F.array(get(ld, "$.jobLocation", "variant"))
    )
    localities = F.filter(
        F.transform(
            locations,
            lambda x: F.coalesce(
                F.nullif(_plain_text(x), F.lit("")),
                F.nullif(get(x, "$.address.addressLocality", "string"), F.lit("")),
                F.nullif(get(x, "$.address.addressRegion", "string"), F.lit("")),
            ),
        ),
        lambda c: c.isNotNull(),
    )
    streets = F.filter(
        F.transform(locations, lambda x: get(x, "$.address.streetAddress", "string")), A.is_truthy_text
    )
    return {
        "jobTitle": get(ld, "$.title", "string"),
        "jobDescription": _default_text(get(ld, "$.description", "string")),
        "jobRequirement": _default_text(get(ld, "$.qualifications", "string")),
        "jobLevel": _default_text(get(ld, "$.occupationalCategory", "string")),
        "jobFunction": F.lit(""),
        "industries": _text_list(ld, "$.industry", split=False),
        "companyName": get(ld, "$.hiringOrganization.name", "string"),
        "companyProfile": F.lit(""),
        "companySize": F.lit(""),
        "companyLogo": _default_text(get(ld, "$.hiringOrganization.logo", "string")),
        "contactName": F.lit(""),
        "workingLocations": streets,
        "cities": F.array_distinct(localities),
        "skills": _text_list(ld, "$.skills", split=True),
        "benefits": F.array().cast("array<string>"),
        "salaryMin": _amount(ld, "minValue"),
        "salaryMax": _amount(ld, "maxValue"),
        "salaryCurrency": F.coalesce(get(ld, "$.baseSalary.currency", "string"), F.lit(S.DEFAULT_CURRENCY)),
        "prettySalary": F.lit(""),
        "yearsOfExperience": F.lit(0).cast("bigint"),
        "postedDate": get(ld, "$.datePosted", "string"),
        "expiredDate": get(ld, "$.validThrough", "string"),
    }


def _posting(source: str, url: Column, fields: dict[str, Column], crawled_at: Column) -> list[Column]:
    head = [F.col("jobId").cast("string").alias("jobId"), F.lit(source).alias("source"), url.alias("jobUrl")]
    return head + [expr.alias(name) for name, expr in fields.items()] + [crawled_at.alias("crawled_at")]


def conform_jsonld(df: DataFrame) -> DataFrame:
    """JSON-LD records (jobId, jobUrl, crawled_at, json_ld variant) -> postings."""
    fields = _jsonld_fields(F.col("json_ld"))
    return df.select(*_posting(S.SOURCE_JSONLD, F.col("jobUrl"), fields, F.col("crawled_at")))


def _split_text_list(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s*,\s*"), A.is_truthy_text)


def conform_dom(df: DataFrame) -> DataFrame:
    """DOM records (jobId, url, fetched_at, json_ld variant or null, dom struct)
    -> postings. JSON-LD wins where present; DOM text fills the gaps."""
    fields = _jsonld_fields(F.col("json_ld"))
    dom = F.col("dom")
    fields["jobTitle"] = F.coalesce(F.nullif(fields["jobTitle"], F.lit("")), F.nullif(dom["title"], F.lit("")))
    fields["companyName"] = F.coalesce(
        F.nullif(fields["companyName"], F.lit("")), F.nullif(dom["company"], F.lit(""))
    )
    fields["cities"] = F.when(F.size(fields["cities"]) > 0, fields["cities"]).otherwise(
        F.array_distinct(_split_text_list(dom["locations"]))
    )
    fields["jobDescription"] = F.coalesce(F.nullif(fields["jobDescription"], F.lit("")), _default_text(dom["description_html"]))
    fields["jobRequirement"] = F.coalesce(F.nullif(fields["jobRequirement"], F.lit("")), _default_text(dom["requirements_html"]))
    fields["benefits"] = F.filter(F.array(dom["benefits_html"]), A.is_truthy_text)
    fields["prettySalary"] = _default_text(dom["salary"])
    return df.select(*_posting(S.SOURCE_DOM, F.col("url"), fields, F.col("fetched_at")))


def union_sources(*postings: DataFrame) -> DataFrame:
    """Conformed sources stacked by column name (missing columns -> null)."""
    out = postings[0]
    for other in postings[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
