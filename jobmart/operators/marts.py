"""``jobs_fact`` and ``job_skills`` (P1–P8) from conformed or landed postings.

Both are narrow projections (no shuffle): Catalyst prunes the scan to the
columns used and fuses everything into one code-generated stage. When both
marts are written from one input, write the conformed postings once and read
them back rather than re-running the raw parse per output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart import schemas as S
from jobmart.functions.arrays import join_city
from jobmart.functions.text import parse_posted_date, parse_salary


def _type_of(df: DataFrame, name: str) -> T.DataType | None:
    """The type of an optional column, or None when the column is absent."""
    for field in df.schema.fields:
        if field.name == name:
            return field.dataType
    return None


def _optional(df: DataFrame, name: str, ddl: str = "string"):
    return F.col(name) if _type_of(df, name) is not None else F.lit(None).cast(ddl)


def jobs_fact(postings: DataFrame) -> DataFrame:
    """One row per posting.

    ``location`` (= city) and ``level`` (= jobLevel) are added so the salary
    model has its features; ``salary_currency`` and ``source`` are carried.
    """
    salary_min = parse_salary("salaryMin", _type_of(postings, "salaryMin"))
    salary_max = parse_salary("salaryMax", _type_of(postings, "salaryMax"))
    city = join_city(
        _optional(postings, "cities", "array<string>"),
        _optional(postings, "workingLocations", "array<string>"),
    )
    fact = postings.select(
        F.col("jobId").cast("string").alias("job_id"),
        _optional(postings, "jobTitle").alias("job_title"),
        _optional(postings, "companyName").alias("company_name"),
        city.alias("city"),
        salary_min.alias("salary_min"),
        salary_max.alias("salary_max"),
        parse_posted_date(_optional(postings, "postedDate")).alias("posted_date"),
        _optional(postings, "jobLevel").alias("level"),
        _optional(postings, "salaryCurrency").alias("salary_currency"),
        _optional(postings, "source").alias("source"),
    )
    # The salaries are columns here, so that their parse is not repeated for the average.
    return fact.select(
        "job_id", "job_title", "company_name", "city", "salary_min", "salary_max", "posted_date",
        ((F.col("salary_min") + F.col("salary_max")) / 2).alias("salary_avg"),
        F.col("city").alias("location"), "level", "salary_currency", "source",
    )


def job_skills(postings: DataFrame) -> DataFrame:
    """One row per (posting, skill); null/empty arrays and null skills drop."""
    skills_type = _type_of(postings, "skills")
    if not isinstance(skills_type, T.ArrayType):
        return postings.sparkSession.createDataFrame([], S.JOB_SKILLS_DDL)
    exploded = postings.select(
        F.col("jobId").cast("string").alias("job_id"),
        F.explode("skills").alias("skill"),
    )
    return exploded.select("job_id", F.col("skill").cast("string").alias("skill_name")).where(
        F.col("skill_name").isNotNull()
    )


def skill_report(fact: DataFrame, skills: DataFrame) -> DataFrame:
    """§2.9: postings and mean salary of each skill. Over marts that are bucketed on
    ``job_id`` the join needs no shuffle."""
    distinct = skills.groupBy("job_id", "skill_name").agg(F.lit(1).alias("_one")).drop("_one")
    joined = distinct.join(fact.select("job_id", "salary_avg"), "job_id")
    return joined.groupBy("skill_name").agg(
        F.count(F.lit(1)).alias("postings"), F.round(F.avg("salary_avg"), 4).alias("mean_salary")
    )
