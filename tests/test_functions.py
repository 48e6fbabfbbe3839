"""Column helpers on hand-made edge cases (FIXTURES.md §2, §5)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.functions import arrays as A
from jobmart.functions import text as X
from jobmart.functions.variant import is_job_posting, truthy


def test_salary_text_parse(spark):
    rows = [("$1,000",), ("10-20 trieu",), ("1.000.000",), ("Thoa thuan",), ("",), (None,), ("-5",), ("15000000",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(X.parse_salary("s", T.StringType())).collect()]
    assert got == [1000.0, 1020.0, 0.0, 0.0, 0.0, 0.0, 5.0, 15000000.0]


def test_salary_numeric_bypasses_text(spark):
    df = spark.createDataFrame([(15000000.5,), (-5.0,), (None,)], "s double")
    got = [r[0] for r in df.select(X.parse_salary("s", T.DoubleType())).collect()]
    assert got == [15000000.5, 5.0, 0.0]


def test_salary_absent_column(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert df.select(X.parse_salary("salaryMin", None)).first()[0] == 0.0


def test_posted_date(spark):
    rows = [("2024-01-05",), ("2024-1-5",), ("2024-01-05T23:30:00-07:00",), ("05/01/2024",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(X.parse_posted_date("s")).collect()]
    d = dt.date(2024, 1, 5)
    assert got == [d, d, d, None, None, None]


def test_city_fallback(spark):
    rows = [(["HN", "HCM"], ["a"]), ([], ["a"]), (None, ["a", None, "b"]), (None, None)]
    df = spark.createDataFrame(rows, "cities array<string>, wl array<string>")
    got = [r[0] for r in df.select(A.join_city("cities", "wl")).collect()]
    assert got == ["HN, HCM", "", "a, b", None]


def test_clean_text(spark):
    rows = [(" \tA\r\nB\nC\rD  ",), ("",), (None,), ("x ",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(X.clean_text("s")).collect()]
    assert got == ["A B C\rD", "", "", "x"]


def test_url_ids(spark):
    rows = [
        ("https://vn.joboko.com/viec-lam-a-xvi6228392",),
        ("  https://vn.joboko.com/viec-lam-a-xvi1#top ",),
        ("https://vn.joboko.com/viec-lam-a-xvi1?u=1",),
        ("https://vn.joboko.com/viec-lam-a-xvi12b",),
        ("https://other.example/viec-lam-a-xvi1",),
        ("https://www.topcv.vn/viec-lam/abc/123.html?ta=x",),
    ]
    df = spark.createDataFrame(rows, "u string").select(
        X.dom_link_kept("u").alias("kept"),
        X.drop_fragment(X.strip_ws("u")).alias("link"),
        X.dom_job_id("u").alias("jid"),
        X.jsonld_job_id("u").alias("tid"),
    )
    got = [tuple(r) for r in df.collect()]
    assert [g[0] for g in got] == [True, True, True, False, False, False]
    assert got[1][1] == "https://vn.joboko.com/viec-lam-a-xvi1"
    assert got[2][1] == "https://vn.joboko.com/viec-lam-a-xvi1?u=1"
    assert [g[2] for g in got] == ["joboko_6228392", "joboko_1", "joboko_1", None, "joboko_1", None]
    assert got[5][3] == "topcv_123"


def test_truthy_and_type(spark):
    texts = ['""', "[]", "{}", "0", "0.0", "false", "null", '"x"', "[1]", '{"a":1}', "1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(truthy(F.parse_json("t")))
    assert [r[0] for r in df.collect()] == [False] * 7 + [True] * 4
    types = ['{"@type":"JobPosting"}', '{"@type":["Thing","JobPosting"]}', '{"@type":"WebSite"}', "[1]", '"JobPosting"']
    df = spark.createDataFrame([(t,) for t in types], "t string").select(is_job_posting(F.parse_json("t")))
    assert [r[0] for r in df.collect()] == [True, True, False, False, False]
