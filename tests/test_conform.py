"""API document flatten (S7, V1–V12) on wrong-typed input."""

import json

from pyspark.sql import functions as F

from jobmart.operators import conform


def _flatten(spark, bodies):
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    jobs = conform.unnest_response(pages)
    typed = jobs.select(conform.api_job_from_variant(F.col("job_v")).alias("job"))
    return conform.conform_api(typed, "job", F.current_timestamp())


def test_unnest_shapes(spark):
    bodies = ['{"data": "oops"}', '{"data": []}', "not json", '{"data": [{"jobId": 1}, 7]}']
    rows = _flatten(spark, bodies).collect()
    assert len(rows) == 2
    ok, rejects = conform.split_rejects(_flatten(spark, bodies))
    assert [r.jobId for r in ok.collect()] == ["1"]
    assert rejects.count() == 1


def test_api_defaults_and_lists(spark):
    job = {
        "jobId": 5,
        "jobUrl": "",
        "workingLocations": [
            {"address": "a", "cityName": "", "cityNameVI": "HN"},
            5,
            {"address": "", "cityName": "HN"},
            {"address": "b", "cityName": "HCM"},
        ],
        "skills": "bad",
        "benefits": [{"benefitName": "Bonus", "benefitValue": " \tx\r\ny "}, {"benefitName": "", "benefitValue": "z"},
                     {"benefitName": "Car"}],
        "jobFunction": {"parentName": "", "children": [{"name": "c1"}, {"name": ""}, "x", {"name": "c2"}]},
        "salary": {"type": "Range", "min": None, "max": 20000000.5},
    }
    r = _flatten(spark, [json.dumps({"data": [job]})]).first()
    assert r.jobUrl == "https://www.vietnamworks.com/job-5-jv"
    assert r.workingLocations == ["a", "b"]
    assert r.cities == ["HN", "HCM"]
    assert r.skills == []
    assert r.benefits == ["Bonus: x y", "Car: "]
    assert r.jobFunction == "c1, c2"
    assert (r.salaryMin, r.salaryMax, r.salaryCurrency) == (0.0, 20000000.5, "USD")
    assert (r.jobDescription, r.jobLevel, r.yearsOfExperience) == ("", "", 0)
    assert r.jobTitle is None and r.companyName is None


def test_function_label_forms(spark):
    cases = [
        ({"parentName": "P", "children": [{"name": "a"}, {"name": "b"}]}, "P > a, b"),
        ({"parentName": "P"}, "P"),
        ({"children": [{"name": "a"}]}, "a"),
        ({}, ""),
        ("not a dict", ""),
    ]
    bodies = [json.dumps({"data": [{"jobId": i, "jobFunction": jf}]}) for i, (jf, _) in enumerate(cases)]
    got = {int(r.jobId): r.jobFunction for r in _flatten(spark, bodies).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
