"""Array/struct helpers for the raw API document (``Column -> Column``).

Python truthiness in the crawler's list comprehensions becomes
``x IS NOT NULL AND x <> ''`` on strings; order and duplicates are kept
unless the operator says otherwise. Higher-order functions (transform,
filter, array_distinct) run per row inside code generation, so no row
crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import schemas as S
from jobmart.functions.text import clean_text


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_truthy_text(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def join_city(cities: Column | str, working_locations: Column | str) -> Column:
    """``cities`` joined when the array is not null (an empty array gives ``""``),
    else ``workingLocations`` joined; null elements are skipped."""
    cities, working_locations = _col(cities), _col(working_locations)
    return F.coalesce(F.array_join(cities, S.CITY_SEPARATOR), F.array_join(working_locations, S.CITY_SEPARATOR))


def field_values(arr: Column | str, field: str) -> Column:
    """V3/V7/V8: the truthy ``field`` of each element, order and duplicates kept."""
    return F.filter(
        F.transform(F.coalesce(_col(arr), F.array()), lambda x: x[field]), is_truthy_text
    )


def address_list(locations: Column | str) -> Column:
    """V3: truthy addresses of the working locations."""
    return field_values(locations, "address")


def city_list(locations: Column | str) -> Column:
    """V4: ``cityName`` or else ``cityNameVI`` (empty counts as missing),
    distinct in first-seen order."""
    names = F.transform(
        F.coalesce(_col(locations), F.array()),
        lambda x: F.coalesce(F.nullif(x["cityName"], F.lit("")), F.nullif(x["cityNameVI"], F.lit(""))),
    )
    return F.array_distinct(F.filter(names, lambda c: c.isNotNull()))


def function_label(job_function: Column | str) -> Column:
    """V5: ``parent > c1, c2``; the parent alone; else the children joined."""
    jf = _col(job_function)
    parent = jf["parentName"]
    children = field_values(jf["children"], "name")
    joined = F.array_join(children, S.CITY_SEPARATOR)
    has_parent = is_truthy_text(parent)
    return (
        F.when(has_parent & (F.size(children) > 0), F.concat(parent, F.lit(S.FUNCTION_SEPARATOR), joined))
        .when(has_parent, parent)
        .otherwise(joined)
    )


def benefit_strings(benefits: Column | str) -> Column:
    """V6: ``name: clean(value)`` for each benefit with a truthy name."""
    kept = F.filter(F.coalesce(_col(benefits), F.array()), lambda b: is_truthy_text(b["benefitName"]))
    return F.transform(
        kept,
        lambda b: F.concat(b["benefitName"], F.lit(S.BENEFIT_SEPARATOR), clean_text(b["benefitValue"])),
    )


def skill_names(skills: Column | str) -> Column:
    """V7."""
    return field_values(skills, "skillName")


def industry_names(industries: Column | str) -> Column:
    """V8."""
    return field_values(industries, "industryV3Name")
