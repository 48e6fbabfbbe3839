"""VARIANT helpers for schemaless landed documents.

``try_variant_get`` to a typed array/struct is element-wise: a non-object
element becomes a null struct, a wrong-typed list becomes null. That gives
the crawler's ``safe_list`` / ``safe_dict`` guards (V1) without a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart import schemas as S

# to_json of the values Python treats as falsy (0.0 prints as "0").
_FALSY_JSON = ["[]", "{}", '""', "0", "false", "null"]


def get(v: Column, path: str, ddl: str) -> Column:
    return F.try_variant_get(v, path, ddl)


def safe_list(v: Column, path: str, element_ddl: str = "variant") -> Column:
    """V1: the array at ``path``; wrong type or missing -> empty array."""
    return F.coalesce(get(v, path, f"array<{element_ddl}>"), F.array().cast(f"array<{element_ddl}>"))


def truthy(v: Column) -> Column:
    """Python truthiness of a variant value: "", [], {}, 0, false, null are falsy."""
    return F.coalesce(~F.to_json(v).isin(_FALSY_JSON), F.lit(False))


def is_job_posting(v: Column) -> Column:
    """``@type`` equals JobPosting, or is a list that contains it.

    Non-object values (arrays, scalars) have no ``@type`` and never match.
    """
    as_text = get(v, "$['@type']", "string")
    as_list = get(v, "$['@type']", "array<string>")
    return F.coalesce(
        (as_text == S.JOB_POSTING_TYPE) | F.array_contains(as_list, S.JOB_POSTING_TYPE), F.lit(False)
    )


def unnest_documents(v: Column) -> Column:
    """A landed file holds one top-level array or one object; both become
    one row per document (a truncated file gives one null row)."""
    return F.explode(F.coalesce(get(v, "$", "array<variant>"), F.array(v)))


def evaluate_once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as column ``name``, computed exactly once per row.

    Catalyst substitutes an aliased expression into every filter pushed
    below the projection and into each later projection that uses it, so an
    expensive parse (regex + JSON) referenced by a filter and a projection
    runs several times per row. A one-element ``explode`` is a Generate
    node: predicates on its output cannot move below it, so the parse runs
    once and everything above reads the column.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))
