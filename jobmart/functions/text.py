"""Scalar text/number/date helpers (``Column -> Column``).

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart import schemas as S

# Python's str.strip() removes Unicode whitespace; plain trim() only removes
# spaces. (?U) makes \s follow the Unicode White_Space property.
_EDGE_WHITESPACE = r"(?U)^\s+|\s+$"
_LINE_BREAK = r"\r?\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading/trailing Unicode whitespace (tabs and newlines included)."""
    return F.regexp_replace(_col(c), _EDGE_WHITESPACE, "")


def clean_text(c: Column | str) -> Column:
    """V2: falsy -> ""; CRLF and LF -> space; strip the ends; inner runs kept."""
    return F.coalesce(strip_ws(F.regexp_replace(_col(c), _LINE_BREAK, " ")), F.lit(""))


def parse_salary_text(c: Column | str) -> Column:
    """P4 for text: keep digits and dots, then a non-throwing cast to double.

    ``"$1,000"`` -> 1000, ``"10-20 trieu"`` -> 1020, ``"1.000.000"`` -> null,
    ``"Thoa thuan"`` -> null. The caller zero-fills.
    """
    stripped = F.regexp_replace(_col(c).cast("string"), S.SALARY_STRIP_PATTERN, "")
    return stripped.try_cast("double")


def parse_salary(c: Column | str, data_type: T.DataType | None) -> Column:
    """Dispatch on the input type; null/absent -> 0.0.

    Numbers skip the text route: a double >= 1e7 prints as ``1.0E7`` and the
    strip regex would turn it into 1.07. ``abs`` mirrors the sign loss of the
    text route (``-5`` -> 5).
    """
    if data_type is None:
        return F.lit(0.0)
    if isinstance(data_type, T.NumericType):
        return F.coalesce(F.abs(_col(c)).cast("double"), F.lit(0.0))
    return F.coalesce(parse_salary_text(c), F.lit(0.0))


def parse_posted_date(c: Column | str) -> Column:
    """P5: ISO date text (time and offset ignored) -> date; anything else null."""
    return F.try_to_date(_col(c).cast("string"))


def dom_job_id(url: Column | str) -> Column:
    """``...-xvi<digits>`` followed by end, ``?`` or ``#`` -> ``joboko_<digits>``."""
    digits = F.regexp_extract(_col(url), S.DOM_ID_PATTERN, 1)
    return F.when(digits != "", F.concat(F.lit(S.DOM_ID_PREFIX), digits))


def jsonld_job_id(url: Column | str) -> Column:
    """Last path segment up to its first dot -> ``topcv_<segment>``."""
    last = F.substring_index(_col(url), "/", -1)
    return F.concat(F.lit(S.JSONLD_ID_PREFIX), F.substring_index(last, ".", 1))


def dom_link_kept(url: Column | str) -> Column:
    """W2 predicate on a trimmed link: non-empty, right prefix, detail-page id."""
    u = strip_ws(url)
    return (
        u.isNotNull()
        & (u != "")
        & u.startswith(S.DOM_LINK_PREFIX)
        & u.rlike(S.DOM_ID_PATTERN)
    )


def drop_fragment(url: Column | str) -> Column:
    return F.substring_index(_col(url), "#", 1)


def contains_any(c: Column | str, needles: list[str]) -> Column:
    cond = F.lit(False)
    for needle in needles:
        cond = cond | F.contains(_col(c), F.lit(needle))
    return cond


# Entities that a link's attribute value can hold (&amp; last, so that an escaped
# entity such as "&amp;lt;" decodes once, to "&lt;").
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&#x27;", "'"),
    ("&#47;", "/"),
    ("&#x2F;", "/"),
    ("&#38;", "&"),
    ("&amp;", "&"),
]


def decode_entities(c: Column | str) -> Column:
    """Decode the entities of ``HTML_ENTITIES``."""
    out = _col(c)
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out
