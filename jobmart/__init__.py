"""jobmart: job-posting analytics as Spark DataFrame plans.

Raw postings (API documents, JSON-LD pages, DOM extracts) are conformed to
one schema, merged per key with set-based upserts (batch or streaming), and
turned into the ``jobs_fact`` / ``job_skills`` marts and a salary model.

Every operator is a ``Column -> Column`` or ``DataFrame -> DataFrame``
function built from Spark built-ins (but for the HTML parser of the DOM fields), so
Catalyst can prune, push down and code-generate the plan.
"""

from jobmart.session import build_session, drop_shared, shared_dir

__all__ = ["build_session", "drop_shared", "shared_dir"]
