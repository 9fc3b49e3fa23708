"""Small text helpers used as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: value shapes that hide an example list ---
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"
URL_MARKERS = ["http://", "https://"]
# --- end of fixed values ---


def is_email(c: Column) -> Column:
    # (?U): \w matches Unicode letters, as the Python original does
    return c.rlike("(?U)" + EMAIL_PATTERN)


def has_url(c: Column) -> Column:
    cond = None
    for m in URL_MARKERS:
        e = c.contains(m)
        cond = e if cond is None else (cond | e)
    return cond


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def regex_escape(c: Column) -> Column:
    """Escape regex metacharacters of a column value (Java regex)."""
    return F.regexp_replace(c, r"([\\\[\]{}()*+?.^$|])", r"\\$1")
