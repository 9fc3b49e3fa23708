"""SQL text scanned literal by literal.

One left-to-right alternation decides what a quote or a comment mark belongs
to: a literal or quoted name is matched whole, so nothing inside it is taken for
a comment, and nothing inside a comment opens a literal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING = r"'[^']*+(?:''[^']*+)*+'"
QUOTED = rf"{STRING}|\"[^\"]*+\"|`[^`]*+`"
LINE_COMMENT = r"--[^\n]*+"
BLOCK_COMMENT = r"(?s:/\*.*?\*/)"


def drop_line_comments(sql: Column) -> Column:
    """``--`` comments removed; the newline that ends one stays."""
    return F.regexp_replace(sql, rf"({QUOTED})|{LINE_COMMENT}(\n|$)", "$1$2")


def text_key(sql: Column) -> Column:
    """A text equal for two statements that differ only in comments, white
    space, letter case and identifier quotes outside string literals, spaces
    around operators, and a final ``;``."""
    s = F.regexp_replace(sql, rf"({STRING})|{LINE_COMMENT}|{BLOCK_COMMENT}", "$1 ")
    literals = F.regexp_extract_all(s, F.lit(f"({STRING})"), 1)
    s = F.lower(F.regexp_replace(s, STRING, "\u0001"))
    s = F.regexp_replace(F.regexp_replace(s, r"[`\[\]]", '"'), r"\s+", " ")
    s = F.regexp_replace(s, r"\s*;\s*$", "")
    s = F.btrim(F.regexp_replace(s, r"\s*([(),=<>+*/\u0001-])\s*", "$1"))
    return F.concat(s, F.lit("\u0002"), F.array_join(literals, "\u0002"))
