"""Text helpers shared by every operator family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space when text is split or
# stripped (the ASCII ones, the four separators, NEL and Unicode separators).
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; both ends are trimmed."""
    return F.trim(F.regexp_replace(text, WHITESPACE + "+", " "))


def strip(text: Column) -> Column:
    """Only a text with white space at an end is searched for it."""
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    stripped = F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")
    return F.when(F.rlike(ends, F.lit(WHITESPACE)), stripped).otherwise(text)


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def cap(text: Column, limit: int) -> Column:
    """At most ``limit`` characters; a cut text ends in an ellipsis."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit - 1), F.lit("…"))
    ).otherwise(text)


def squeeze_and_cap(text: Column, limit: int | None) -> Column:
    whole = squeeze(F.coalesce(text, F.lit("")))
    return whole if limit is None else cap(whole, limit)


def slug(name: Column) -> Column:
    """``Customer Warehouse`` -> ``customer_warehouse``; nothing left -> ``untitled``."""
    joined = F.regexp_replace(name, "[^a-zA-Z0-9]+", "_")
    bare = F.lower(F.regexp_replace(joined, "^_+|_+$", ""))
    return F.when(bare == "", "untitled").otherwise(bare)


def matches_search(name: Column, search: str | None) -> Column:
    """Case-insensitive substring test; an empty search keeps every row."""
    if not search:
        return F.lit(True)
    return F.contains(F.lower(name), F.lit(search.lower()))


def xml_text(value: Column) -> Column:
    out = value
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def xml_attr(value: Column) -> Column:
    """Attribute text; a double quote is an entity only next to a single one."""
    out = xml_text(value)
    for raw, entity in (("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return F.when(
        F.contains(out, F.lit("'")), F.replace(out, F.lit('"'), F.lit("&quot;"))
    ).otherwise(out)


def nonempty(value: Column) -> Column:
    """The value, with '' turned into null so that it is left out of lists."""
    return F.nullif(value, F.lit(""))


def lines(*parts: Column) -> Column:
    """Newline-joined parts; null parts vanish."""
    return F.concat_ws("\n", *parts)
