"""Text cleaning as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from reqlytics.contract import Layout

# The characters with the Unicode White_Space property. Spark's own trim() knows
# only the plain space, so the set is passed to btrim(), which stays inside generated code.
UNICODE_SPACES = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: runs that collapse to one space (Java's \s would add the vertical tab).
SPACE_RUN = r"[\t\n\f\r ]+"
# Fixed value: marks that spelling variants add or drop: hyphen, slash, parentheses, spaces.
VARIANT_MARKS = r"[\t\n\f\r /()\-]+"


def strip(c: Column) -> Column:
    """Trim every kind of Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(UNICODE_SPACES))


def squeeze(c: Column) -> Column:
    """Trim, then turn each inner run of whitespace into one space."""
    return F.regexp_replace(strip(c), SPACE_RUN, " ")


def match_key(c: Column) -> Column:
    """A cleaned text without the marks in which spelling variants differ."""
    return F.regexp_replace(c, VARIANT_MARKS, "")


def is_header_text(c: Column, headers: list[str]) -> Column:
    """True where the cleaned cell is one of the header texts; null cells are not.

    The first word is searched in the raw cell before anything is cleaned, so ordinary rows pass
    the filter at the price of one substring search.
    """
    hits = [c.contains(h.split()[0]) for h in headers]
    maybe = hits[0]
    for hit in hits[1:]:
        maybe = maybe | hit
    return F.coalesce(maybe & squeeze(c).isin(headers), F.lit(False))


def layout_of(cell: Callable[[str], Column], layouts: Sequence[Layout]) -> Column:
    """Name of the first layout that a row matches, by its cleaned cells; null where it matches none."""
    found = F.lit(None).cast("string")
    for layout in reversed(layouts):
        name = F.lit(layout.name)
        found = F.when(cell(layout.column).rlike(layout.pattern), name).otherwise(found) if layout.pattern else name
    return found


def is_swapped(layout: Column, layouts: Sequence[Layout]) -> Column:
    """True where a layout's slots hold each other's content."""
    names = [x.name for x in layouts if x.swapped]
    return F.coalesce(layout.isin(names), F.lit(False)) if names else F.lit(False)
