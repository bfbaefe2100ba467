"""Website audit of a page: markup flags and counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.text import SPACE, contains_any

VISIBLE_TEXT_CUTS = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != ""))


def page_text(html: Column) -> Column:
    """Text without tags, for landed pages that carry no markdown."""
    return F.regexp_replace(html, VISIBLE_TEXT_CUTS, " ")


def page_title(html: Column) -> Column:
    """Text of the first title element, for landed pages without metadata; null without one."""
    return F.nullif(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1), F.lit(""))


def page_description(html: Column) -> Column:
    """Content of the description meta element; null without one."""
    return F.nullif(F.regexp_extract(html, r"""(?is)<meta\s+name=["']description["']\s+content=["']([^"']*)["']""", 1), F.lit(""))


def audit(url: Column, html: Column, markdown: Column) -> dict[str, Column]:
    html = F.coalesce(html, F.lit(""))
    low = F.lower(html)
    types = F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(fixed.SCHEMA_TYPE), 1)))
    return {
        "h1_count": F.regexp_count(low, F.lit(fixed.HEADING)).cast("long"),
        "word_count": word_count(markdown).cast("long"),
        "has_schema_org": F.size(types) > 0,
        "schema_types": types,
        **{flag: contains_any(low, marks) for flag, marks in fixed.PAGE_MARKS.items()},
        "is_https": F.lower(url).startswith("https://"),
    }
