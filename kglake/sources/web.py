"""Elements, links and version strings out of downloaded pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK = r'a href="(\S+)"'


def html_elements(pages: DataFrame, tag: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """Each element of a tag that is not nested in itself: position, inner HTML and text."""
    inner = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))
    return pages.select(key, F.posexplode(inner).alias("position", "inner_html")).withColumn(
        "text", F.trim(F.regexp_replace("inner_html", r"<[^>]*>", ""))
    )


def extract_links(pages: DataFrame, contains: str = "", key: str = "page_id", html: str = "html") -> DataFrame:
    """Targets of the links of each page that contain a substring, with repeats."""
    links = pages.select(key, F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("link"))
    return links.where(F.contains("link", F.lit(contains)))


def nth_match(text: Column, pattern: str, n: int = 1, group: int = 0) -> Column:
    """The n-th match of a version pattern, null where there are fewer."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(n))


def version_by_substitution(text: Column, pattern: str, replacement: str = "$1") -> Column:
    return F.regexp_replace(text, pattern, replacement)


def hash_version(digest: Column) -> Column:
    return F.concat(F.lit("SHA_"), F.substring(digest, 1, 8))


def date_version(timestamp_text: Column) -> Column:
    return F.substring(timestamp_text, 1, 10)
