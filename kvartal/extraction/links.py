"""Listing links of category pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kvartal import vocab
from kvartal.extraction.nodes import attribute_values


def canonical_url(href: Column, base: str) -> Column:
    """Absolute, without query string."""
    absolute = F.when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(href)
    return F.substring_index(absolute, "?", 1)


def listing_links(
    pages: DataFrame, base: str, mark: str = vocab.LISTING_LINK_MARK
) -> DataFrame:
    """``(page_id, position, url)``: each listing link of a page once, in page order.

    Links come from the parsed page, so broken markup, comments and scripts are as a
    parser sees them. They are made unique inside the page's own row, without a shuffle.
    """
    links = F.filter(F.col("values"), lambda href: href.contains(mark))
    urls = F.array_distinct(F.transform(links, lambda href: canonical_url(href, base)))
    return attribute_values(pages, "a", "href").select(
        "page_id", F.posexplode(urls).alias("position", "url")
    )
