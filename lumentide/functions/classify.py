"""Topic categories of titles, CAMEO codes and arXiv categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from lumentide.functions.common import map_lookup
from lumentide.schemas import ARXIV_CATEGORY, CAMEO_CATEGORY, TOPIC_KEYWORDS


def classify_topic(title: Column) -> Column:
    """First category with a keyword anywhere in the title, whatever its case."""
    text = F.lower(title)
    mentions = {
        category: reduce(lambda a, b: a | b, [text.contains(word) for word in words])
        for category, words in TOPIC_KEYWORDS.items()
    }
    return F.coalesce(
        *[F.when(found, category) for category, found in mentions.items()],
        F.lit("uncategorised"),
    )


def cameo_to_category(code: Column) -> Column:
    """Category of the two leading digits of a CAMEO event code."""
    return map_lookup(F.substring(code, 1, 2), CAMEO_CATEGORY, "uncategorised")


def arxiv_to_category(category: Column) -> Column:
    """Category of an arXiv archive; what is not listed is science."""
    archive = F.lower(F.substring_index(category, ".", 1))
    return map_lookup(archive, ARXIV_CATEGORY, "science")
