"""Bulk text parsing expressions (X-19, X-34, X-35) — whole texts, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..defaults import DEFAULT_EMOJI, DEFAULT_ITEM_CATEGORY as DEFAULT_CATEGORY, DESCRIPTION_SEPARATOR, \
    ITEM_SEPARATOR, NO_SUMMARY, SCORE_MARKER


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parse_probability(text: Column) -> Column:
    """X-34: the number after the first ``Probability:`` (up to the next one),
    valid only in [0, 1]; anything else → 0."""
    parts = F.split(text, SCORE_MARKER, -1)
    raw = strip_ws(F.get(parts, 1))
    v = raw.try_cast("double")
    return F.when(v.between(0.0, 1.0), v).otherwise(F.lit(0.0))


def reply_items(text: Column) -> Column:
    """X-35: ``" | "``-separated items; with more than one part the last is the summary."""
    return F.split(strip_ws(text), ITEM_SEPARATOR.replace("|", "\\|"), -1)


def reply_summary(items: Column) -> Column:
    return F.when(F.size(items) > 1, F.element_at(items, -1)).otherwise(F.lit(NO_SUMMARY))


def reply_descriptions(items: Column) -> Column:
    return F.when(F.size(items) > 1, F.slice(items, 1, F.size(items) - 1)).otherwise(items)


def parse_item(item: Column) -> Column:
    """``"<emoji> <category> @ <description>"`` → struct(emoji, category, description);
    malformed → (default emoji, 'Item', whole item)."""
    at = F.locate(DESCRIPTION_SEPARATOR, item)
    head = F.when(at > 0, F.substring(item, F.lit(1), at - 1))
    desc = F.when(at > 0, F.substr(item, at + F.lit(len(DESCRIPTION_SEPARATOR))))
    sp = F.locate(" ", head)
    ok = (at > 0) & (sp > 0)
    return F.struct(
        F.when(ok, F.substring(head, F.lit(1), sp - 1)).otherwise(F.lit(DEFAULT_EMOJI)).alias("emoji"),
        F.when(ok, F.substr(head, sp + 1)).otherwise(F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.when(ok, desc).otherwise(item).alias("description"))


def raw_tokens(text: Column) -> Column:
    """Lower-cased split of the whole text on non-word runs (ASCII word class);
    may contain empty strings at the ends — drop them after exploding, where
    the filter is code-generated (cheaper than a lambda over the array)."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+", -1)


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of the whole text (ASCII word class), no empties."""
    return F.filter(raw_tokens(text), lambda t: F.length(t) > 0)
