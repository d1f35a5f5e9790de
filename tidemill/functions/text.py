"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def title_case(c: Column) -> Column:
    """Upper-case the first letter after any non-alphanumeric character."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    raised = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w))))
    return F.array_join(raised, "")


def phone_digits(c: Column) -> Column:
    """``+`` and the digits of the value; null where no digit is left."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) > 0, F.concat(F.lit("+"), digits))


def tokens(c: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def sentences(c: Column) -> Column:
    """Pieces that end in ``.``, ``!`` or ``?`` followed by blanks."""
    return F.split(c, r"(?<=[.!?]) +")


def occurrences(haystack: Column, needle: Column) -> Column:
    """Number of non-overlapping occurrences of a non-empty needle."""
    return F.floor((F.length(haystack) - F.length(F.replace(haystack, needle, F.lit("")))) / F.length(needle))


def keyword_score(sentence: Column, keywords: Column) -> Column:
    """Sum of the occurrences of each keyword in the lower-cased sentence."""
    low = F.lower(sentence)
    return F.aggregate(keywords, F.lit(0).cast("bigint"), lambda acc, k: acc + occurrences(low, k))


def query_keywords(c: Column) -> Column:
    """Blank-separated words of more than two characters, lower-cased."""
    words = F.split(c, r"\s+")
    return F.transform(F.filter(words, lambda w: F.length(w) > 2), lambda w: F.lower(w))


def starts_with_ci(c: Column, prefix: str) -> Column:
    return F.lower(c).startswith(prefix.lower())


def preview(c: Column, size: int) -> Column:
    return F.substring(c, 1, size)


def embed_text(title: Column, body: Column, tags: Column | None = None) -> Column:
    """``title. body tags`` as one string to vectorise."""
    parts = [F.concat_ws(". ", title, body)]
    if tags is not None:
        parts.append(F.array_join(tags, " "))
    return F.concat_ws(" ", *parts)


def numbered_lines(c: Column) -> Column:
    """Texts of the lines that start with ``1.``, ``2.`` …, numbering removed."""
    lines = F.filter(F.split(c, "\n"), lambda line: F.trim(line).rlike(r"^\d+\."))
    return F.transform(lines, lambda line: F.trim(F.regexp_replace(line, r"^\d+\.\s*", "")))
