"""Token and n-gram expressions.  All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The topic names the news corpus is filtered to.
TOP_TOPICS = [
    "ship", "grain", "money-fx", "corn", "trade",
    "crude", "earn", "wheat", "acq", "interest",
]


def word_tokens(text: Column | str, min_length: int = 1, lower: bool = False) -> Column:
    r"""Matches of ``\w+`` (ASCII word characters) of at least ``min_length``."""
    text = F.col(text) if isinstance(text, str) else text
    if lower:
        text = F.lower(text)
    words = F.regexp_extract_all(text, F.lit(r"(\w+)"), 1)
    return F.filter(words, lambda w: F.length(w) >= min_length) if min_length > 1 else words


def space_tokens(text: Column | str) -> Column:
    """Lower-cased pieces between single white-space characters, trailing empty ones dropped."""
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.regexp_replace(F.lower(text), r"[ \t\n\x0B\f\r]+$", "")
    pieces = F.split(trimmed, r"[ \t\n\x0B\f\r]")
    return F.when((trimmed == "") & (F.length(text) > 0), F.array().cast("array<string>")).otherwise(pieces)


def drop_words(tokens: Column | str, words: list[str]) -> Column:
    """Tokens whose lower-case form is not in the list."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    if not words:
        return tokens
    lowered = sorted({w.lower() for w in words})
    return F.filter(tokens, lambda t: t.isNull() | ~F.lower(t).isin(lowered))


def ngrams_sql(column: str, n: int = 2, separator: str = " ") -> str:
    """SQL text for all 1-grams, then 2-grams, ... up to ``n``-grams of an array column."""
    levels = [column]
    for size in range(2, n + 1):
        length = f"greatest(size({column}) - {size - 1}, 0)"
        levels.append(
            f"zip_with(slice({levels[-1]}, 1, {length}), slice({column}, {size}, {length}), "
            f"(a, b) -> concat(a, '{separator}', b))"
        )
    return f"concat({', '.join(levels)})" if n > 1 else column


def word_ngrams(column: str, n: int = 2, separator: str = " ") -> Column:
    return F.expr(ngrams_sql(column, n, separator))


def letters_only(text: Column | str) -> Column:
    """True when every character is a letter of any script; true for an empty string."""
    text = F.col(text) if isinstance(text, str) else text
    return text.rlike(r"^\p{L}*\z")


def clean_text(text: Column | str, newline: str = " ") -> Column:
    """Newlines replaced (by a space, or removed with ``newline=""``), U+0003 dropped."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.regexp_replace(text, "\n", newline), "\x03", "")


def concat_columns(*columns: str) -> Column:
    """String or string-array columns joined by a space, split again into one token array."""
    return F.split(F.concat_ws(" ", *columns), " ")


def digest(tokens: Column | str) -> Column:
    """md5 over an array's items, for comparing token arrays as one scalar."""
    return F.md5(F.array_join(tokens, "|"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
