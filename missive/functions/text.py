"""Column expressions over message text.  All of them are built-in Spark functions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL shapes and the whitespace set of the cleaning rule.  (?U) gives \s its Unicode meaning;
# U+001C to U+001F count as whitespace in the rule but not in Java, so they are named.
SPACE = r"\s\x1c-\x1f"
URL = rf"(?U)http[^{SPACE}]+|www\.[^{SPACE}]+"
WORD = rf"(?U)[^{SPACE}]+"


def clean_text(text: Column) -> Column:
    """Lower-case, drop URLs, keep ASCII letters and digits, single spaces, no outer spaces.

    After lower-casing, every character that is not ``[a-z0-9]`` becomes part of a separator run, so character
    removal and whitespace collapsing are one regular-expression pass.  The URL pass is left out where a text
    cannot hold one.
    """
    lower = F.lower(text)
    may_hold_url = F.contains(lower, F.lit("http")) | F.contains(lower, F.lit("www."))
    no_urls = F.when(may_hold_url, F.regexp_replace(lower, URL, "")).otherwise(lower)
    return F.trim(F.regexp_replace(no_urls, "[^a-z0-9]+", " "))


def char_count(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for an empty text."""
    return F.regexp_count(text, F.lit(WORD))


def truncate(text: Column, limit: int = 100, keep: int = 97) -> Column:
    """Texts over ``limit`` characters become their first ``keep`` characters and an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit("..."))).otherwise(text)


def tokens(cleaned: Column) -> Column:
    """Words of two or more characters of an already cleaned text."""
    return F.filter(F.split(cleaned, " "), lambda word: F.length(word) >= 2)


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of ``words`` with ``low <= n <= high``, joined by one space."""
    if not 1 <= low <= high:
        raise ValueError(f"Invalid n-gram range: ({low}, {high})")
    grams = words
    levels = [grams] if low == 1 else []
    for n in range(2, high + 1):
        # the n-gram at i is the (n-1)-gram at i followed by word i+n-1
        count = F.greatest(F.size(words) - F.lit(n - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), count),
            F.slice(words, F.lit(n), count),
            lambda head, last: F.concat_ws(" ", head, last),
        )
        if n >= low:
            levels.append(grams)
    return levels[0] if len(levels) == 1 else F.concat(*levels)


def hash_bucket(token: Column, size: int) -> Column:
    """Bucket 0..size-1 of a token, from the first 32 bits of its MD5 digest."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % F.lit(size)).cast("int")


def hash_key(key: Column, seed: int) -> Column:
    """A uniform 128-bit hexadecimal sort key of ``key``; a different ``seed`` gives an unrelated order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
