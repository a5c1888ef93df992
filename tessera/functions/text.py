"""Text helpers: word splitting and formatted lines, all as JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word separators are the ASCII punctuation characters
#   ! " # $ % & ' ( ) * + , - . / : ; < = > ? @ [ \ ] ^ _ ` { | } ~
# and every Unicode whitespace character:
#   U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
#   U+2028, U+2029, U+202F, U+205F, U+3000
# A run of one or more separators splits two words.
#
# The same set in Java regex syntax (\p{Punct} is ASCII punctuation, \s is
# U+0009-U+000D and space) — several times faster than listing code points:
WORD_SEPARATORS_JAVA = (
    r"[\p{Punct}\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
# ... and spelled out by code point (RE2 syntax, for SQL engines):
WORD_SEPARATORS = (
    r"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e"
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def split_words(text: Column) -> Column:
    """Array of tokens; leading/trailing separators give empty tokens (dropped by callers)."""
    return F.split(text, WORD_SEPARATORS_JAVA, -1)


def words(text: Column) -> Column:
    """Generator column: one lower-cased word per row (use inside ``select``).

    Lower-casing the line first is equivalent to lower-casing each word:
    no character changes between separator and non-separator when lowered.
    """
    return F.explode(split_words(F.lower(text)))


def format_pair(key: Column, count: Column) -> Column:
    """``'%s %i'`` line of a key and an integer count."""
    return F.format_string("%s %d", key, count)


def score_sign(score: Column) -> Column:
    """positive (above 0), negative (0 or less), or NULL for a missing score."""
    return F.when(score > 0, "positive").when(score <= 0, "negative")
