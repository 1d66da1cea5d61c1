"""Cleaning, tokenising and sentence splitting of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separators (vertical tab is not one of them), sentence
# ends, the record delimiter and the rest of it that is taken out of bodies.
TOKEN_GAP = r"[ \t\n\r\f]+"
SENTENCE_END = "[.?!][ ]"
DELIMITER = "<====>"
DELIMITER_TAIL = "====>"

# Everything but a-z, 0-9 and token separators in lower-case text. Written as the
# ranges to remove: on the JVM this is about 1.5 times as fast as the negated set.
_NOISE = r"[!-/:-`{-\x{10ffff}\x00-\x08\x0b\x0e-\x1f]+"
_NOISE_IN_SENTENCE = r"[!-/:-`{-\x{10ffff}\x00-\x1f]+"

# Stands for "a token of which nothing was left"; never survives cleaning itself.
STRIPPED = "\u0001"


def has_ink(text: Column) -> Column:
    """True if a character above U+0020 occurs (blank strings have none)."""
    return text.rlike(r"[^\x00-\x20]")


def clean_word(token: Column) -> Column:
    """Lower case, then only ``a-z0-9``; may leave an empty string."""
    return F.regexp_replace(F.lower(token), "[^a-z0-9]+", "")


def raw_words(text: Column, keep_empty: bool = False) -> Column:
    """Array of words of a text, cleaned in one pass over the whole text.

    The text is cleaned before it is split, so there is one regex call per text
    and not one per token. With ``keep_empty`` removed characters leave a mark,
    so that a token without letters or digits is still there after the split;
    :func:`strip_mark` turns it into the empty word. Array elements that are
    empty (text starting or ending with a separator) are no tokens.
    """
    return F.split(cleaned_text(text, keep_empty), TOKEN_GAP)


def cleaned_text(text: Column, keep_empty: bool = False) -> Column:
    """A text's words and the gaps between them."""
    return F.regexp_replace(F.lower(text), _NOISE, STRIPPED if keep_empty else "")


def strip_mark(word: Column) -> Column:
    return F.replace(word, F.lit(STRIPPED), F.lit(""))


def sentence_array(body: Column) -> Column:
    """Sentences of a body in order, blank pieces left out before numbering."""
    text = F.replace(body, F.lit(DELIMITER_TAIL), F.lit(""))
    return F.filter(F.split(text, SENTENCE_END), has_ink)


def sentence_word_array(sentence: Column) -> Column:
    """Distinct words of one sentence and maybe an empty string, which is no word.
    Only spaces separate words here, so words around a tab or a line break fuse."""
    cleaned = F.regexp_replace(F.lower(sentence), _NOISE_IN_SENTENCE, "")
    return F.array_distinct(F.split(cleaned, " "))


def join_sentences(sentences: Column) -> Column:
    """Concatenate an array of sentences, each closed by a full stop and a space."""
    closed = F.transform(
        sentences, lambda s: F.concat(s, F.when(s.endswith("."), " ").otherwise(". "))
    )
    return F.array_join(closed, "")


def letter_bucket(word: Column) -> Column:
    """Bucket 0..4 by first letter: a-d, e-k, l-q, r-u, v-z; anything else 0."""
    first = F.lower(F.substring(word, 1, 1))
    return (
        F.when(first.between("e", "k"), 1)
        .when(first.between("l", "q"), 2)
        .when(first.between("r", "u"), 3)
        .when(first.between("v", "z"), 4)
        .otherwise(0)
    )
