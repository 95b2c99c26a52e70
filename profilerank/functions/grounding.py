"""Checks that a generated sentence says only what the facts say."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

# --- fixed values: patterns, allowed acronyms, contrast words and the length limit ---
NUMBER = r"\b\d+(?:\.\d+)?\b"
PHRASE = r"\b(?:[A-Z][a-zA-Z0-9]+(?:\s+|-)){1,3}[A-Z][a-zA-Z0-9]+\b"
ACRONYM = r"\b[A-Z]{2,6}\b"
ALLOWED_ACRONYMS = ["JD", "AI", "ML", "NLP", "CPU", "GPU", "API", "CSV", "ID"]
CONTRAST = [
    "however", "but", "though", "concern", "gap", "lacks", "no ", "not ", "below", "outside", "caution", "shorter",
    "limited",
]
MAX_LENGTH = 360
QUOTES = r"""^["']|["']$"""
LEAD_IN = r"(?i)^(sure[,!:]?\s*|here'?s?\s+(the\s+)?note[:\s]*|note[:\s]+)"
SENTENCE_START = r"(?<=[.!?]\s)"


def text_clean(text: Column) -> Column:
    """Without quotes around it and without a lead-in such as "Sure," or "Note:"."""
    bare = strip(F.regexp_replace(strip(text), QUOTES, ""))
    return strip(F.regexp_replace(bare, LEAD_IN, ""))


def _all_found(found: Column, blob: Column, lower: bool) -> Column:
    return F.forall(found, lambda x: blob.contains(F.lower(x) if lower else x))


def ground_numbers(text: Column, blob: Column) -> Column:
    """Whether every number of the text occurs in the facts."""
    return _all_found(F.regexp_extract_all(text, F.lit(NUMBER), 0), blob, lower=False)


def lower_sentence_starts(text: Column) -> Column:
    """The text with the first letter of each sentence in lower case."""
    sentences = F.split(text, SENTENCE_START)
    return F.array_join(F.transform(sentences, lambda s: F.concat(F.lower(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))), "")


def ground_entities(text: Column, blob: Column) -> Column:
    """Whether capitalised phrases and acronyms, sentence starts aside, occur in the facts."""
    flat = lower_sentence_starts(text)
    acronyms = F.filter(F.regexp_extract_all(flat, F.lit(ACRONYM), 0), lambda a: ~a.isin(*ALLOWED_ACRONYMS))
    return _all_found(F.regexp_extract_all(flat, F.lit(PHRASE), 0), blob, True) & _all_found(acronyms, blob, True)


def ground_tone(text: Column, has_concerns: Column) -> Column:
    """Whether the text has a usable length and, given concerns, a word of contrast."""
    lowered, contrast = F.lower(text), F.lit(False)
    for word in CONTRAST:
        contrast = contrast | lowered.contains(word)
    return F.length(text).between(1, MAX_LENGTH) & (~has_concerns | contrast)


def grounded(text: Column, blob: Column, has_concerns: Column) -> Column:
    checks = ground_numbers(text, blob) & ground_entities(text, blob) & ground_tone(text, has_concerns)
    return F.coalesce(checks, F.lit(False))
