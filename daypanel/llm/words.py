"""Words of texts as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"\x20\x09-\x0D"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other characters as they are. Texts of single bytes take the plain function, which is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _parts(text: Column, gaps: str) -> Column:
    """What lies between runs of separators; only the first and the last part can be empty."""
    parts = F.split(text, gaps)
    return F.filter(parts, lambda word: word != "")


def blank_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; no words in a null."""
    return F.coalesce(_parts(text, f"[{BLANKS}]+"), F.array().cast("array<string>"))


def letter_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased; no words in a null."""
    return F.coalesce(_parts(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.array().cast("array<string>"))


def shingle_hashes(words: str, k: int) -> Column:
    """Hash of the k words from each position on, as an array; null where fewer are left. ``words`` names a column."""
    array = F.col(words)

    def at(word: Column, i: Column) -> Column:
        run = [word, *[F.get(array, i + j) for j in range(1, k)]]
        return F.when(i + k <= F.size(array), F.xxhash64(*run))

    return F.transform(array, at)
