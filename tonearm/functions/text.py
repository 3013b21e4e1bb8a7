"""Text helpers for ids, names and delimited lists."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prefix of the recommendation files.
SEED_FILE_PREFIX = "similar_to_"
# Letters that have no decomposition.
PLAIN_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i", "þ": "th", "ð": "d"}


def _accents() -> dict[str, str]:
    """Lower-case Latin letters with marks, from Unicode's decompositions to a plain letter."""
    letters = map(chr, [*range(0xE0, 0x250), *range(0x1E00, 0x1F00)])
    return {c: unicodedata.normalize("NFD", c)[0] for c in letters if c.islower() and unicodedata.normalize("NFD", c)[0].isascii()}


ACCENTS = _accents()


def split_items(text: Column, delimiter: str = ";") -> Column:
    """Split a delimited list. ``delimiter`` is a Java regex such as ``;`` or ``[;,]``.

    Empty items are kept (``a;;b`` has three items).
    """
    return F.split(text, delimiter)


def item_count(text: Column, delimiter: str = ";") -> Column:
    """Items in a delimited list, 0 for null or blank text."""
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(blank, F.lit(0)).otherwise(F.size(split_items(text, delimiter)))


def slug(name: Column) -> Column:
    """File-safe form of a name: words joined by ``_``, only letters, digits and ``_``."""
    joined = F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and"))
    return F.regexp_replace(joined, r"[^\p{L}\p{N}_]", "")


def seed_name(file_name: Column) -> Column:
    """Artist name held in a recommendation file's name."""
    stem = F.regexp_extract(file_name, rf"{SEED_FILE_PREFIX}(.*)\.csv", 1)
    return F.replace(stem, F.lit("_"), F.lit(" "))


def clip_name(name: Column, length: int = 20) -> Column:
    return F.substring(name, 1, length)


def short_id(text: Column, length: int = 8) -> Column:
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def parse_count(text: Column) -> Column:
    """Whole number written with thousands commas; null where it is none."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("long")


def names_or_none(names: Column, length: int = 5) -> Column:
    """First names of a list as text, ``None`` for an empty list."""
    return F.when(F.size(names) > 0, F.array_join(F.slice(names, 1, length), ", ")).otherwise(F.lit("None"))


def count_label(name: Column, count: Column) -> Column:
    return F.concat(name, F.lit(" ("), count.cast("string"), F.lit(")"))


def normalise_name(name: Column) -> Column:
    """Lower case, punctuation to single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def fold_name(name: Column) -> Column:
    """A name without case, accents, punctuation and a leading article, for searches."""
    plain = F.translate(F.regexp_replace(F.lower(name), r"\p{Mn}", ""), "".join(ACCENTS), "".join(ACCENTS.values()))
    for letter, letters in PLAIN_LETTERS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(letters))
    return F.regexp_replace(normalise_name(plain), "^the (?=.)", "")
