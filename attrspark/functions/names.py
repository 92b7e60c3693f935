"""File-name expressions: basename, suffix, stem, kind and item id."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes each reader accepts.
SHARD_IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".webp")
STREAM_IMAGE_SUFFIXES = (".jpg", ".png", ".jpeg")
DIRECTORY_IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".webp")
DIRECTORY_JOB_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tiff")
TEXT_SUFFIXES = (".txt",)

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quote(text: str) -> str:
    """The text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: Column) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot; '' when there is none (`.jpg` alone has none)."""
    # Leading dots belong to the name.
    rest = F.ltrim(basename(path), F.lit("."))
    ending = F.substring_index(rest, ".", -1)
    found = F.contains(rest, F.lit(".")) & (ending != "")
    return F.when(found, F.lower(F.concat(F.lit("."), ending))).otherwise("")


def stem(path: Column) -> Column:
    """Basename without its last suffix."""
    return F.regexp_replace(basename(path), r"^(\.*[^.].*)\.[^.]*$", "$1")


def has_suffix(path: Column, suffixes: Iterable[str]) -> Column:
    return suffix(path).isin(list(suffixes))


def member_kind(
    path: Column,
    images: Iterable[str] = SHARD_IMAGE_SUFFIXES,
    texts: Iterable[str] = TEXT_SUFFIXES,
) -> Column:
    """'image', 'text' or 'other' by suffix."""
    ext = suffix(path)
    return (
        F.when(ext.isin(list(images)), "image").when(ext.isin(list(texts)), "text").otherwise("other")
    )


def item_id(path: Column, prefix: str) -> Column:
    """`<prefix>_<number>` from `<prefix>_<number>_<hash>.<ext>`; null without the prefix."""
    base = basename(path)
    return F.when(F.startswith(base, F.lit(prefix + "_")), F.substring_index(base, "_", prefix.count("_") + 2))
