"""Expressions over the attribute record and the result row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attrspark.functions.names import quote
from attrspark.vocabulary import IMAGE_VOCABULARY, Vocabulary

JSON_OPTIONS = {"ignoreNullFields": "false"}


def empty_record(vocabulary: Vocabulary = IMAGE_VOCABULARY) -> Column:
    """A record whose attributes are all null."""
    fields = ", ".join(f"{quote(n)}, CAST(NULL AS STRING)" for n in vocabulary.names)
    return F.expr(f"named_struct({fields})")


def widen(record: str, has: list[str], vocabulary: Vocabulary = IMAGE_VOCABULARY) -> Column:
    """Lay the attributes in `has` out in the full record; the others are null."""
    fields = [
        f"{quote(n)}, " + (f"{record}.`{n}`" if n in has else "CAST(NULL AS STRING)") for n in vocabulary.names
    ]
    return F.expr(f"named_struct({', '.join(fields)})")


def to_json(record: Column) -> Column:
    """JSON text with nulls spelled out."""
    return F.to_json(record, JSON_OPTIONS)


def from_json(text: Column, vocabulary: Vocabulary = IMAGE_VOCABULARY) -> Column:
    """Record from JSON text: unknown keys are dropped, missing keys become null."""
    return F.from_json(text, vocabulary.schema)


def is_empty(record: Column, vocabulary: Vocabulary = IMAGE_VOCABULARY) -> Column:
    """True when every attribute is null."""
    return F.coalesce(*[record[n] for n in vocabulary.names]).isNull()


def filled(record: Column, vocabulary: Vocabulary = IMAGE_VOCABULARY) -> Column:
    """Map of the attributes that have a value."""
    pairs = [c for n in vocabulary.names for c in (F.lit(n), record[n])]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def status(record: Column, error: Column, vocabulary: Vocabulary = IMAGE_VOCABULARY) -> Column:
    """'error', 'empty' or 'filled'."""
    return (
        F.when(error.isNotNull(), "error")
        .when(is_empty(record, vocabulary), "empty")
        .otherwise("filled")
    )
