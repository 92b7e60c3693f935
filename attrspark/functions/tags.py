"""Tag strings: split, clean, and group by keyword."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrspark.functions.names import WHITESPACE, quote, strip
from attrspark.schema import TAG_GROUPS


@dataclass(frozen=True)
class TagRules:
    """Keywords per group. Groups are tried in order; the first that matches wins."""

    appearance: tuple[str, ...]
    clothing: tuple[str, ...]
    character: tuple[str, ...]
    character_suffix: str


# Keywords of the two rule sets (shard texts, dataset columns).
SHARD_RULES = TagRules(
    appearance=("hair", "eyes", "eye", "skin", "face", "body"),
    clothing=("dress", "shirt", "pants", "skirt", "uniform", "clothes"),
    character=("girl", "boy"),
    character_suffix="_(character)",
)
DATASET_RULES = TagRules(
    appearance=("hair", "eyes", "eye", "skin", "face", "body", "ears"),
    clothing=("dress", "shirt", "pants", "skirt", "uniform", "clothes", "jacket", "coat"),
    character=("girl", "boy", "character"),
    character_suffix="_(character)",
)


def split_commas(text: Column) -> Column:
    """Comma-separated tags, stripped; empty tags stay, so '' gives one empty tag."""
    return F.transform(F.split(text, ",", -1), strip)


def split_auto(tags: Column, data_type: T.DataType) -> Column:
    """Tags from a list, a comma-separated or a blank-separated string; no empty tags.

    List elements are kept as they are, strings are stripped tag by tag.
    """
    if isinstance(data_type, T.ArrayType):
        return F.filter(tags, lambda t: t.isNotNull() & (strip(t) != ""))
    blanks = "[" + WHITESPACE + "]+"
    parts = F.when(F.contains(tags, F.lit(",")), F.split(tags, ",", -1)).otherwise(
        F.split(tags, blanks, -1)
    )
    return F.filter(F.transform(parts, strip), lambda t: t != "")


def tag_group(tag: str, low: str, rules: TagRules) -> str:
    """SQL for the group of a tag; `low` is the tag in lower case. Keywords match anywhere."""

    def has(words: tuple[str, ...]) -> str:
        return " OR ".join(f"contains({low}, {quote(w)})" for w in words)

    return (
        f"CASE WHEN {has(rules.appearance)} THEN 'appearance_tags'"
        f" WHEN {has(rules.clothing)} THEN 'clothing_tags'"
        f" WHEN {has(rules.character)} OR endswith({tag}, {quote(rules.character_suffix)})"
        " THEN 'character_tags' ELSE 'other_tags' END"
    )


def with_tags(
    df: DataFrame, tags: Column, rules: TagRules, name: str = "tags", only_if: Column | None = None
) -> DataFrame:
    """Add a tag struct built from an array of tags.

    A null array gives empty lists and count 0. Rows where `only_if` is false get
    no tag struct at all.
    """
    empty = F.array().cast("array<string>")
    # Each tag is lowered and looked at once; the four lists only compare the group name.
    lowered = "transform(__tags, t -> struct(t AS tag, lower(t) AS low))"
    grouped = f"transform({lowered}, t -> struct(t.tag AS tag, {tag_group('t.tag', 't.low', rules)} AS grp))"
    lists = ", ".join(
        f"{quote(g)}, transform(filter(__grouped, g -> g.grp = {quote(g)}), g -> g.tag)" for g in TAG_GROUPS
    )
    struct = F.expr(
        f"named_struct('raw_tags', __tags, 'categorized', named_struct({lists}), 'tag_count', size(__tags))"
    )
    if only_if is not None:
        struct = F.when(only_if, struct)
    return (
        df.withColumn("__tags", F.coalesce(tags, empty))
        .withColumn("__grouped", F.expr(grouped))
        .withColumn(name, struct)
        .drop("__tags", "__grouped")
    )


def tag_source(df: DataFrame, first: str = "general", second: str = "tag_string_general") -> Column:
    """Tags of the first column that has any, each column list- or string-typed."""

    def tags_of(name: str) -> Column | None:
        if name not in df.columns:
            return None
        column, kind = F.col(name), df.schema[name].dataType
        some = F.size(column) > 0 if isinstance(kind, T.ArrayType) else F.length(column) > 0
        return F.when(some, split_auto(column, kind))

    found = [t for t in (tags_of(first), tags_of(second)) if t is not None]
    return F.coalesce(*found) if found else F.lit(None).cast("array<string>")
