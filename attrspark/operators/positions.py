"""Row positions, batches, ranges and numbering within groups, without a one-task window.

`row_number()` over an unpartitioned window moves the whole table into one task,
and over a partitioned one it moves each group into one task. Here the keys alone are
range-partitioned and sorted, numbered inside their partition, and shifted by the number of
rows in the partitions before, so neither the table nor a hot group has to fit one task, and
what rows hold besides their keys is neither sorted nor copied. Ranges need no positions:
the keys at their ends are searched for, and rows stay where they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from attrspark.session import freeze

#: From so few candidates on, the key at a rank is found by a top-k over key columns.
FEW_ROWS = 10_000
#: Bounds tried in one pass over the candidates.
BOUNDS = 16


@dataclass(frozen=True)
class Key:
    """A column to order by. As in Spark, nulls come first when ascending, else last."""

    name: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        return F.desc(self.name) if self.descending else F.asc(self.name)

    def before(self, value: Column) -> Column:
        """Whether a row comes before those with this value (a constant)."""
        mine = F.col(self.name)
        if self.descending:
            return F.when(value.isNull(), mine.isNotNull()).otherwise(F.coalesce(mine > value, F.lit(False)))
        return F.when(value.isNull(), F.lit(False)).otherwise(mine.isNull() | F.coalesce(mine < value, F.lit(False)))


Order = list["Column | str | Key"]


def sort_keys(order: Order) -> list[Key]:
    """The columns of an order given by names, `Key`s, or what F.asc and F.desc return."""
    keys = []
    for item in order:
        if isinstance(item, Column):
            found = re.fullmatch(r"Column<'(.+) (ASC|DESC) NULLS (FIRST|LAST)'>", str(item))
            if found is None or (found[2] == "DESC") != (found[3] == "LAST"):
                raise ValueError(f"order by columns, ascending or descending, not by {item}")
            item = Key(found[1].strip("`"), found[2] == "DESC")
        keys.append(item if isinstance(item, Key) else Key(item))
    return keys


def with_position(df: DataFrame, order: Order, name: str = "pos") -> DataFrame:
    """Add the 0-based position in the given order.

    Only the distinct keys are sorted and written; rows meet their positions on the keys, in
    one shuffle and without a copy of what else they hold. Rows that tie in all keys get
    positions in no particular order, in one task per key: end the order with a unique column.
    """
    keys = sort_keys(order)
    return _placed(df, keys, *_numbered(df, keys), name)


def _numbered(df: DataFrame, keys: list[Key]) -> tuple[DataFrame, bool]:
    """Distinct keys with `__n` rows each and `__first`, the position of the first of them;
    whether any key has several rows."""
    names, sort = [k.name for k in keys], [k.sort for k in keys]
    counted = df.select(*names).groupBy(*names).agg(F.count("*").alias("__n"))
    ordered = counted.repartitionByRange(*sort).sortWithinPartitions(*sort)
    ordered = freeze(ordered.withColumn("__row", F.monotonically_increasing_id()))
    if ordered.where("__n > 1").isEmpty():
        return _shifted(ordered, "__first"), False
    ordered = ordered.withColumn("__part", F.shiftrightunsigned("__row", 33))
    sums = ordered.groupBy("__part").agg(F.sum("__n").alias("__m"))
    until = Window.rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__part", F.coalesce(F.sum("__m").over(until.orderBy("__part")), F.lit(0)).alias("__start"))
    inside = F.coalesce(F.sum("__n").over(until.partitionBy("__part").orderBy("__row")), F.lit(0))
    ordered = ordered.withColumn("__inside", inside).join(F.broadcast(starts), "__part")  # a row per partition
    first = (F.col("__start") + F.col("__inside")).alias("__first")
    return ordered.select(*names, "__n", first), True


def _same(names: list[str], prefix: str) -> Column:
    found = F.lit(True)
    for n in names:
        found = found & F.col(n).eqNullSafe(F.col(f"{prefix}{n}"))
    return found


def _placed(
    df: DataFrame, keys: list[Key], numbered: DataFrame, tied: bool, name: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows with the positions (and `keep` columns) of their keys."""
    names = [k.name for k in keys]
    if not tied and set(df.columns) == set(names):  # the keys are all there is
        return numbered.select(*df.columns, F.col("__first").alias(name), *keep)
    right = numbered.select(*(F.col(n).alias(f"__{n}") for n in names), "__first", *keep)
    joined = df.join(right, _same(names, "__"))
    position = F.col("__first")
    if tied:
        position = position + F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0))) - 1
    return joined.select(*df.columns, position.cast("long").alias(name), *keep)


def _shifted(numbered: DataFrame, name: str) -> DataFrame:
    """Position from `__row`, which counts rows of a partition in its low 33 bits."""
    part = F.shiftrightunsigned("__row", 33)
    counts = numbered.groupBy(part.alias("__part")).agg(F.count("*").alias("__n_part"))
    # One row per partition: the only unpartitioned window, over a few thousand rows at most.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("__part"), F.coalesce(F.sum("__n_part").over(before), F.lit(0)).alias("__start")
    )
    local = F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")  # as many rows as there are partitions
        .withColumn(name, F.col("__start") + local)
        .drop("__part", "__start", "__row")
    )


def with_scan_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """Add the 0-based position in file order to a DataFrame that only scans and projects files.

    Rows stay where they are: no shuffle and no copy. Row counts per scan task are taken
    first, reading no columns; the files, the settings that split them into tasks and the
    default parallelism must not change in between, as the split depends on them all.
    """
    return _shifted(df.withColumn("__row", F.monotonically_increasing_id()), name)


def number_within(
    df: DataFrame, group: list[str], order: list[str], name: str = "member_no", size: str = "n_members"
) -> DataFrame:
    """Add the 0-based rank of each row in its group, and the size of the group.

    Groups are measured on the sorted keys, so that rows meet rank and size in the one join
    that places them.
    """
    keys = sort_keys([*group, *order])
    numbered, tied = _numbered(df, keys)
    spans = numbered.groupBy(*group).agg(F.min("__first").alias("__from"), F.sum("__n").alias(size))
    spans = spans.select(*(F.col(g).alias(f"__of_{g}") for g in group), "__from", size)
    numbered = numbered.join(spans, _same(group, "__of_"))
    placed = _placed(df, keys, numbered, tied, "__pos", ("__from", size))
    return placed.select(*df.columns, (F.col("__pos") - F.col("__from")).alias(name), size)


def assign_batches(df: DataFrame, order: Order, batch_size: int, name: str = "batch"):
    """Add the number of the fixed-size batch each row falls into."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    placed = with_position(df, order, "__pos")
    return placed.withColumn(name, F.floor(F.col("__pos") / F.lit(batch_size))).drop("__pos")


def _compared(keys: list[Key], at: Row, df: DataFrame) -> tuple[Column, Column]:
    """Whether a row comes before the keys of `at`, and whether it has the same."""
    before, equal = F.lit(False), F.lit(True)
    for k in keys:
        value = F.lit(at[k.name]).cast(df.schema[k.name].dataType)
        before = before | (equal & k.before(value))
        equal = equal & F.col(k.name).eqNullSafe(value)
    return before, equal


def key_at(df: DataFrame, order: Order, rank: int) -> tuple[Row | None, int]:
    """The keys of the row at a 0-based rank, and how many rows come before all that tie with it;
    (None, rows) beyond the end.

    Passes over the key columns alone narrow the range that holds the rank. Each draws a few
    keys from the range, those with the smallest hashes, and counts the rows before and up to
    each; drawn keys leave the range, so a key with many rows is found like any other.
    When few rows are left, a top-k over their keys ends it. Nothing is sorted or moved as a
    whole, and the driver sees counts and a few keys, whatever the rank.
    """
    keys = sort_keys(order)
    names = [k.name for k in keys]
    left = df.select(*names)
    skipped, size = 0, left.count()
    if rank >= size:
        return None, size
    seed = 0
    while size > FEW_ROWS:
        whole, seed = F.struct(*names), seed + BOUNDS
        drawn = left.agg(*(F.min_by(whole, F.xxhash64(*names, F.lit(seed + i))).alias(f"k{i}") for i in range(BOUNDS)))
        bounds = list(dict.fromkeys(drawn.first()))
        tests = [_compared(keys, b, left) for b in bounds]
        counts = left.agg(*(F.count_if(c).alias(f"c{i}") for i, c in enumerate(c for b, e in tests for c in (b, b | e)))).first()
        below, upto = counts[::2], counts[1::2]
        wanted = rank - skipped
        for bound, n, m in zip(bounds, below, upto):
            if n <= wanted < m:
                return bound, skipped + n
        high = min((i for i in range(len(bounds)) if below[i] > wanted), key=lambda i: below[i], default=None)
        low = max((i for i in range(len(bounds)) if upto[i] <= wanted), key=lambda i: upto[i], default=None)
        if high is not None:
            left, size = left.where(tests[high][0]), below[high]
        if low is not None:
            left = left.where(~(tests[low][0] | tests[low][1]))
            skipped, size = skipped + upto[low], size - upto[low]
    at = left.orderBy(*(k.sort for k in keys)).offset(rank - skipped).limit(1).first()
    return at, skipped + left.where(_compared(keys, at, left)[0]).count()


def _some(rows: DataFrame, n: int) -> DataFrame:
    """Any n of rows that tie; they are copied, so that the choice stays the same."""
    numbered = _shifted(freeze(rows.withColumn("__row", F.monotonically_increasing_id())), "__at")
    return numbered.where(F.col("__at") < n).drop("__at")


def take(df: DataFrame, order: Order, n: int, among: DataFrame | None = None) -> DataFrame:
    """The first n rows in the given order."""
    return skip_take(df, order, 0, n, among)


def skip_take(df: DataFrame, order: Order, skip: int, n: int, among: DataFrame | None = None) -> DataFrame:
    """Rows skip .. skip+n-1 in the given order, clipped to the table; in no particular order.

    The keys at both ends are found first; rows between them are kept where they are, whatever
    their number. Where an end cuts through rows that tie, any of these are taken. `df` must
    give the same rows each time it is read; if it costs more than a scan, give its key columns
    as a table `among`.
    """
    if skip < 0 or n < 0:
        raise ValueError("skip and n must not be negative")
    if n == 0:
        return df.limit(0)
    keys = sort_keys(order)
    among = df if among is None else among
    first, before_first = key_at(among, order, skip) if skip else (None, 0)
    if skip and first is None:
        return df.limit(0)
    end, before_end = key_at(among, order, skip + n)
    if first is not None and first == end:
        return _some(df.where(_compared(keys, first, df)[1]), n)
    inside, more = F.lit(True), []
    if first is not None:
        before, equal = _compared(keys, first, df)
        inside = ~before
        cut = skip - before_first
        if cut:
            inside = inside & ~equal
            ties = df.where(equal)
            more.append(_some(ties, ties.count() - cut))
    if end is not None:
        before, equal = _compared(keys, end, df)
        inside = inside & before
        if skip + n > before_end:
            more.append(_some(df.where(equal), skip + n - before_end))
    rows = df.where(inside)
    for part in more:
        rows = rows.unionByName(part)
    return rows


def literal(row: Row, df: DataFrame, names: list[str]) -> Column:
    """A struct constant with the values of a row, typed like the columns of `df`."""
    return F.struct(*[F.lit(row[n]).cast(df.schema[n].dataType).alias(n) for n in names])


def take_in_place(df: DataFrame, order: Order, n: int, among: DataFrame | None = None) -> DataFrame:
    """The first n rows and those that tie with the last of them, kept where they are."""
    if n <= 0:
        return df.limit(0)
    last, _ = key_at(df if among is None else among, order, n - 1)
    if last is None:
        return df
    before, equal = _compared(sort_keys(order), last, df)
    return df.where(before | equal)


def default_id(given: Column, position: Column, prefix: str = "sample_") -> Column:
    """The given id, or one made from the row position."""
    return F.coalesce(given.cast("string"), F.concat(F.lit(prefix), position.cast("string")))


def default_batch_id(given: Column, position: Column, batch_size: int) -> Column:
    """The given id, or `batch_<first row of the batch>_<row in the batch>`."""
    row = F.pmod(position, F.lit(batch_size))
    made = F.concat_ws("_", F.lit("batch"), (position - row).cast("string"), row.cast("string"))
    return F.coalesce(given.cast("string"), made)
