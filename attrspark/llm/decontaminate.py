"""Benchmark passages in documents, by pigeonhole pieces and Myers' bit-parallel distance.

Texts are compared lower-cased, with every run of white space as one space. A passage that
contains an item of m characters with at most k = floor(m * error_rate) edits leaves at
least one of k + 1 pieces of the item untouched, so exact hits of pieces, found by one
automaton over all pieces, cannot miss it. Around each hit Myers' algorithm gives the
smallest edit distance of the item to any stretch of the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.08
SLICE_CHARS = 4 << 20
MATCHES = "doc_id long, item_id long, distance int, budget int, start long, end long"


def plain(text: str | None) -> str:
    """Lower case, white-space runs as one space, trimmed; null is empty."""
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length that cover the item."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]


def closest(item: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of `item` to a stretch of `text`, and the first end of such a stretch."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    m = len(item)
    every, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = every, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        rises = (down | ~(horizontal | up)) & every
        falls = up & horizontal
        if rises & high:
            score += 1
        elif falls & high:
            score -= 1
            if score < best:
                best, at = score, j
        rises, falls = (rises << 1) & every, (falls << 1) & every
        up = (falls | ~(vertical | rises)) & every
        down = rises & vertical
    return best, at


class Matcher:
    """Finds items in plain texts; `items` are (id, plain text) pairs."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = items
        self.budgets = [int(len(text) * error_rate) for _, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.budgets[number]):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """The best match per item: (item id, distance, budget, start, end)."""
        spots: dict[int, set[int]] = {}
        for last, (length, where) in self.automaton.iter(text):
            for number, offset in where:
                spots.setdefault(number, set()).add(last - length + 1 - offset)
        for number, starts in spots.items():
            item_id, item = self.items[number]
            budget, found, upto = self.budgets[number], None, None
            stretch: list[int] | None = None
            windows: list[list[int]] = []
            for start in sorted(starts):  # windows of hits that lie together are searched as one
                a, b = max(0, start - budget), min(len(text), start + len(item) + budget)
                if stretch and a <= stretch[1]:
                    stretch[1] = b
                else:
                    stretch = [a, b]
                    windows.append(stretch)
            for a, b in windows:
                distance, at = closest(item, text[a:b])
                if distance <= budget and (found is None or distance < found):
                    found, upto = distance, a + at
            if found is not None:
                low = max(0, upto - len(item) - found)
                _, back = closest(item[::-1], text[low:upto][::-1])
                yield item_id, found, budget, upto - back, upto


def contaminated(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and item that it contains with at most floor(m * error_rate) edits.

    `docs(doc_id, text)`, `items(item_id, text)`. Columns: doc_id, item_id, distance, budget,
    and start and end of the closest stretch in the plain text. Items are taken to the tasks
    in slices of about `SLICE_CHARS` characters, one pass over the documents each, so what a
    task holds does not grow with the benchmark. Documents are neither shuffled nor joined.

    Null and blank items match nothing, null and empty texts contain nothing; null ids come
    back as null. Repeated documents give a row each, as do items with equal texts; repeated
    rows of an item count once. An item of fewer than 1 / error_rate characters must occur
    exactly. Other columns are ignored. No items or no matches: no rows.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    listed = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    listed = listed.where(F.col("text").isNotNull()).distinct()
    total = listed.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = max(1, -(-total // SLICE_CHARS))
    parts = [_matches(narrow, listed.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i), error_rate) for i in range(count)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _matches(docs: DataFrame, items: DataFrame, error_rate: float) -> DataFrame:
    held = sorted({(r.item_id, text) for r in items.collect() if (text := plain(r.text))}, key=repr)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, error_rate) if shared.value else None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)) if matcher else ():
                for found in matcher.find(plain(text.as_py())):
                    rows.append((doc_id.as_py(), *found))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            names = ["doc_id", "item_id", "distance", "budget", "start", "end"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.mapInArrow(match, MATCHES)
