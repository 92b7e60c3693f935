"""SimHash fingerprints of whole texts, and search by permuted block tables.

DataFrame functions only. Terms are pairs of neighbouring words (a single word for texts of
one word), weighted by their occurrences and their length, as long terms say more. Each
term's 128-bit hash votes with its weight for or against each bit; the sign of the sum is
the fingerprint's bit. Two votes share one 64-bit sum, so a text takes 64 sums.

Fingerprints within a Hamming radius r are found exactly: bits are cut into m blocks, and
block i has a limit t_i so that the sum of all t_i + 1 is r + 1; two fingerprints within the
radius differ by at most t_i bits in some block i. Each block in turn comes first in a table
of its own. A query looks up all values within t_i bits of its block; the distance of whole
fingerprints decides. How many blocks there are changes the cost alone, never the result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrspark.llm.token_files import tasks_for
from attrspark.session import scratch_path

BITS = 128
#: All 293 pairs of unequal documents with similarity >= 0.8 (five words) and at most 30 bits
#: between them on sf0.1 are 5 to 21 bits apart.
RADIUS = 21
BLOCK_BYTES = 16 << 20
#: The edges between blocks are part of the plan; of more than a TB, blocks get larger.
MOST_BLOCKS = 1 << 16
_PAIR = 0x100000001
_FIRST = -(1 << 63)


def _bit_sums() -> list[Column]:
    """Per hash half and bit i: the weight for bit i, and that for bit i + 32 times 2^32."""
    return [
        F.sum(F.shiftrightunsigned(half, i).bitwiseAND(F.lit(_PAIR)) * F.col("weight")).alias(f"{half}_{i}")
        for half in ("h0", "h1")
        for i in range(32)
    ]


def _half(half: str) -> Column:
    """64 bits from 32 sums: a bit is set if more than half of the weight is for it."""
    bits = F.lit(0).cast("long")
    for i in range(32):
        both = F.col(f"{half}_{i}")
        low = both.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("total")
        high = F.shiftrightunsigned(both, 32) * 2 > F.col("total")
        bits = bits.bitwiseOR(F.when(low, F.lit(1 << i)).otherwise(F.lit(0)))
        bits = bits.bitwiseOR(F.when(high, F.lit((1 << (i + 32)) - (1 << 64) * (i == 31))).otherwise(F.lit(0)))
    return bits


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """`keys`, f0 and f1: the halves of the fingerprint of each row of `texts`.

    `keys` must tell rows apart; if `texts` is partitioned by some of them, nothing is
    shuffled. Texts without words have the fingerprint 0.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    cut = texts.select(*keys, F.explode(F.array(words)).alias("_words"))
    follow = F.slice("_words", 2, F.greatest(F.size("_words") - 1, F.lit(1)))
    terms = cut.select(*keys, F.explode_outer(F.arrays_zip(F.col("_words").alias("a"), follow.alias("b"))).alias("t"))
    # The last word has no neighbour; it counts only where it is the only one.
    terms = terms.select(*keys, F.col("t.a").alias("a"), F.col("t.b").alias("b"))
    votes = terms.select(
        *keys,
        F.xxhash64("a", "b").alias("h0"),
        F.xxhash64("b", "a", F.lit(1)).alias("h1"),
        F.when(F.col("a").isNull(), 0)
        .when(F.col("b").isNull(), 1)
        .otherwise((F.char_length("a") + F.char_length("b")) * 2)
        .cast("long")
        .alias("weight"),
    )
    sums = votes.groupBy(*keys).agg(F.sum("weight").alias("total"), *_bit_sums())
    return sums.select(*keys, _half("h0").alias("f0"), _half("h1").alias("f1"))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits of two fingerprints, columns f"{a}0" and f"{a}1" and so on."""
    return 1 - sum(F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in (0, 1)) / BITS


def as_text(a: str) -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(f"{a}{i}"), 16, "0") for i in (1, 0))))


def blocks_for(radius: int, prints: int) -> list[tuple[int, int, int]]:
    """(first bit, width, limit) of each block, for the least work over so many fingerprints.

    A probe is made and shuffled, a candidate only compared, so it counts half.
    """

    def cut(m: int) -> list[tuple[int, int, int]]:
        edges = [BITS * i // m for i in range(m + 1)]
        each, more = divmod(radius + 1, m)
        limits = [each - 1 + (i < more) for i in range(m)]
        return [(a, z - a, t) for a, z, t in zip(edges, edges[1:], limits) if t >= 0]

    def work(blocks: list[tuple[int, int, int]]) -> float:
        probes = [(sum(comb(width, k) for k in range(limit + 1)), width) for _, width, limit in blocks]
        return sum(n + prints * n / 2**width / 2 for n, width in probes)

    return min((cut(m) for m in range(2, max(radius + 1, 2) + 1)), key=work)


def near_pairs(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """qf0, qf1, f0, f1: each distinct fingerprint of `queries(f0, f1)` with each distinct one
    of `prints(f0, f1)` within `radius` bits of it, once.

    A pair is taken in the first table in which its blocks are within the block's limit.
    """
    counted = prints.select("f0", "f1").distinct()
    blocks = blocks_for(radius, counted.count())

    def block(first: int, width: int) -> Column:
        half, shift = divmod(first, 64)
        value = F.shiftrightunsigned(f"f{half}", shift)
        if shift + width > 64:
            value = value.bitwiseOR(F.shiftleft("f1", 64 - shift))
        return value.bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else value

    def probes(number: int, width: int, limit: int) -> Column:
        one = lambda m: F.struct(F.lit(number).alias("number"), m.bitwiseXOR(F.col(f"b{number}")).alias("value"))
        return F.transform(masks(width, limit), one)

    def masks(width: int, limit: int) -> Column:
        """All values with at most `limit` of `width` bits set."""
        some = (sum(1 << b for b in bits) for k in range(limit + 1) for bits in combinations(range(width), k))
        return F.expr("array(" + ", ".join(f"bigint('{v - (1 << 64) * (v >> 63)}')" for v in some) + ")")

    own = F.array(*(F.struct(F.lit(i).alias("number"), block(a, w).alias("value")) for i, (a, w, _) in enumerate(blocks)))
    tables = counted.select("f0", "f1", F.explode(own).alias("block")).select("f0", "f1", "block.*")
    asked = queries.select("f0", "f1").distinct().select("*", *(block(a, w).alias(f"b{i}") for i, (a, w, _) in enumerate(blocks)))
    around = F.concat(*(probes(i, w, t) for i, (_, w, t) in enumerate(blocks)))
    asked = asked.select(F.col("f0").alias("qf0"), F.col("f1").alias("qf1"), F.explode(around).alias("block"))
    # Both sides grow with the data, and Spark would size the probes by the rows before the
    # generator: they meet in a shuffle.
    pairs = tables.join(asked.select("qf0", "qf1", "block.*").hint("merge"), ["number", "value"])

    def apart(first: int = 0, width: int = BITS) -> Column:
        bits = ((1 << width) - 1) << first
        parts = [(bits >> 64 * i) & ((1 << 64) - 1) for i in (0, 1)]
        parts = [p - (1 << 64) * (p >> 63) for p in parts]
        return sum(F.bit_count(F.col(f"f{i}").bitwiseXOR(F.col(f"qf{i}")).bitwiseAND(F.lit(p))) for i, p in enumerate(parts) if p)

    first = F.lit(len(blocks) - 1)
    for i in reversed(range(len(blocks) - 1)):
        a, w, t = blocks[i]
        first = F.when(apart(a, w) <= t, i).otherwise(first)
    return pairs.where((apart() <= radius) & (F.col("number") == first)).select("qf0", "qf1", "f0", "f1")


def near_counts(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """f0, f1, n_near: for each distinct fingerprint of `queries(f0, f1)`, how many rows of
    `prints(f0, f1)` are within `radius` bits of it."""
    counted = prints.groupBy("f0", "f1").agg(F.count("*").alias("n"))
    near = near_pairs(prints, queries, radius).join(counted, ["f0", "f1"])
    return near.groupBy(F.col("qf0").alias("f0"), F.col("qf1").alias("f1")).agg(F.sum("n").alias("n_near"))


def near_documents(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """f0, f1, n_near and near_ids: as `near_counts` for `prints(doc_id, f0, f1)`, with the
    smallest id of each distinct fingerprint within the radius, ascending: documents of one
    fingerprint are one class, whose members its fingerprint tells, so that a list does not
    grow with the copies. A fingerprint of null ids only is counted, but not listed."""
    classes = prints.groupBy("f0", "f1").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    near = near_pairs(prints, queries, radius).join(classes, ["f0", "f1"])
    ids = F.sort_array(F.collect_list("least"))
    return near.groupBy(F.col("qf0").alias("f0"), F.col("qf1").alias("f1")).agg(F.sum("n").alias("n_near"), ids.alias("near_ids"))


def with_next(docs: DataFrame) -> DataFrame:
    """block, rank, own, doc_id, text and next_text: each document with the one after it.

    Documents are ordered by (doc_id, text), null ids and null texts first; after the last
    comes the first. Ranges of ids between existing ids (quantiles) are the blocks; the
    first document of a block also goes to the block before it (own = false), so each text
    is shuffled once and no task holds more than a block.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    key = F.coalesce("doc_id", F.lit(_FIRST))
    count = min(tasks_for(narrow, BLOCK_BYTES), MOST_BLOCKS)
    shares = [i / count for i in range(1, count)] or [0.5]
    found = narrow.agg(F.min(key), F.percentile_approx(key, shares, 10 * count)).first()
    starts = sorted({found[0], *(found[1] or [])} - {None})
    if not starts:
        starts = [_FIRST]
    # Looked up in two steps, so a row is compared with some 2 * sqrt(blocks) edges.
    step = isqrt(len(starts) - 1) + 1
    heads = F.array(*map(F.lit, starts[::step])).cast("array<bigint>")
    runs = F.array(*(F.array(*map(F.lit, starts[i : i + step])) for i in range(0, len(starts), step)))
    narrow = narrow.withColumn("_run", F.size(F.filter(heads, lambda e: e <= key)) - 1)
    run = F.element_at(runs.cast("array<array<bigint>>"), F.col("_run") + 1)
    at = F.col("_run") * step + F.size(F.filter(run, lambda e: e <= key)) - 1
    first = F.array_contains(run, key)
    before = F.struct(
        F.when(at == 0, len(starts) - 1).otherwise(at - 1).alias("block"), (at == 0).alias("wrapped"), F.lit(False).alias("own")
    )
    own = F.struct(at.alias("block"), F.lit(False).alias("wrapped"), F.lit(True).alias("own"))
    places = F.when(first, F.array(own, before)).otherwise(F.array(own))
    dealt = narrow.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.*")
    dealt = dealt.repartitionById(len(starts), "block")  # a block is a task, none gets two
    order = Window.partitionBy("block").orderBy("wrapped", F.col("doc_id").asc_nulls_first(), "text", F.desc("own"))
    return dealt.select(
        "block", "own", "doc_id", "text", F.row_number().over(order).alias("rank"), F.lead("text").over(order).alias("next_text")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of `docs(doc_id, text)` and of their edited texts, one row per document.

    In the edited text the last floor(n_chars / 2) code points are replaced by the first as
    many (or all) of the next document in ascending doc_id order, after the last by those of
    the first. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (shares of equal bits with the edited text's and the next
    document's fingerprint), and n_near: for documents whose id is divisible by 100 the
    number of documents within `RADIUS` bits, itself included, from permuted block tables,
    and near_ids, in ascending order the smallest id of each distinct fingerprint among them;
    the other members of these classes are the rows with the same fingerprint.

    Null text: empty. Null doc_id: before all others. Repeated doc_id: in the order of the
    texts, each row for itself. Empty texts: fingerprint 0. A single document follows
    itself. Other columns are ignored. No documents: no rows.
    """
    spark = docs.sparkSession
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_next(docs).select("block", "rank", "own", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.select("*", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    both = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("t")) for k, c in enumerate(("text", "edited"))))
    keys = ["block", "rank", "own", "doc_id", "n_chars", "edited_sha256"]
    each = rows.select(*keys, F.explode(both).alias("v")).select(*keys, "v.kind", F.col("v.t").alias("text"))
    prints = fingerprints(each, [*keys, "kind"])
    side = [F.max(F.when(F.col("kind") == k, F.col(f"f{i}"))).alias(f"{name}{i}") for k, name in enumerate("fe") for i in (0, 1)]
    prints = prints.groupBy(*keys).agg(*side)
    order = Window.partitionBy("block").orderBy("rank")
    prints = prints.select("*", *(F.lead(f"f{i}").over(order).alias(f"x{i}") for i in (0, 1))).where("own").drop("block", "rank", "own")
    place = scratch_path(spark, "fingerprints")
    prints.write.parquet(place)
    prints = spark.read.schema(prints.schema).parquet(place)
    asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    counts = near_documents(prints, prints.where(asked))
    out = prints.where(asked).join(counts, ["f0", "f1"]).unionByName(
        prints.where(~asked).withColumns({"n_near": F.lit(None).cast("long"), "near_ids": F.lit(None).cast("array<bigint>")})
    )
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("f").alias("fingerprint"),
        as_text("e").alias("edited_fingerprint"),
        likeness("f", "e").alias("near_edited"),
        likeness("f", "x").alias("near_next"),
        "n_near",
        "near_ids",
    )
