"""A trie of all prefixes of conversations, with totals of what sharing them saves.

A turn is known by a digest of its role and text. Equal conversations become one path with the
number of its members before anything else happens; paths are sorted and range-partitioned, so
a run of paths is a shard of prefixes and a common first turn is spread over many shards. A
shard is packed into a double array over dense turn ids (BASE and CHECK), whose traversal gives
its nodes and their totals. Nodes on the first and last path of a shard may go on in
neighbouring shards: they are the shared upper nodes, whose totals are merged over all shards.

A conversation is one sequence, as a text is: its turn digests (about 50 bytes a turn) have to
fit one task. Members of a node are never gathered: their ids are hashed in sorted chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrspark.session import scratch_path

#: Turns in the paths of one shard, and ids in one chunk.
SHARD_TURNS, CHUNK = 200_000, 8192
NOTHING = hashlib.sha256(b"").hexdigest()

NODES = (
    "key binary, parent binary, path binary, depth long, bytes long, shared boolean, counted boolean, "
    "conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends_sha256 string"
)
_NAMES = [c.split()[0] for c in NODES.split(", ")]


class DoubleArray:
    """Children of node s by turn id c: t = BASE[s] + c if CHECK[t] == s."""

    def __init__(self, size: int):
        self.base, self.check = [0], [0]
        self.size, self.free = size, 1

    def _grow(self, end: int) -> None:
        more = end - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more

    def place(self, node: int, codes: list[int], tries: int = 256) -> list[int]:
        """Give a node its children, whose ids ascend; their places."""
        check, first, span = self.check, codes[0], codes[-1] - codes[0] + 1
        while self.free < len(check) and check[self.free] >= 0:
            self.free += 1
        at = self.free
        for _ in range(tries):
            if at >= len(check):
                break
            if all(at + c - first >= len(check) or check[at + c - first] < 0 for c in codes):
                break
            at += 1
        else:
            at = len(check)
        self._grow(at + span)
        self.base[node] = at - first
        places = [at + c - first for c in codes]
        for place in places:
            check[place] = node
        return places

    def child(self, node: int, code: int) -> int:
        """The place of a child, -1 if there is none."""
        at = self.base[node] + code
        return at if 0 < at < len(self.check) and self.check[at] == node else -1


def shard_nodes(paths: list[tuple[list[tuple[str, int]], int, int, str]]) -> list[tuple]:
    """Rows of NODES of sorted distinct paths (turns as (digest, bytes), members, smallest, hash)."""
    ids: dict[str, int] = {}
    sizes: list[int] = []
    trie = DoubleArray(sum(len(p[0]) for p in paths))
    order, turn_of, depth_of = [0], {0: ""}, {0: 0}
    level = [(0, 0, len(paths))]
    depth = 0
    while level:  # breadth first: ids become dense in the order of the nodes, children of one are close
        below = []
        for node, low, high in level:
            runs: list[tuple[int, int, int]] = []
            i = low
            while i < high:
                turns = paths[i][0]
                if len(turns) == depth:
                    i += 1
                    continue
                digest, size = turns[depth]
                code = ids.get(digest)
                if code is None:
                    code = ids[digest] = len(sizes)
                    sizes.append(size)
                first = i
                while i < high and len(paths[i][0]) > depth and paths[i][0][depth][0] == digest:
                    i += 1
                runs.append((code, first, i))
            if runs:
                runs.sort()
                for place, (code, first, end) in zip(trie.place(node, [r[0] for r in runs]), runs):
                    order.append(place)
                    turn_of[place], depth_of[place] = code, depth + 1
                    below.append((place, first, end))
        level, depth = below, depth + 1

    ends: dict[int, tuple[int, int, str]] = {}
    edge: dict[int, list[list[int]]] = {}
    for number, (turns, members, smallest, digest) in enumerate(paths):
        node, walked = 0, [0]
        for turn, _ in turns:
            node = trie.child(node, ids[turn])
            walked.append(node)
        ends[node] = (members, smallest, digest)
        if number in (0, len(paths) - 1):
            edge[number] = walked
    shared = {n for walked in edge.values() for n in walked}

    n_convs = {n: ends[n][0] if n in ends else 0 for n in order}
    conv = {n: ends[n][1] if n in ends else None for n in order}
    children, leaves, saved = ({n: 0 for n in order} for _ in range(3))
    keys = {0: hashlib.blake2b(b"", digest_size=16).digest()}
    names = list(ids)
    for node in order[1:]:
        keys[node] = hashlib.blake2b(keys[trie.check[node]] + names[turn_of[node]].encode(), digest_size=16).digest()
    for node in reversed(order[1:]):
        above = trie.check[node]
        n_convs[above] += n_convs[node]
        if conv[above] is None or conv[node] < conv[above]:
            conv[above] = conv[node]
        if node not in shared:  # shared nodes add their own part when all shards are known
            children[above] += 1
            leaves[node] += children[node] == 0
            saved[node] += (n_convs[node] - 1) * sizes[turn_of[node]]
        leaves[above] += leaves[node]
        saved[above] += saved[node]

    def row(node: int, path: bytes | None, counted: bool) -> tuple:
        above = trie.check[node] if node else None
        return (
            keys[node], None if above is None else keys[above], path, depth_of[node], sizes[turn_of[node]] if node else 0,
            node in shared, counted, conv[node], None if above is None or above in shared else conv[above],
            n_convs[node] * counted, children[node] * counted, leaves[node] * counted, saved[node] * counted,
            ends[node][2] if node in ends else None,
        )

    rows = [row(n, None, True) for n in order if n not in shared]
    done: set[int] = set()
    for walked in edge.values():
        for node in walked:
            rows.append(row(node, keys[walked[-1]], node not in done))
            done.add(node)
    return rows


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition of paths, shard by shard."""
    schema = _schema()
    held: list[tuple] = []
    turns = 0

    def given() -> Iterator[pa.RecordBatch]:
        rows = shard_nodes(held)
        for i in range(0, len(rows), 50_000):
            columns = zip(*rows[i : i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for digests, sizes, members, smallest, digest in zip(*(c.to_pylist() for c in batch.columns)):
            held.append((list(zip(digests, sizes)), members, smallest, digest))
            turns += len(digests)
            if turns > SHARD_TURNS:
                yield from given()
                held, turns = [], 0
    if held:
        yield from given()


def _schema() -> pa.Schema:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in NODES.split(", "))])


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids with one end, in order, as comma-joined chunks."""
    end, ids = None, []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([end], pa.string()), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()),
             pa.array([",".join(map(str, ids))], pa.string())],
            names=["ending", "first", "n", "ids"],
        )

    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != end or len(ids) == CHUNK:
                if ids:
                    yield given()
                end, ids = key, []
            ids.append(conv)
    if ids:
        yield given()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per end: members, the smallest, and the hash of all its chunks in order."""
    end, members, smallest, digest = None, 0, None, None
    rows: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        out = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        rows.clear()
        return pa.RecordBatch.from_arrays(out, names=["ending", "members", "smallest", "ends_sha256"])

    for batch in batches:
        for key, first, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != end:
                if digest is not None:
                    rows.append((end, members, smallest, digest.hexdigest()))
                end, members, smallest, digest = key, 0, first, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
            members += n
            if len(rows) >= 50_000:
                yield batch_of()
    if digest is not None:
        rows.append((end, members, smallest, digest.hexdigest()))
    if rows:
        yield batch_of()


def ends_of(members: DataFrame) -> DataFrame:
    """ending, members, smallest, ends_sha256 of `members(ending, conv_id)`, whose ids are distinct.

    Ids are sorted over all tasks, so a common end is spread; its ids go on as chunks, one row
    per 8,192 of them, and are hashed as a stream.
    """
    order = ["ending", "conv_id"]
    chunks = members.repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = chunks.mapInArrow(_chunks, "ending string, first long, n long, ids string")
    ordered = chunks.repartition("ending").sortWithinPartitions("ending", "first")
    return ordered.mapInArrow(_hashed, "ending string, members long, smallest long, ends_sha256 string")


def rebuilt(turns: DataFrame, groups: int = 5, folds: int = 9) -> DataFrame:
    """conv_id, digests, sizes: the first h turns of conversation c - c % groups, then the own
    turns of c after its first h; h is crc32 of c in decimal, modulo `folds`."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(32))
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    entry = F.struct("turn", "digest", "size")  # null turns sort first
    place = scratch_path(narrow.sparkSession, "turns")
    own = narrow.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("own"))
    own.select("conv_id", F.col("own.digest").alias("digests"), F.col("own.size").alias("sizes")).write.parquet(place)
    own = narrow.sparkSession.read.parquet(place)
    heads = own.select(
        F.col("conv_id").alias("__base"),
        *(F.slice(c, 1, folds - 1).alias(f"__{c}") for c in ("digests", "sizes")),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % folds).cast("int")

    def joined(c: str) -> Column:
        head = F.coalesce(F.slice(f"__{c}", F.lit(1), h), F.slice(c, 1, 0))
        return F.concat(head, F.slice(c, h + 1, F.size(c))).alias(c)

    base = F.col("conv_id") - F.col("conv_id") % groups
    return own.join(heads, base == F.col("__base"), "left").select("conv_id", joined("digests"), joined("sizes"))


def conversation_trie(turns: DataFrame, groups: int = 5, folds: int = 9) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of
    every node of the trie of rebuilt conversations of `turns(conv_id, turn, role, text)`.

    Turns are in order of `turn`, null first; equal numbers, also of repeated rows, stay turns of
    their own, in order of their digests. Null role or text: empty. Null conv_id: no conversation,
    left out. Very long texts count by digest and length. Empty table: no nodes, no root either.
    Other columns are ignored.
    """
    spark = turns.sparkSession
    place = scratch_path(spark, "rebuilt")
    ending = F.sha2(F.array_join("digests", ""), 256).alias("ending")
    rebuilt(turns, groups, folds).select("conv_id", "digests", "sizes", ending).write.parquet(place)
    convs = spark.read.parquet(place)
    paths = convs.groupBy("ending").agg(F.first("digests").alias("digests"), F.first("sizes").alias("sizes"))
    paths = paths.join(ends_of(convs.select("ending", "conv_id")), "ending")
    paths = paths.select("digests", "sizes", "members", "smallest", "ends_sha256")
    place = scratch_path(spark, "trie")
    paths.repartitionByRange("digests").sortWithinPartitions("digests").mapInArrow(_shards, NODES).write.parquet(place)
    nodes = spark.read.parquet(place)
    upper = merged(nodes.where("shared"))
    private = nodes.where("NOT shared").select(
        "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
    place = scratch_path(spark, "upper")
    upper.write.parquet(place)
    upper = spark.read.parquet(place)
    above = upper.select(F.col("key").alias("__key"), F.col("conv_id").alias("__conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    known = private.where("parent_conv_id IS NOT NULL").select(*columns)
    below = private.where("parent_conv_id IS NULL").unionByName(upper.drop("key", "parent_conv_id"), allowMissingColumns=True)
    below = below.join(above, F.col("parent") == F.col("__key"), "left").withColumn("parent_conv_id", F.col("__conv_id"))
    return known.unionByName(below.select(*columns)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))
    )


def merged(shared: DataFrame) -> DataFrame:
    """The shared upper nodes with their totals over all shards.

    `shared` has a row per node and edge path of a shard. What a shared node adds to those above
    it is added on the smallest path that has the node, as a running sum from its end, and then
    summed by node over its paths: no node lists its ancestors.
    """
    totals = shared.groupBy("key").agg(
        *(F.max(c).alias(c) for c in ("parent", "depth", "bytes", "ends_sha256")),
        F.min("path").alias("owner"),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    place = scratch_path(shared.sparkSession, "shared")
    totals.write.parquet(place)
    totals = shared.sparkSession.read.parquet(place)
    kids = totals.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("kids"))
    totals = totals.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    places = shared.select("key", "path").distinct()
    own = F.col("path") == F.col("owner")
    on_path = places.join(totals.select("key", "depth", "owner", "n_convs", "n_children", "bytes"), "key").select(
        "key", "path", "depth",
        F.when(own, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0).alias("more"),
        F.when(own & (F.col("n_children") == 0), 1).otherwise(0).alias("leaf"),
    )
    below = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = on_path.select("key", *(F.sum(c).over(below).alias(c) for c in ("more", "leaf")))
    sums = sums.groupBy("key").agg(F.sum("more").alias("more"), F.sum("leaf").alias("leaf"))
    return totals.join(sums, "key").select(
        "key", "parent", "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved") + F.col("more")).alias("saved_tokens"),
        "ends_sha256",
    )
