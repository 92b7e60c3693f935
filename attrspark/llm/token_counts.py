"""Token counts of whole texts through a cache of digests.

The cache is a table of (tokenizer, content, n_tokens) in a shared folder, one directory per
tokenizer digest. A text is looked up by the SHA-256 of its normalised content; only distinct
texts that the cache lacks are encoded, and their counts are appended to it.

Normalised content is the text in UTF-8 with null as empty: both libraries count tokens of the
text as it is, so that no other change of a text is certain to leave its count alone.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.llm.hot import with_value
from attrspark.session import scratch_path

CACHE = "content binary, n_tokens long, tokenizer string"
#: Texts are handed to a library in batches of about so many characters.
BATCH_CHARACTERS = 1 << 20

_counters: dict[str, Callable[[list[str]], list[int]]] = {}


def tokenizer_digest(path: str) -> str:
    """SHA-256 of a tokenizer file and of the library and version that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read())
    content.update(f"{library} {importlib.metadata.version(library)}".encode())
    return content.hexdigest()


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Numbers of tokens of whole texts, without added tokens; loaded once per worker."""
    if path not in _counters:
        _counters[path] = _pieces(path) if path.endswith(".model") else _tokenizer(path)
    return _counters[path]


def _tokenizer(path: str) -> Callable[[list[str]], list[int]]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _pieces(path: str) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if not _words_apart(model):
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]

    def counts(texts: list[str]) -> list[int]:
        parts = [_parts(t) for t in texts]
        found = iter(model.encode([p for each in parts for p in each], num_threads=1))
        return [sum(len(next(found)) for _ in each) for each in parts]

    return counts


def _words_apart(model) -> bool:
    """Whether a text may be cut at a single space: the model keeps texts as they are, begins
    each with a space of its own, and has no piece with a space after another character."""
    mark = "▁"
    if model.normalize("a  ﬁ") != f"{mark}a{mark}{mark}ﬁ":
        return False
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return not any(mark in p.lstrip(mark) for p in pieces)


def _parts(text: str, size: int = BATCH_CHARACTERS) -> list[str]:
    """A very long text in parts: cut at single spaces, each of which the next part's own
    leading space replaces. A stretch without such a space stays whole."""
    parts, first = [], 0
    while len(text) - first > size:
        at = text.find(" ", first + size)
        while at >= 0 and (text[at - 1] in " ▁" or text[at + 1 : at + 2] in ("", " ", "▁")):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        parts.append(text[first:at])
        first = at + 1
    parts.append(text[first:])
    return parts


def _encode(path: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            counts: list[int] = []
            held, size = [], 0
            for text in texts:
                held.append(text.as_py())
                size += len(held[-1])
                if size > BATCH_CHARACTERS:
                    counts += count(held)
                    held, size = [], 0
            counts += count(held) if held else []
            yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    return encode


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(content, n_tokens) that the cache has for a tokenizer; a count that two runs added at
    the same time comes once. No such folder: no rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    if not exists:
        return spark.createDataFrame([], "content binary, n_tokens long")
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, cache: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs(doc_id, text)`.

    `path` is a tokenizer file (.json or .model) that every worker can open, `cache` a folder
    that all share; without one, the cache serves this call alone. The first reading of the
    texts keeps digests only. Texts to encode are one document per distinct missing content;
    they alone meet the list of misses, which Spark broadcasts if it is small, as when most
    contents are known.

    Null text: empty, 0 tokens. Null or repeated doc_id: one row each. Repeated rows and copies
    are encoded once (a row repeated with its id once per task that reads it). A very long text
    is counted in parts where that cannot change the count. Empty table: no rows. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(F.col("doc_id"), text.alias("text")).withColumn("content", F.unhex(F.sha2("text", 256)))
    seen, sizes = scratch_path(spark, "contents"), scratch_path(spark, "content-sizes")
    whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content").write.parquet(seen)
    rows = spark.read.parquet(seen)
    rows.groupBy("content").agg(F.count("*").alias("n"), F.min("doc_id").alias("one")).write.parquet(sizes)
    groups = spark.read.parquet(sizes)
    cache = cache or scratch_path(spark, "token-counts")
    misses = groups.join(cached(spark, cache, version), "content", "left_anti")
    wanted = misses.select(F.col("content").alias("__content"), F.col("one").alias("__one"))
    here = (F.col("content") == F.col("__content")) & F.col("doc_id").eqNullSafe(F.col("__one"))
    chosen = whole.join(wanted, here, "left_semi").select("content", "text")
    counted = chosen.mapInArrow(_encode(path), "content binary, n_tokens long")
    counted.withColumn("tokenizer", F.lit(version)).write.partitionBy("tokenizer").mode("append").parquet(cache)
    known = groups.select("content", "n").join(cached(spark, cache, version), "content")
    result = with_value(rows, known, "content", rows.count())
    return result.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
