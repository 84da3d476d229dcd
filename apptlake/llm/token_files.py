"""Operator 3: token ids in binary files, each document compressed by itself.

A shared zstandard dictionary is trained on the serialized ids of a bounded sample of documents.
Every document's ids become one frame compressed with it. Frames of neighbouring documents, in
ascending order of ids, lie behind one another in a block; the block's row holds the dictionary's
hash and an index of frame offsets, so that a short document is read without its neighbours.

A folder has three tables: ``dictionary`` (one row: the dictionary, its SHA-256, the width of an
id in bytes), ``blocks`` (payload and index) and ``starts`` (ids before each block). Spark writes
them, so any store will do, and a lost task is written anew.

Ids are those of the tokenizers library. tiktoken makes them from the same vocabulary, several
times faster; texts with characters that Unicode tables may disagree on go to the library itself.

Defined results: a null or empty text is the end id alone; rows with equal ids keep one order
(by text) and each has its place; rows without an id come first; an empty table gives empty tables
and an empty dictionary. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apptlake.llm.bpe import byte_symbols
from apptlake.llm.common import slices, text_of

#: The dictionary is trained on so many documents, a stretch of at most so many characters of each,
#: and has so many bytes.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 16_000, 64 << 10
#: A block ends with the document that brings it to one of these.
BLOCK_DOCUMENTS, BLOCK_BYTES = 1024, 1 << 20

_INDEX = pa.list_(
    pa.struct(
        [("doc_id", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("n_tokens", pa.int64())]
    )
)
_INDEX_DDL = "array<struct<doc_id:bigint,offset:bigint,size:bigint,n_tokens:bigint>>"


class TextEncoder:
    """Ids of texts by a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        value = {symbol: b for b, symbol in enumerate(byte_symbols())}
        ranks = {bytes(map(value.__getitem__, t)): k for t, k in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.width = 2 if max([*ranks.values(), *special.values()]) < 1 << 16 else 4
        self.library = tokenizers.Tokenizer.from_str(file_text)
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens=special,
        )

    def encode(self, text: str) -> list[int]:
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.library.encode(text, add_special_tokens=False).ids
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:  # its pattern gives up on very long runs, such as a million blanks
            return self.library.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _encoder(file_text: str) -> TextEncoder:
    return TextEncoder(file_text)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for frames; empty if the samples are too few to train one."""
    if sum(map(len, samples)) < 4 * size or len(samples) < 16:
        size = sum(map(len, samples)) // 8
    if size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:  # samples without anything in common
        return b""


def _compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def _sample(rows: DataFrame, file_text: str, end_id: int) -> list[bytes]:
    """Serialized ids of a bounded sample: the documents whose ids hash lowest, of a long one a
    stretch at a place that the hash says."""
    chosen = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    places = F.greatest(F.length("_text") - SAMPLE_CHARS, F.lit(0)) + 1
    stretch = F.substring("_text", F.pmod(F.xxhash64("doc_id"), places).cast("int") + 1, F.lit(SAMPLE_CHARS))
    texts = (
        rows.join(F.broadcast(chosen.distinct()), "doc_id")
        .select("doc_id", stretch.alias("_text"))
        .orderBy(F.xxhash64("doc_id"), "_text")
        .limit(SAMPLE_DOCUMENTS)
        .collect()
    )
    encoder = _encoder(file_text)
    return [
        np.array([*encoder.encode(row["_text"]), end_id], dtype=f"<u{encoder.width}").tobytes()
        for row in texts
    ]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode all documents, end each with ``end_id`` and write them below ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        file_text = file.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("_text"))
    dictionary = train_dictionary(_sample(rows, file_text, end_id))
    digest, width = hashlib.sha256(dictionary).hexdigest(), _encoder(file_text).width
    spark.createDataFrame(
        [(digest, bytearray(dictionary), width)], "hash string, dictionary binary, width int"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((file_text, dictionary))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_text, dictionary = shared.value
        encoder = _encoder(file_text)
        compress = zstandard.ZstdCompressor(level=3, **_compression(dictionary)).compress
        part, number = TaskContext.get().partitionId(), 0
        frames: list[bytes] = []
        index: list[dict] = []
        offset = tokens = 0

        def block() -> pa.RecordBatch:
            columns = [[part], [number], [digest], [tokens], [index], [b"".join(frames)]]
            names = ["part", "number", "dictionary_hash", "n_tokens", "index", "payload"]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), _INDEX, pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for piece in slices(batch, "_text"):
                keys, texts = piece.column("doc_id").to_pylist(), piece.column("_text").to_pylist()
                for key, text in zip(keys, texts, strict=True):
                    ids = [*encoder.encode(text), end_id]
                    frame = compress(np.array(ids, dtype=f"<u{width}").tobytes())
                    index.append(
                        {"doc_id": key, "offset": offset, "size": len(frame), "n_tokens": len(ids)}
                    )
                    frames.append(frame)
                    offset, tokens = offset + len(frame), tokens + len(ids)
                    if len(index) >= BLOCK_DOCUMENTS or offset >= BLOCK_BYTES:
                        yield block()
                        frames, index, offset, tokens, number = [], [], 0, 0, number + 1
        if index:
            yield block()

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_text")
    ordered.mapInArrow(
        pack,
        "part int, number int, dictionary_hash string, n_tokens bigint, "
        f"index {_INDEX_DDL}, payload binary",
    ).write.mode("overwrite").parquet(f"{path}/blocks")

    blocks = spark.read.parquet(f"{path}/blocks").select("part", "number", "n_tokens")
    # One row per writing task meets the others; blocks only meet those of their task.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_all"))
    up_to = F.sum("_all").over(Window.orderBy("part"))
    before = parts.select("part", (up_to - F.col("_all")).alias("_before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("number"))
    blocks.withColumn("_within", within - F.col("n_tokens")).join(before, "part").select(
        "part", "number", (F.col("_before") + F.col("_within")).alias("start")
    ).write.mode("overwrite").parquet(f"{path}/starts")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["hash"]:
        raise ValueError(f"the dictionary in {path} does not match its hash")
    return row["hash"], dictionary, row["width"]


def read_token_files(
    spark: SparkSession, path: str, only: list[int] | None = None
) -> DataFrame:
    """Read documents back: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids`` (little-endian unsigned 32-bit integers in a row).

    ``only`` reads some documents: blocks without them are skipped by their index, and of the
    others just the frames asked for are decompressed.
    """
    digest, dictionary, width = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(dictionary)
    wanted = None if only is None else frozenset(only)
    blocks = spark.read.parquet(f"{path}/blocks")
    if wanted is not None:
        blocks = blocks.where(F.exists("index", lambda x: x["doc_id"].isin(*wanted)))
    blocks = blocks.join(spark.read.parquet(f"{path}/starts"), ["part", "number"]).select(
        "dictionary_hash", "index", "payload", "start"
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(**_compression(shared.value)).decompress
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                if row.column("dictionary_hash")[0].as_py() != digest:
                    raise ValueError("a block was compressed with another dictionary")
                payload = memoryview(row.column("payload")[0].as_buffer())
                start, rows = row.column("start")[0].as_py(), []
                for x in row.column("index")[0].as_py():
                    if wanted is None or x["doc_id"] in wanted:
                        raw = decompress(payload[x["offset"] : x["offset"] + x["size"]])
                        ids = np.frombuffer(raw, dtype=f"<u{width}").astype("<u4").tobytes()
                        rows.append((x["doc_id"], start, x["n_tokens"], ids))
                    start += x["n_tokens"]
                columns = zip(*rows, strict=True) if rows else ([], [], [], [])
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(unpack, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
