"""Token-id files with one zstandard frame per document.

Layout under a folder::

    dictionary/   one Parquet row: sha256 and the shared zstandard dictionary
    data/         part-NNNNN files, in ascending document order

A data file is a header line (JSON: format, id width, end id, dictionary
hash), one frame per document, an index block and a footer.  Every part is
followed by one line feed, because Spark's own text writer and committer
write the files: they reach any store that Spark reaches, and a lost
executor's attempt leaves nothing behind.  The index holds document id,
offset, length and token count, so one short document is read by decoding
one frame.  The dictionary is trained on the serialized ids of at most
``SAMPLE_DOCS`` documents.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.units import UnitCache, encoder
from strata.llm.worker import give_back, kept
from strata.session import materialize, ship, small_batches

OPERATOR = "token_files"
FORMAT = "token-frames-1"
FOOTER = "<QQ8s"
MAGIC = b"TOKFRAME"
SAMPLE_DOCS = 1_500
SAMPLE_CHARS = 8_000
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 32 << 20      # text bytes a file; files are read whole
LEVEL = 3


def _ids_of(spec: str, key: str, end_id: int):
    """text -> serialized ids with the end id, and the id width."""
    enc = encoder(OPERATOR, spec, key)
    dtype = "<u2" if max(enc.lib.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    pack = lambda ids: array("H" if dtype == "<u2" else "I", ids).tobytes()   # noqa: E731  little-endian machines
    cache, end = kept(OPERATOR, ("ids", key), lambda: UnitCache(enc, pack, lambda a, b: a + b)), pack([end_id])

    def ids(text: str | None) -> bytes:
        if not text:
            return end
        if enc.kind == "whole":
            return pack(enc.encode(text)) + end
        return b"".join([b"".join(map(cache.__getitem__, enc.units(p))) for p in enc.segments(text)]) + end

    return ids, dtype


def train_dictionary(df: DataFrame, spec: str, key: str, end_id: int) -> bytes:
    """A dictionary from at most SAMPLE_DOCS short documents; empty if there
    are too few to train on (frames are then plain zstandard)."""
    ids, _ = _ids_of(spec, key, end_id)
    sample = df.where(F.length("text").between(1, SAMPLE_CHARS)).select("text").limit(SAMPLE_DOCS).collect()
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [ids(r.text) for r in sample]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_token_files(df: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 1, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write the files under ``path``.

    Documents are in ascending id order; null ids come first, equal ids in
    the order of their texts' hash.  Null and empty texts hold the end id
    alone.  Other columns are not read.  An empty table writes files with
    no documents.
    """
    spark = df.sparkSession
    ship(spark)
    spec = Path(tokenizer_path).read_text()
    key = hashlib.sha256(spec.encode()).hexdigest() + f"/{end_id}"
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dictionary = train_dictionary(docs, spec, key, end_id)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "sha256 string, bytes binary") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((spec, dictionary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        spec, dictionary = shared.value
        ids, dtype = _ids_of(spec, key, end_id)
        width = int(dtype[2:])
        zdict = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zdict)
        head = json.dumps({"format": FORMAT, "ids": dtype, "end_id": end_id,
                           "dictionary_sha256": hashlib.sha256(dictionary).hexdigest()}).encode()
        yield pa.record_batch([pa.array([head], pa.binary())], ["content"])
        at, index = len(head) + 1, []
        for b in batches:
            frames, held = [], 0
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = ids(text.as_py())
                frame = pack.compress(raw)
                index.append((0 if doc is None else doc, doc is None, at, len(frame), len(raw) // width))
                at += len(frame) + 1
                frames.append(frame)
                held += len(frame)
                if held > 4 << 20:
                    yield pa.record_batch([pa.array(frames, pa.binary())], ["content"])
                    frames, held = [], 0
            if frames:
                yield pa.record_batch([pa.array(frames, pa.binary())], ["content"])
            give_back()
        block = np.array(index, INDEX).tobytes()
        yield pa.record_batch([pa.array([block, struct.pack(FOOTER, at, len(block), MAGIC)], pa.binary())], ["content"])

    order = ["doc_id", F.xxhash64("text")]
    shards = max(1, -(-size // shard_bytes))
    with small_batches(spark):
        (docs.repartitionByRange(shards, *order).sortWithinPartitions(*order)
         .mapInArrow(encode, "content binary").select(F.col("content").cast("string").alias("value"))
         .write.mode("overwrite").text(f"{path}/data"))


INDEX = np.dtype([("doc", "<i8"), ("null", "?"), ("at", "<i8"), ("length", "<i8"), ("n", "<i8")])


def read_index(content) -> tuple[dict, np.ndarray]:
    """Header and offset index of one file's bytes."""
    view = memoryview(content)
    at, length, magic = struct.unpack(FOOTER, view[-struct.calcsize(FOOTER) - 1:-1])
    if magic != MAGIC:
        raise ValueError("not a token file")
    head = json.loads(bytes(view[:min(len(view), 4096)]).split(b"\n", 1)[0])
    return head, np.frombuffer(view[at:at + length], INDEX)


def decoder(head: dict, dictionary: bytes):
    """frame -> array of ids; refuses another dictionary than the file's."""
    import zstandard

    if hashlib.sha256(dictionary).hexdigest() != head["dictionary_sha256"]:
        raise ValueError("the file was written with another dictionary")
    z = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return lambda frame: np.frombuffer(z.decompress(frame), head["ids"])


def read_document(content, dictionary: bytes, doc_id: int) -> np.ndarray | None:
    """Ids of one document of a file, by the offset index: one frame is decoded."""
    head, index = read_index(content)
    found = np.flatnonzero((index["doc"] == doc_id) & ~index["null"])
    if not len(found):
        return None
    at, length = int(index["at"][found[0]]), int(index["length"][found[0]])
    return decoder(head, dictionary)(bytes(memoryview(content)[at:at + length]))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    ``start`` counts the ids of all documents before it: the running sum
    inside a file plus the totals of the files before (one row per file).
    """
    ship(spark)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().bytes)
    shared = spark.sparkContext.broadcast(dictionary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                content = content.as_buffer()
                head, index = read_index(content)
                decode, view = decoder(head, shared.value), memoryview(content)
                n = index["n"].astype("i8")
                crc = np.empty(len(index), "i8")
                for i, (at, length) in enumerate(zip(index["at"].tolist(), index["length"].tolist())):
                    ids = decode(view[at:at + length])
                    if len(ids) != n[i]:
                        raise ValueError(f"{name}: frame {i} has {len(ids)} ids, the index says {n[i]}")
                    crc[i] = zlib.crc32(ids.astype("<u4"))
                yield pa.record_batch([pa.array(np.full(len(index), int(name))), pa.array(index["doc"], mask=index["null"]),
                                       pa.array(np.cumsum(n) - n), pa.array(n), pa.array(crc)],
                                      ["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    files = (spark.read.format("binaryFile").load(f"{path}/data")
             .select(F.regexp_extract("path", r"part-(\d+)", 1).alias("name"), "content"))
    rows = materialize(files.mapInArrow(read, "shard long, doc_id long, local_start long, n_tokens long, ids_crc32 long"),
                       "token-index")
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", (F.sum("total").over(W.orderBy("shard")) - F.col("total")).alias("before"))
    return (rows.join(before, "shard")
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))
