"""Token-id files: every document compressed on its own with a shared dictionary.

The file format is a Parquet folder with two tables, so Spark's committers write
it to any store and a lost executor costs a task retry:

* ``dictionary``: one row (dict_hash, dictionary): a zstandard dictionary trained
  on serialized id arrays of a bounded sample (``SAMPLE`` documents of smallest
  hash, ``SAMPLE_CHARS`` characters of each; only the dictionary depends on it).
* ``shards``: rows of up to ``SHARD_IDS`` ids in ascending doc_id order: blob (the
  frames joined), frame_ends, doc_ids and doc_tokens as offset index, the hash of
  the dictionary, id width, and the place in the order (part, shard, ids before
  it in the part).

A document is read by cutting its frame out of the blob; the others stay packed.
``start`` positions are a two-pass prefix sum: ids before a shard in its part
(known to the writer) plus the totals of the parts before it.

Defined results: null text is an empty document (only the end id); rows that
repeat an id are documents of their own, in the order of their text hash; null
ids come first; an empty table gives files without rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.llm.encode import blocks, encoder
from derrick.session import ensure_checkpoint_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SAMPLE = 512
SAMPLE_CHARS = 20_000
DICTIONARY = 1 << 16
SHARD_IDS = 1 << 20

_SHARD = ("part int, shard int, before long, n_ids long, width int, dict_hash string, "
          "doc_ids array<long>, doc_tokens array<long>, frame_ends array<long>, blob binary")


def serialize(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def deserialize(raw: bytes, width: int) -> bytes:
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def train_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """Dictionary bytes; the samples themselves where there are too few to train."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encode all documents and write the files under ``path``."""
    spark = docs.sparkSession
    d = common.documents(docs)
    hashed = d.where("text is not null").withColumn("o", F.xxhash64("doc_id", "_th"))
    sample = [r[0] for r in common.smallest(hashed, "o", SAMPLE).select(
        F.substring("text", 1, SAMPLE_CHARS)).collect()]
    enc = encoder(tokenizer)
    width = 2 if max(enc.size, end_id + 1) <= 1 << 16 else 4
    end = end_id.to_bytes(4, "little")
    data = train_dictionary([serialize(x + end, width) for x in enc.ids(sample)])
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(digest, bytearray(data))], "dict_hash string, dictionary binary").coalesce(1) \
        .write.parquet(f"{path}/dictionary")

    def run(batches):
        own = encoder(tokenizer)
        comp = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(data))
        part = TaskContext.get().partitionId()
        shard, before, held, n = 0, 0, [], 0
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for a, e in blocks(texts):
                for i, x in zip(ids[a:e], own.ids(texts[a:e])):
                    raw = serialize(x + end, width)
                    held.append((i, len(raw) // width, comp.compress(raw)))
                    n += held[-1][1]
                    if n >= SHARD_IDS:
                        yield pack(part, shard, before, n, held)
                        shard, before, held, n = shard + 1, before + n, [], 0
        if held:
            yield pack(part, shard, before, n, held)

    def pack(part, shard, before, n, held):
        ends = np.cumsum([len(h[2]) for h in held]).tolist()
        row = [part, shard, before, n, width, digest, [h[0] for h in held], [h[1] for h in held],
               ends, b"".join(h[2] for h in held)]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                          names=[c.split()[0] for c in _SHARD.split(", ")])

    ordered = d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_th")
    ordered.select("doc_id", "text").mapInArrow(run, _SHARD).write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of the files; ids
    are little-endian unsigned 32-bit integers."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    data, digest = bytes(row["dictionary"]), row["dict_hash"]
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"damaged dictionary in {path}")
    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards")
    # one number per part of the range partitioning
    base, at = {}, 0
    for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        base[r["part"]] = at
        at += r["n"]

    def run(batches):
        dec = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for b in batches:
            for r in b.to_pylist():
                if r["dict_hash"] != digest:
                    raise ValueError("shard written with another dictionary")
                ids, a, out = r["doc_ids"], 0, []
                for e in r["frame_ends"]:
                    out.append(deserialize(dec.decompress(r["blob"][a:e]), r["width"]))
                    a = e
                n = np.array([len(x) // 4 for x in out], np.int64)
                start = base[r["part"]] + r["before"] + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(start), pa.array(n),
                     pa.array([zlib.crc32(x) for x in out], pa.int64()), pa.array(out, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    path = f"{ensure_checkpoint_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
