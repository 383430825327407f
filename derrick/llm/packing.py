"""Concatenate and cut: token sequences of a fixed length without padding inside.

Pass 1 encodes every document in its input partition and writes the ids with the
tokens before them in that partition. The partitions' totals (one number each)
are summed up in partition order; a document's global offset is its partition's
base plus its own. Pass 2 cuts the ids at the multiples of the sequence length:
every boundary inside a document starts a new piece (the boundary record), and
sequence_id and offset are quotient and remainder of the global offset.

Only the last sequence can be short; it is padded to the full length unless its
own length is a power of two (``padded_tokens``).

Defined results: null text is an empty document (only the end id); rows that
repeat an id are documents of their own; null ids stay null; an empty table gives
an empty result; other columns are ignored. Nothing is shuffled.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.llm.encode import blocks, encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEQUENCE = 2048


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(part, before, doc_id, n, z): ids of every document as a zstandard frame."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        own = encoder(tokenizer)
        comp = zstandard.ZstdCompressor(level=1)
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for a, e in blocks(texts):
                got = [x + end for x in own.ids(texts[a:e])]
                n = np.array([len(x) // 4 for x in got], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(before + np.cumsum(n) - n),
                     ids.slice(a, e - a), pa.array(n), pa.array([comp.compress(x) for x in got], pa.binary())],
                    names=["part", "before", "doc_id", "n", "z"])
                before += int(n.sum())
    return common.documents(docs).select("doc_id", "text").mapInArrow(
        run, "part int, before long, doc_id long, n long, z binary")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, padded_tokens (the sequence's length with padding), ids (little-endian
    unsigned 32-bit)."""
    table = common.shared_table(encoded(docs, tokenizer, end_id))
    base, total = {}, 0
    for r in table.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        base[r["part"]] = total
        total += r["n"]
    rest = total % sequence
    last = total // sequence if rest and rest & (rest - 1) == 0 else -1

    def run(batches):
        dec = zstandard.ZstdDecompressor()
        for b in batches:
            part = np.array([base[p] for p in b.column("part").to_pylist()], np.int64)
            begin = part + b.column("before").to_numpy()
            n = b.column("n").to_numpy()
            first = begin // sequence
            count = (begin + n - 1) // sequence - first + 1
            row = np.repeat(np.arange(len(n)), count)
            seq = first[row] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            a = np.maximum(seq * sequence, begin[row])
            e = np.minimum((seq + 1) * sequence, begin[row] + n[row])
            z = b.column("z").to_pylist()
            ids, held, at = [], -1, b""
            for r, x, y in zip(row.tolist(), (a - begin[row]).tolist(), (e - begin[row]).tolist()):
                if r != held:
                    held, at = r, dec.decompress(z[r])
                ids.append(at[4 * x:4 * y])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(a - begin[row]), pa.array(e - a),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(n[row]), pa.array(seq),
                 pa.array(a - seq * sequence),
                 pa.array(np.where(seq == last, rest, sequence).astype(np.int64)), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                       "padded_tokens", "ids"])
    return table.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                            "sequence_id long, offset long, padded_tokens long, ids binary")
