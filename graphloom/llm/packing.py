"""Sum-of-squares online packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import word_bpe
from graphloom.llm.common import bytes_of, hand_back, table

LENGTH, END = 4096, 2
TOKENIZER = "word_bpe_49k.json"
#: Documents that one packer serves; more make for less padding, and each is a few bytes.
SERVED = 16384


def _pieces(vocabulary: Broadcast, table: Broadcast, key: str, text: str, length: int, packers: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            texts = (t for at in range(0, batch.num_rows, 64) for t in bytes_of(batch.column(text).slice(at, 64)))
            ids = word_bpe.text_ids(texts, table.value, lambda: vocabulary.value)
            for i, own in zip(batch.column(key).to_pylist(), ids, strict=True):
                raw = own.tobytes() + end
                packer = xxhash.xxh64_intdigest(b"%d:%d" % (-1 if i is None else i, zlib.crc32(raw))) % packers
                for start in range(0, len(raw) // 4, length):
                    own = raw[4 * start : 4 * (start + length)]
                    for values, v in zip(out, (i, start, len(own) // 4, zlib.crc32(own), len(raw) // 4, packer), strict=True):
                        values.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], [key, "start", "length", "ids_crc32", "doc_tokens", "packer"])
        hand_back()

    return run


def sum_of_squares(sizes: list[int], length: int) -> tuple[list[int], list[int]]:
    """Window and offset of each item, in order, where each goes to the fill level that keeps the sum of the squared
    numbers of partially filled windows least; among equals, to the fullest.

    ``count[h]`` is the number of windows filled to h. Moving one from h to h + s changes the sum by
    2 (count[h + s] - count[h] + 1), filling one up by 1 - 2 count[h], opening one by 2 count[s] + 1.
    """
    count = np.zeros(length + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    windows, offsets, opened = [], [], 0
    for s in sizes:
        levels = np.flatnonzero(count[: length - s + 1])
        change = 2 * (count[levels + s] - count[levels] + 1)
        change[levels == length - s] -= 1  # a full window is counted no longer
        best = len(levels) - 1 - int(np.argmin(change[::-1])) if len(levels) else -1
        if best >= 0 and (s == length or change[best] < 2 * count[s] + 1):
            h = int(levels[best])
            window = stacks[h].pop()
            count[h] -= 1
        else:
            h, window, opened = 0, opened, opened + 1
        windows.append(window)
        offsets.append(h)
        if h + s < length:
            count[h + s] += 1
            stacks.setdefault(h + s, []).append(window)
    return windows, offsets


def _pack(key: str, length: int, packers: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in (key, "start", "ids_crc32", "length", "doc_tokens")])
        windows, offsets = sum_of_squares(group.column("length").to_pylist(), length)
        ids = np.array(windows, np.int64) * packers + group.column("packer")[0].as_py()
        return group.drop_columns(["packer"]).append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document's ids end with the end token; all of its full windows and the rest are its pieces. Packers are dealt
    documents by a hash, and each packs its pieces in the order of key and start, so the result doesn't depend on
    partitioning. Null text counts as empty, and is a piece of one id; a null key is kept; repeated rows are packed each.
    Keys are whole numbers; one that cannot be cast to a long raises an error. Other columns than key and text are left
    out. ``tokenizer`` is the path of the vocabulary, read by the driver. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    packers = max(1, round(docs.count() / SERVED))
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = f.read()
    parts = [spark.sparkContext.broadcast(v) for v in (vocabulary, word_bpe.merges(vocabulary))]
    fields = f"{key} long, start long, length long, ids_crc32 long, doc_tokens long"
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("__gl_text"))
    pieces = rows.mapInArrow(_pieces(*parts, key, "__gl_text", length, packers), f"{fields}, packer long")
    return pieces.groupBy("packer").applyInArrow(_pack(key, length, packers), f"{fields}, sequence_id long, offset long")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {"op4_packing": op4_packing}
ORACLES: dict[str, str] = {}
