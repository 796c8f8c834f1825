"""Language identification by compression: the language whose dictionary compresses a text best.

Dictionaries and texts are in lower case, so that capitals don't hide what a dictionary knows. A text is compressed
whole, in pieces of a fixed size: within one long stream it soon serves as its own dictionary, and languages come out alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import hand_back, table

#: Bounds of the fit: texts of a language, and bytes of its dictionary.
SAMPLE, DICTIONARY = 96, 112 << 10
LEVEL = 6
#: Bytes of a text that are compressed together.
PIECE = 64 << 10
#: A text is rejected if its best size is not this share smaller than the second best.
MARGIN = 0.003
#: Margin at which the score is 1 - 0.5 / e.
SCALE = 0.01
UNKNOWN = "und"
OUTPUTS = ("lang_pred", "score", "rejected")


def fit(docs: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A raw-content dictionary for each value of ``lang``, from at most ``sample`` of its labelled texts.

    Texts are chosen by a hash of their key, so the choice doesn't depend on partitioning. Only the chosen texts, a
    bounded number, reach the driver.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    chosen = labelled.select(key, lang).withColumn("__gl_rank", F.row_number().over(order)).where(F.col("__gl_rank") <= sample)
    last = F.right(F.col(text), F.lit(DICTIONARY)).alias(text)  # all that a dictionary can use of a text
    rows = labelled.select(key, lang, last).join(F.broadcast(chosen.select(key, lang).distinct()), [key, lang], "left_semi").collect()
    found: dict[str, list] = {}
    for k, name, body in rows:
        found.setdefault(name, []).append((k, body))
    return {name: "\n".join(body.lower() for _, body in sorted(bodies)).encode()[-DICTIONARY:] for name, bodies in sorted(found.items())}


def classify(dictionaries: dict[str, bytes], text: str):
    names = list(dictionaries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = []
        for name in names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        for batch in batches:
            at = batch.schema.get_field_index(text)
            best, score, rejected = [], [], []
            for t in batch.column(at).to_pylist():
                if t is None or not coders or not any(map(str.isalpha, t)):
                    best.append(UNKNOWN)
                    score.append(0.0)
                    rejected.append(True)
                    continue
                raw = t.lower().encode()
                pieces = [raw[k : k + PIECE] for k in range(0, len(raw), PIECE)]
                sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in coders])
                order = np.argsort(sizes, kind="stable")
                margin = 1 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0
                best.append(names[order[0]])
                score.append(float(1 - 0.5 * np.exp(-margin / SCALE)))
                rejected.append(bool(margin < MARGIN))
            for name, values, kind in zip(OUTPUTS, (best, score, rejected), (pa.string(), pa.float64(), pa.bool_()), strict=True):
                batch = batch.append_column(name, pa.array(values, kind))
            yield batch
        hand_back()

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, from the margin to the second best) and ``rejected``.

    Text that is null or has no letter is ``und`` with score 0 and rejected, and so is all text if nothing was
    learned. Equal sizes go to the language first in alphabetical order, and are rejected. Each row is judged alone, so
    repeated rows get equal results; columns named as an output are replaced, others kept. An empty table gives an empty
    result.
    """
    docs = docs.drop(*OUTPUTS)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(classify(dictionaries, text), schema)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), learned).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op2_language_id": op2_language_id}
ORACLES: dict[str, str] = {}
