"""Chunks of documents that ask all other chunks one question, in packed form.

Documents are dealt to chunks by hash. Each chunk sends the distinct keys
it wonders about, as sorted binary blobs, one for each hash bucket; whoever
owns a bucket answers with one blob for each blob it got. A key that a third of
all documents hold is thus sent once per chunk, not once per occurrence, and
the text itself crosses the network once: the exchange that deals it is reused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

#: Text bytes in a chunk, up to 1 GB of text and at most.
CHUNK_BYTES = (2 << 20, 16 << 20)


def chunk_count(docs: DataFrame, text: str) -> int:
    """Chunks grow with the square root of the text, so that the number of blobs
    (chunks x buckets) grows with the text and not with its square."""
    size = text_bytes(docs, text)
    chunk = min(CHUNK_BYTES[1], CHUNK_BYTES[0] * max(1.0, (size / (1 << 30)) ** 0.5))
    return min(1 << 30, max(8, int(size / chunk)))


def dealt(docs: DataFrame, chunks: int, doc_id: str, text: str) -> DataFrame:
    """chunk, doc_id, text: rows dealt by id and text, so that neither a null
    nor a repeated id fills one chunk."""
    chunk = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(chunks)).cast("int")
    return docs.select(chunk.alias("chunk"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def asked(rows: DataFrame, ask: Callable) -> DataFrame:
    """chunk, bucket, blob of all chunks."""
    return rows.groupBy("chunk").applyInArrow(ask, "chunk int, bucket int, blob binary")


def answered(questions: DataFrame, answer: Callable) -> DataFrame:
    """chunk, bucket, blob: the answers in the form of the questions."""
    return questions.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, blob binary")
