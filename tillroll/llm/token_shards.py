"""Write token ids as wavelet-matrix shards in ascending id order, and read them."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm import wavelet
from tillroll.llm.word_ids import ID_TYPE, encoded
from tillroll.session import fresh_folder

SHARD_IDS = 1 << 20
DEPTH = 16  # bits of the largest id of the tokenizer file
_SCHEMA = "part long, part_start long, n_tokens long, shard binary"


def _build(shard_ids, depth):
    def shard(part, start, docs, sizes, parts):
        ids = np.frombuffer(b"".join(parts), dtype=ID_TYPE)
        blob = wavelet.build(ids, docs, np.cumsum(sizes), depth)
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int64()),
                "part_start": pa.array([start], pa.int64()),
                "n_tokens": pa.array([len(ids)], pa.int64()),
                "shard": pa.array([blob], pa.binary()),
            }
        )

    def build(batches):
        part, start = TaskContext.get().partitionId(), 0
        docs, sizes, parts, total = [], [], [], 0
        for batch in batches:
            for doc, coded in zip(
                batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True
            ):
                if total and total + len(coded) // 2 > shard_ids:
                    yield shard(part, start, docs, sizes, parts)
                    docs, sizes, parts, total, start = [], [], [], 0, start + total
                docs.append(doc)
                sizes.append(len(coded) // 2)
                parts.append(coded)
                total += sizes[-1]
        if docs:
            yield shard(part, start, docs, sizes, parts)

    return build


def write_shards(
    docs, folder, doc_id="doc_id", text="text", shard_ids=SHARD_IDS, depth=DEPTH, **tokenizer
):
    """Encode all documents and write one file per shard below ``folder``.

    Documents are range-partitioned and sorted by id, NULL ids first, rows of one
    id in any order; each task cuts its range into shards of at most ``shard_ids``
    ids at document ends (a longer document has a shard of its own). Each file is
    a Parquet file with one row: ``part`` (the range) and ``part_start`` (ids of the
    range before it), by which shards follow each other, ``n_tokens``, and the
    wavelet matrix. NULL texts are empty. An empty
    table writes no shard. Ids of documents must be integers.
    """
    coded = encoded(docs, doc_id, text, **tokenizer)
    total = coded.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // (4 * shard_ids)))
    order = [F.col("doc_id").asc_nulls_first()]
    (
        coded.select(F.col("doc_id").cast("long"), "ids")
        .repartitionByRange(int(parts), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_build(shard_ids, depth), _SCHEMA)
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .parquet(folder)
    )
    return folder


def read_shards(spark, folder):
    """The shards of a folder with ``before``: ids in all shards before each.

    Shards know their place in their range; the running sum over ranges brings
    together one short row per task that wrote them, never the shards.
    """
    shards = spark.read.schema(_SCHEMA).parquet(folder)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = totals.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("of_part")
    )
    # 16 bytes per task of one job.
    return shards.join(F.broadcast(parts), "part").withColumn(
        "before", F.col("of_part") + F.col("part_start")
    )


def _open(batches):
    for batch in batches:
        for before, blob in zip(
            batch["before"].to_pylist(), batch["shard"].to_pylist(), strict=True
        ):
            shard = wavelet.Shard(blob)
            ids = shard.decode().astype("<u4")
            starts = np.concatenate([[0], shard.ends[:-1]]).astype(np.int64)
            crc = [
                zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, shard.ends, strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(shard.doc_ids, mask=shard.has_id == 0),
                    "start": pa.array(starts + before),
                    "n_tokens": pa.array(shard.ends - starts),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )


def documents_of(shards):
    """Per document, out of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    return shards.select("before", "shard").mapInArrow(
        _open, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _count(token):
    def count(batches):
        for batch in batches:
            found = [wavelet.Shard(b).count(token) for b in batch["shard"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": batch["part"],
                    "part_start": batch["part_start"],
                    "n": pa.array(found, pa.int64()),
                }
            )

    return count


def token_counts(shards, token):
    """Per shard, how often a token occurs: rank alone, nothing is decoded."""
    return shards.select("part", "part_start", "shard").mapInArrow(
        _count(token), "part long, part_start long, n long"
    )


def write_and_read(docs, **options):
    """Shards in a fresh folder, read back as documents."""
    spark = docs.sparkSession
    folder = write_shards(docs, fresh_folder(spark, "token-shards"), **options)
    return documents_of(read_shards(spark, folder))
