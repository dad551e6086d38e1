"""Packing: concatenate all documents' ids and cut them into fixed windows.

First pass: each task encodes its documents, counts ids as it goes, and writes
both. The tasks' totals, one row each, are summed up to give every task its
place in the whole; a document's place is its task's plus what stands before it
there. Second pass: every document is cut where its window ends. Documents that
reach over a window's end give several pieces, the boundary records. No ids are
shuffled, and only the last sequence is short.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm.common import give_back
from tillroll.llm.word_ids import ID_TYPE, encoded

LENGTH = 4096


def _cut(length, with_ids):
    def cut(batches):
        for batch in batches:
            give_back()
            names = ["start", "length", "ids_crc32", "sequence_id", "offset"]
            out = {name: [] for name in names}
            rows, ids = [], []
            columns = (batch["place"].to_pylist(), batch["ids"].to_pylist())
            for row, (place, coded) in enumerate(zip(*columns, strict=True)):
                wide = np.frombuffer(coded, dtype=ID_TYPE).astype("<u4").tobytes()
                at, end = 0, len(coded) // 2
                while at < end:
                    sequence, offset = divmod(place + at, length)
                    to = min(end, at + length - offset)
                    piece = wide[4 * at : 4 * to]
                    rows.append(row)
                    for name, value in zip(
                        names, (at, to - at, zlib.crc32(piece), sequence, offset), strict=True
                    ):
                        out[name].append(value)
                    if with_ids:
                        ids.append(np.frombuffer(piece, dtype="<i4"))
                    at = to
            rows = pa.array(rows, pa.int64())
            arrays = {"doc_id": batch["doc_id"].take(rows)}
            arrays |= {name: pa.array(values, pa.int64()) for name, values in out.items()}
            arrays["doc_tokens"] = batch["n_tokens"].take(rows)
            if with_ids:
                arrays["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(arrays)

    return cut


def pack(docs, doc_id="doc_id", text="text", length=LENGTH, with_ids=False, **tokenizer):
    """One row per piece: ``doc_id``, ``start`` (the document's ids before it), ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``, ``doc_tokens``, with ``ids`` on demand.

    Documents follow each other as the table is read; the order is fixed once
    the first pass is written. NULL texts are empty, a document of one end id;
    NULL ids are kept; repeated rows are packed as often as they stand; an empty
    table gives no piece. Very long documents are cut into as many pieces as
    they need. Other columns of ``docs`` are not read, so their names cannot clash.
    Sequences are padded by whoever reads them (:func:`sequences`).
    """
    coded = encoded(docs, doc_id, text, **tokenizer)
    totals = coded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    # One row of 16 bytes per task of the first pass, so bounded by the number
    # of tasks that one job can have.
    placed = coded.join(F.broadcast(before), "part").select(
        "doc_id", "n_tokens", "ids", (F.col("before") + F.col("part_start")).alias("place")
    )
    kind = placed.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, sequence_id long,"
        " offset long, doc_tokens long"
    )
    return placed.mapInArrow(
        _cut(length, with_ids), schema + (", ids array<int>" if with_ids else "")
    )


def sequences(pieces, length=LENGTH, pad_id=0):
    """Whole sequences out of pieces with ids: ``sequence_id``, ``n_tokens``, ``ids``.

    A sequence holds at most ``length`` ids, so its pieces are few. It is padded
    to ``length`` unless its size is a power of two.
    """
    put = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(put, lambda p: p["ids"])).alias("ids"),
        F.sum("length").alias("n_tokens"),
    )
    whole = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    missing = F.when(whole, F.lit(0)).otherwise(F.lit(length) - F.col("n_tokens")).cast("int")
    padding = F.array_repeat(F.lit(pad_id), missing)
    return rows.select("sequence_id", "n_tokens", F.concat("ids", padding).alias("ids"))
