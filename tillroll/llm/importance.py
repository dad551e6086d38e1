"""Target-distribution importance resampling over hashed word runs.

Texts are seen as bags of hashed features: every run of up to ``most`` consecutive words,
by the CRC-32 of its bytes modulo the number of buckets. A bucket's gain is how much
likelier the target texts are to show it than all documents; a document's weight is
the sum of its features' gains, and with Gumbel noise from its id on top, the
highest scores are a draw without replacement in proportion to the weights.

The checksums of a batch's distinct features are taken together: features of equal
length stand as the rows of one byte matrix, and all their checksums are moved on by
one column at a time; then they are scattered back to the features' places.

Passes: texts are read once and their buckets written; the counts of all documents are
sums over that table, one row per task and bucket; gains are as many numbers as there are
buckets, whatever the size of the tables. The draw is a range partitioning by score,
written, with the partitions' sizes summed up to give every row its rank; no
task sorts all rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm.common import flat_table, id_and_text, written

BUCKETS = 10000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
POLYNOMIAL = 0xEDB88320  # CRC-32, reflected
# Bytes that are in words; all others part them.
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True
AS_WORDS = bytes(b if IN_WORD[b] else 32 for b in range(256))


def _steps():
    """What one byte does to a checksum, for each byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(POLYNOMIAL), steps >> 1)
    return steps


STEPS = _steps()


def checksums(strings):
    """CRC-32 of byte strings, by matrices of equal length."""
    flat, offsets, lengths = flat_table(strings)
    found = np.zeros(len(strings), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        width = int(lengths[rows[0]])
        matrix = flat[offsets[rows][:, None] + np.arange(width)]
        state = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
        for column in range(width):
            state = STEPS[(state ^ matrix[:, column]) & 255] ^ (state >> 8)
        found[rows] = ~state
    return found


def features(texts, most=1, buckets=BUCKETS):
    """The buckets of all features of an Arrow text column, text after text, and
    how many features and words each text has."""
    words = [t.lower().translate(AS_WORDS).split() for t in texts.cast(pa.binary()).to_pylist()]
    n_words = np.array([len(w) for w in words], dtype=np.int64)
    parts = words
    if most > 1:
        parts = [
            [b" ".join(w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1)]
            for w in words
        ]
    n_features = np.array([len(p) for p in parts], dtype=np.int64)
    coded = pa.array([f for p in parts for f in p], pa.binary()).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.unify_dictionaries().combine_chunks()
    of_kind = checksums(coded.dictionary.to_pylist()) % np.uint32(buckets)
    return of_kind.astype("<u4")[coded.indices.to_numpy()], n_features, n_words


def _hashed(most, buckets):
    def hashed(batches):
        for batch in batches:
            found, counts, n_words = features(batch["text"], most, buckets)
            ends = np.cumsum(counts)
            rest = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_pydict(
                {name: batch[name] for name in rest}
                | {
                    "n_words": pa.array(n_words),
                    "n_features": pa.array(counts),
                    "buckets": pa.array(
                        [
                            found[end - n : end].tobytes()
                            for n, end in zip(counts.tolist(), ends.tolist(), strict=True)
                        ],
                        pa.binary(),
                    ),
                }
            )

    return hashed


def _counted(buckets):
    def counted(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            data = b"".join(batch["buckets"].to_pylist())
            total += np.bincount(np.frombuffer(data, dtype="<u4"), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(there), "n": pa.array(total[there])}
        )

    return counted


def hashed_features(docs, doc_id="doc_id", text="text", most=1, buckets=BUCKETS):
    """Per row ``doc_id``, ``n_words``, ``n_features``, ``buckets`` (unsigned 32-bit numbers)."""
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_features long, buckets binary"
    return rows.mapInArrow(_hashed(most, buckets), schema)


def bucket_counts(hashed, buckets=BUCKETS):
    """``bucket`` and ``n``, its features in all rows; buckets without one are left out."""
    parts = hashed.select("buckets").mapInArrow(_counted(buckets), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(of_target, of_all, buckets=BUCKETS):
    """The gain of every bucket, in thousandths of a logarithm, as a list.

    One row per bucket, a number that does not depend on the tables, reaches the driver.
    """
    spark = of_all.sparkSession
    here = of_all.select("bucket", F.col("n").alias("s"))
    there = of_target.select("bucket", F.col("n").alias("t"))
    rows = spark.range(buckets).withColumnRenamed("id", "bucket")
    rows = rows.join(here, "bucket", "left").join(there, "bucket", "left").fillna(0)
    found = {r["bucket"]: (r["s"], r["t"]) for r in rows.collect()}
    s = np.array([found[b][0] for b in range(buckets)], dtype=np.float64)
    t = np.array([found[b][1] for b in range(buckets)], dtype=np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(gain):
    def weighed(batches):
        for batch in batches:
            data = b"".join(batch["buckets"].to_pylist())
            values = gain[np.frombuffer(data, dtype="<u4")]
            ends = np.cumsum(batch["n_features"].to_numpy())
            sums = np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])]
            yield pa.RecordBatch.from_pydict(
                {name: batch[name] for name in ("doc_id", "n_words", "n_features")}
                | {"weight": pa.array(np.diff(sums))}
            )

    return weighed


def noise(doc_id, seed=SEED):
    """Gumbel noise in thousandths from the id's text; NULL without an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows, *order):
    """``rows`` with ``place``: 1, 2, 3, ... in the given order, over all of them.

    Rows are range-partitioned, sorted, and written with their partition and place in
    it; the sums of the partitions' sizes, a row each, are all that is joined.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"), within.alias("place")),
        "ranked",
    )
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the table above.
    before = sizes.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    joined = parts.join(F.broadcast(before), "part")
    return joined.withColumn("place", F.col("place") + F.col("before") + 1).drop("part", "before")


def resample(
    docs,
    target,
    doc_id="doc_id",
    text="text",
    target_text="text",
    most=1,
    buckets=BUCKETS,
    min_words=MIN_WORDS,
    percent=PERCENT,
    seed=SEED,
):
    """Per row: ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``, the place in the
    draw of ``percent`` of the documents with ``min_words`` words or more, or NULL.

    NULL and empty texts have no feature and weight 0. Ties go to the smaller id; rows
    that repeat an id follow each other, larger feature counts first. A row without an id
    has no noise, so score and rank are NULL and it is none of those drawn from. An
    empty target gives every bucket the gain of no target feature, and an empty table
    no row. Texts are taken whole, however long; only ids and texts are read, so other
    columns may have any name.
    """
    hashed = written(hashed_features(docs, doc_id, text, most, buckets), "importance")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_text).alias("text"))
    gain = gains(
        bucket_counts(hashed_features(wanted, most=most, buckets=buckets), buckets),
        bucket_counts(hashed, buckets),
        buckets,
    )
    kind = hashed.schema["doc_id"].dataType.simpleString()
    weighed = hashed.mapInArrow(
        _weighed(gain), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    # The row's number makes every rank a key of its own, so that no id fills a range.
    rows = written(
        weighed.withColumn("score", score).withColumn("row", F.monotonically_increasing_id()),
        "weighed",
    )
    fit = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    fit = F.coalesce(fit, F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features").desc(), F.col("row")]
    placed = ranked(rows.where(fit), *order)
    drawn = placed.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    rest = rows.where(~fit).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.select(*columns, rank).unionByName(rest)
