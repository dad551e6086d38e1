"""SimHash near-dedup: 64-bit fingerprints, compared as vertical bit planes.

Fingerprint: the text's A-Z are lowered, its words cut into shingles, each
shingle hashed by XXH64 with seed 42; a bit is 1 if it is set in over half of the
hashes. A text without a word has fingerprint zero and links like any other.

Candidates: two fingerprints that differ in at most ``radius`` of 64 bits agree
on all of ``kept`` blocks when the bits are cut into ``radius + kept`` blocks, for
at least one choice of blocks. Each choice is a table, and equal block values
are a bucket. ``kept`` follows the number of distinct fingerprints, so that a
bucket of unrelated ones stays small at any size; links are the same for each.

Comparison: the fingerprints of a task stand side by side as 64 bit planes, 64
lanes to a machine word. Lane i is compared with lane i + lag, for all lanes
and buckets at once: each plane's differences go into carry-save counters, and
words whose lanes all exceed the radius are left out of the remaining planes.
"""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tillroll.llm.common import as_bytes, free_name, give_back, whole_text, written
from tillroll.llm.components import component_roots

BITS = 64
SEED = 42
SHINGLE = 4
RADIUS = 4
# Fingerprints of one bucket that one task compares with each other. A larger
# bucket is cut into chunks, and each pair of chunks is a cell of its own.
CHUNK = 4096
# Members of cells that one task holds and compares, about 250 bytes each.
ROWS_AT_ONCE = 500_000
HASHES_AT_ONCE = 1 << 16


def fingerprint(text, shingle=SHINGLE):
    """The fingerprint of one text given as UTF-8 bytes, as an unsigned int."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle=SHINGLE):
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        give_back()
        prints = [fingerprint(x, shingle) for x in as_bytes(texts)]
        return pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return simhash(text)


def fingerprint_hex(column):
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def block_masks(radius, kept):
    """One mask per choice of ``kept`` blocks out of ``radius + kept``."""
    n = radius + kept
    cuts = [BITS * i // n for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(n)]
    return [sum(choice) for choice in combinations(blocks, kept)]


def kept_blocks(distinct, radius):
    """The fewest blocks whose values number at least the distinct fingerprints."""
    for kept in range(1, BITS - radius):
        if kept * (BITS // (radius + kept)) >= max(1, distinct).bit_length():
            return kept
    return BITS - radius - 1


def _signed(mask):
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _planes(prints):
    """Bit planes, one row per bit, with a spare word for shifts past the end."""
    n = len(prints)
    words = (n + 63) // 64
    bits = np.unpackbits(prints.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.zeros((BITS, (words + 1) * 8), dtype=np.uint8)
    packed[:, : (n + 7) // 8] = np.packbits(bits.T, axis=1, bitorder="little")
    return packed.view("<u8")


def _within(planes, words, lag, active, radius):
    """The words and lane masks whose lane and the lane ``lag`` on differ in <= radius bits."""
    last = planes.shape[1] - 1
    skip, turn = divmod(lag, 64)
    counters = [np.zeros(len(words), dtype=np.uint64) for _ in range((radius + 1).bit_length())]
    over = np.zeros(len(words), dtype=np.uint64)
    near = np.minimum(words + skip, last)
    far = np.minimum(words + skip + 1, last)
    for bit in range(BITS):
        plane = planes[bit]
        other = plane[near]
        if turn:
            other = (other >> np.uint64(turn)) | (plane[far] << np.uint64(64 - turn))
        carry = plane[words] ^ other
        for i, counter in enumerate(counters):
            counters[i], carry = counter ^ carry, counter & carry
        over |= carry
        if bit % 8 == 7 or bit == BITS - 1:
            live = active & ~(over | _more_than(counters, radius))
            left = live != 0
            if not left.all():
                words, near, far, active = words[left], near[left], far[left], active[left]
                over, counters = over[left], [c[left] for c in counters]
                live = live[left]
            if not len(words):
                break
    return (words, live) if len(words) else (words, words)


def _more_than(counters, radius):
    """Lanes whose carry-save count is above the radius."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal = equal & counters[i]
        else:
            above = above | (equal & counters[i])
            equal = equal & ~counters[i]
    return above


def _merge(label, a, b):
    """Join the components of the pairs (a, b); labels are the least index of each."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            short = label[label]
            if np.array_equal(short, label):
                break
            label[:] = short


def linked(prints, buckets, radius=RADIUS):
    """A spanning set of the links within buckets.

    ``prints`` are unsigned 64-bit, sorted by ``buckets``, where equal numbers are
    neighbours. Returns index pairs (i, j): joining them joins exactly what the
    links join.
    """
    n = len(prints)
    pairs = np.zeros((0, 2), dtype=np.int64)
    if n < 2:
        return pairs
    planes = _planes(np.ascontiguousarray(prints, dtype="<u8"))
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # lanes to the end of the bucket
    label = np.arange(n)
    padded = np.zeros((n + 63) // 64 * 64, dtype=bool)
    lanes = np.flatnonzero(left > 1)
    for lag in range(1, int(sizes.max())):
        lanes = lanes[left[lanes] > lag]
        # An active mask per word; lanes of smaller buckets have dropped out.
        words = np.unique(lanes >> 6)
        padded[lanes] = True
        chosen = padded.reshape(-1, 64)[words]
        active = np.packbits(chosen, axis=1, bitorder="little").view("<u8").ravel()
        padded[lanes] = False
        words, live = _within(planes, words, lag, active, radius)
        if len(words):
            bits = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(bits)
            at = words[row] * 64 + lane
            _merge(label, at, at + lag)
    moved = np.flatnonzero(label != np.arange(n))
    return np.stack([moved, label[moved]], axis=1)


def _compare(radius):
    def compare(batches):
        """Links within the buckets of one partition, about ``ROWS_AT_ONCE`` members."""
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        give_back()
        table = pa.Table.from_batches(batches)
        prints = table["fp"].to_numpy()
        keys = np.stack([table[c].to_numpy() for c in ("t", "key", "i", "j")], axis=1)
        order = np.lexsort((prints, keys[:, 3], keys[:, 2], keys[:, 1], keys[:, 0]))
        prints, keys = prints[order], keys[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
        buckets = np.cumsum(new)
        pairs = linked(prints.view(np.uint64), buckets, radius)
        yield pa.RecordBatch.from_arrays(
            [pa.array(prints[pairs[:, 0]]), pa.array(prints[pairs[:, 1]])], names=["a", "b"]
        )

    return compare


def print_links(prints, distinct, radius=RADIUS, chunk=CHUNK, at_once=ROWS_AT_ONCE):
    """Links ``a``, ``b`` that connect what lies within the radius.

    ``prints`` has one row per distinct fingerprint in ``fp``. Buckets above
    ``chunk`` members are split: member x belongs to chunk hash(x), and each pair
    of chunks is compared in a cell of its own, so no link is lost and no task
    gets a whole hot bucket. The number of tasks follows the members of all cells,
    about ``at_once`` to a task.
    """
    masks = block_masks(radius, kept_blocks(distinct, radius))
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in enumerate(masks)
        ]
    )
    keyed = prints.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
    # A bucket above the chunk size uses up that many of its table's members, so
    # there are at most len(masks) * distinct / chunk of them.
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    large = written(
        sizes.where(F.col("n") > chunk).select("t", "key", "n", chunks.alias("chunks")), "hot-buckets"
    )
    # Every member is in one cell of each table, and in as many as it has chunks if hot.
    more = large.agg(F.sum(F.col("n") * (F.col("chunks") - 1))).first()[0] or 0
    members = distinct * len(masks) + more
    joined = keyed.join(large.drop("n"), ["t", "key"], "left").select(
        "t",
        "key",
        "fp",
        F.coalesce("chunks", F.lit(1)).alias("chunks"),
    )
    own = joined.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    cells = own.select(
        "t",
        "key",
        "fp",
        "own",
        F.explode(F.expr("sequence(0, chunks - 1)")).alias("other"),
    ).select(
        "t", "key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    usual = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, math.ceil(members / at_once))
    return cells.repartition(parts, "t", "key", "i", "j").mapInArrow(
        _compare(radius), "a long, b long"
    )


def group_prints(prints, radius=RADIUS):
    """Components of distinct fingerprints: ``fp``, ``root`` of all that are not roots."""
    distinct = prints.count()
    return component_roots(print_links(prints, distinct, radius))


def near_duplicates(docs, doc_id="doc_id", text="text", shingle=SHINGLE, radius=RADIUS):
    """``doc_id``, ``fp`` (signed long) and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links reach. NULL ids link
    like any other and never are a component's id unless it has no other; NULL
    texts are empty; repeated rows each keep a row; an empty table gives none.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint_column(whole_text(text), shingle).alias("fp")
    )
    rows = written(rows, "simhash")
    return _with_components(rows, radius)


def _with_components(rows, radius):
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = written(
        prints.join(
            group_prints(prints.select("fp"), radius).withColumnRenamed("a", "fp"), "fp", "left"
        ).select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "roots",
    )
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = roots.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of_print, "fp").select("doc_id", "fp", "component_id", "root")


def drop_near_duplicates(docs, doc_id="doc_id", text="text", shingle=SHINGLE, radius=RADIUS):
    """``docs`` with one row of each group of linked rows, with all its columns.

    The row with the least id stays, the first in the table among rows of that
    id; NULL ids come last. NULL texts are empty; an empty table stays empty.
    """
    fp, row = free_name(docs, "simhash_print"), free_name(docs, "simhash_row")
    staged = written(
        docs.withColumn(fp, fingerprint_column(whole_text(text), shingle)).withColumn(
            row, F.monotonically_increasing_id()
        ),
        "simhash",
    )
    # The order of rows in a group; a group of copies is one row per task here.
    place = F.struct(
        F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.col(row).alias("row")
    )
    prints = written(staged.groupBy(F.col(fp).alias("fp")).agg(F.min(place).alias("p")), "prints")
    roots = group_prints(prints.select("fp"), radius).withColumnRenamed("a", "fp")
    winners = (
        prints.join(roots, "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("group"))
        .agg(F.min("p").alias("p"))
        .select(F.col("p.row").alias(row))
    )
    # Row numbers spread evenly, so that copies do not meet in one task.
    return staged.join(winners, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
