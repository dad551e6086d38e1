"""What the operators of this subpackage share: written stages, names, batches."""

import ctypes
import os
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from tillroll.session import fresh_folder

# The characters that part words, as bytes: 0x20 and 0x09 to 0x0D. They are what
# bytes.split() parts by, so that is the word splitter of every operator here.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
_kept = {}


def importable(spark):
    """Let Python workers import this package from where the driver has it.

    That serves single machines and shared installations; elsewhere the package
    goes with the application (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def written(rows, label):
    """Write rows below the shared folder and read them back.

    The written table cuts the lineage: lost executors cost no recomputation of
    what lies before it, and later passes all see the same rows.
    """
    folder = fresh_folder(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _stage():
    task = TaskContext.get()
    return task and task.stageId()


def kept(name, make):
    """What ``make`` gives, made once per worker and stage.

    A worker serves the tasks of many stages, so what one stage keeps goes when
    the next one calls ``give_back``.
    """
    key = _stage(), name
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def give_back():
    """Hand the system the memory that this worker has freed.

    Arrow's pool and malloc hold on to it otherwise, so a worker stays as large as the
    largest batch of any stage made it.
    """
    stage = _stage()
    for key in [k for k in _kept if k[0] != stage]:
        del _kept[key]
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def free_name(rows, base):
    """A column name that the rows do not use yet (Spark ignores case)."""
    taken = {name.lower() for name in rows.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def whole_text(text="text"):
    """The text column with NULL as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def id_and_text(docs, doc_id="doc_id", text="text"):
    """Only the two columns an operator reads, under fixed names."""
    return docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))


def as_bytes(column):
    """An Arrow text column as a list of UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def text_sizes(column):
    """The bytes of each text of an Arrow column."""
    return pc.binary_length(column).to_pylist()


def slices(sizes, most):
    """Cut consecutive items into (from, to) runs of at most ``most`` in total.

    An item larger than that is a run of its own.
    """
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def gather(table, offsets, lengths, ids):
    """Concatenate the byte strings ``ids`` of a table held as one flat buffer.

    Returns the bytes and the end of each string in them.
    """
    count = lengths[ids]
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    shift = offsets[ids] - (ends - count)
    return table[np.repeat(shift, count) + np.arange(total)], ends


def flat_table(strings):
    """Byte strings as one buffer with offsets and lengths."""
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(strings) else lengths
    return np.frombuffer(b"".join(strings), dtype=np.uint8), offsets, lengths


def numbered_words(texts):
    """The words of an Arrow text column, each distinct one once.

    Returns the distinct words as a list of bytes, the number of each word of the
    column in it, in order, and how many words each text has.
    """
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    numbers = coded.indices.to_numpy().astype(np.int64)
    # White space at an end of a text leaves an empty string there.
    if b"" in words:
        keep = numbers != words.index(b"")
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[keep], minlength=len(counts))
        numbers = numbers[keep]
    return words, numbers, counts


class Memo:
    """What a worker has worked out per word, so that it does so once for most.

    Words in use move to a new generation when the present one is full, and the
    rest go with the old one: a bound on memory, not on work.
    """

    LONGEST = 64  # longer words are not kept

    def __init__(self, limit=350_000):
        self.limit, self.now, self.old = limit, {}, {}

    def values(self, words, learn):
        """The value of each of some distinct words; ``learn`` gives those of new ones."""
        if len(self.now) > self.limit:
            self.old, self.now = self.now, {}
        found = list(map(self.now.get, words))
        rest = [i for i, value in enumerate(found) if value is None]
        if rest:
            older = list(map(self.old.get, [words[i] for i in rest]))
            new = [i for i, value in zip(rest, older, strict=True) if value is None]
            for i, value in zip(rest, older, strict=True):
                found[i] = value
            for i, value in zip(new, learn([words[i] for i in new]), strict=True):
                found[i] = value
            kept = [i for i in rest if len(words[i]) <= self.LONGEST]
            self.now.update((words[i], found[i]) for i in kept)
        return found
