"""Token ids of whole texts by a public word-BPE tokenizer file.

The tokenizer drops white space and its pieces never reach across it, so a text
is the concatenation of its white-space separated chunks: each distinct chunk
is encoded once by the tokenizers library and kept in the worker. The library's
normaliser and splitter do nothing but lower the letters and part a mark from
them where a chunk is Latin letters with or without a mark behind it, so those go to
the library's merge model directly. Ids travel as little-endian unsigned 16-bit
strings, half the size of 32-bit ones.
"""

import os
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from tokenizers import Tokenizer

from tillroll.llm.common import (
    Memo,
    flat_table,
    gather,
    give_back,
    id_and_text,
    kept,
    numbered_words,
    slices,
    text_sizes,
    written,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
ID_TYPE = "<u2"
WORDS_AT_ONCE = 1 << 20
TEXT_AT_ONCE = 8 << 20
# ASCII letters, and Latin-1 letters that are lower case already. None of them
# composes with another, so lowering the ASCII ones first changes nothing.
LETTERS_AND_MARK = re.compile(rb"((?:[A-Za-z]|\xc3[\xa0-\xb6\xb8-\xbf])+)([.,])?")


def byte_characters():
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others are numbered from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class ChunkEncoder:
    """Encodes texts by one tokenizer file; one per worker and stage."""

    def __init__(self, path):
        # Spark runs a task per core; threads of the library would compete with them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16 or sys.byteorder != "little":
            raise ValueError("ids of this tokenizer do not fit little-endian 16-bit strings")
        self.characters = byte_characters()
        self.marks = {m: self._whole([m])[0] for m in (b".", b",")} | {None: b""}
        self.known = Memo(450_000)

    def _whole(self, chunks):
        """Chunks through all of the tokenizer."""
        texts = [c.decode() for c in chunks]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H", one.ids).tobytes() for one in coded]

    def _learn(self, chunks):
        merge, match, marks = self.tokenizer.model.tokenize, LETTERS_AND_MARK.fullmatch, self.marks
        found, rest = [], []
        for chunk in chunks:
            simple = match(chunk)
            if simple is None:
                rest.append(len(found))
                found.append(None)
                continue
            word, mark = simple.groups()
            text = word.lower().decode("latin-1")
            if not text.isascii():
                text = text.translate(self.characters)
            found.append(array("H", [t.id for t in merge(text)]).tobytes() + marks[mark])
        for i, ids in zip(rest, self._whole([chunks[i] for i in rest]), strict=True):
            found[i] = ids
        return found

    def encode(self, texts):
        """The ids of an Arrow text column: all of them, and how many each text has."""
        words, numbers, counts = numbered_words(texts)
        table, offsets, lengths = flat_table(self.known.values(words, self._learn))
        table, offsets, lengths = table.view(ID_TYPE), offsets // 2, lengths // 2
        ids = [np.zeros(0, ID_TYPE)]
        ids += [
            gather(table, offsets, lengths, numbers[at : at + WORDS_AT_ONCE])[0]
            for at in range(0, len(numbers), WORDS_AT_ONCE)
        ]
        of = np.repeat(np.arange(len(counts)), counts)
        return np.concatenate(ids), np.bincount(of, lengths[numbers], len(counts)).astype(np.int64)


def encoder(path):
    return kept(("encoder", path), lambda: ChunkEncoder(path))


def _encode(path, end_id):
    end = np.array([end_id], ID_TYPE).tobytes()

    def coded(own, rows, part, before):
        """The rows of some texts, and the ids up to the last of them."""
        ids, counts = own.encode(rows["text"])
        raw, cuts = ids.tobytes(), (2 * np.cumsum(counts)).tolist()
        coded = [raw[a:b] + end for a, b in zip([0, *cuts], cuts, strict=False)]
        counts += 1
        ends = before + np.cumsum(counts)
        arrays = [
            rows["doc_id"],
            pa.array(np.full(len(counts), part, dtype=np.int64)),
            pa.array(ends - counts),
            pa.array(counts),
            pa.array(coded, pa.binary()),
        ]
        names = ["doc_id", "part", "part_start", "n_tokens", "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names), before + int(counts.sum())

    def encode(batches):
        part, before = TaskContext.get().partitionId(), 0
        give_back()
        own = encoder(path)
        for batch in batches:
            for lo, hi in slices(text_sizes(batch["text"]), TEXT_AT_ONCE):
                rows, before = coded(own, batch.slice(lo, hi - lo), part, before)
                yield rows
                del rows
                give_back()

    return encode


def encoded(docs, doc_id="doc_id", text="text", path=TOKENIZER, end_id=END_ID):
    """Every document's ids, the end id last, as a written table.

    Columns: ``doc_id``, ``part`` (the task that read it), ``part_start`` (ids of that
    task before it), ``n_tokens``, ``ids``. NULL texts are empty: the end id alone.
    """
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(
        rows.mapInArrow(
            _encode(path, end_id),
            f"doc_id {kind}, part long, part_start long, n_tokens long, ids binary",
        ),
        "token-ids",
    )
