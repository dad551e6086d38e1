"""SentencePiece encoding and decoding in vectorised merge rounds.

Works on the pieces and scores of a BPE model file; the library reads the file
and is not asked to encode. A text is normalised as the model says (spaces become
U+2581, one is put in front), and cut where no piece can reach across: between two
characters that stand next to each other in no piece. The distinct parts of a batch
lie in one flat array of symbols. In each round every part looks up the best rank
among its neighbouring pairs (a segmented minimum), merges that pair wherever it
occurs, leftmost first, and the array is compacted; parts without a pair are done.

The library merges one occurrence at a time. That gives the same result unless a
merged piece can take part in a merge that ranks better than its own; for those
pieces a round merges the leftmost occurrence alone.
"""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import functions as F

from tillroll.llm.common import Memo, flat_table, gather, id_and_text, slices, text_sizes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
TEXT_AT_ONCE = 4 << 20
SYMBOLS_AT_ONCE = 1 << 20
LONG_WORD = 64  # characters from which a word is cut before it is merged
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NO_PAIR = np.iinfo(np.int32).max

_codecs = {}


class Pairs:
    """A hash table from symbol pairs to (rank, merged symbol), probed in bulk."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, left, right, rank, merged):
        keys = np.asarray(left, np.uint64) << np.uint64(32) | np.asarray(right, np.uint64)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.rank = np.full(1 << self.bits, NO_PAIR, dtype=np.int32)
        self.merged = np.zeros(1 << self.bits, dtype=np.int32)
        free = ~self.keys
        at, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            slots, first = np.unique(at[todo], return_index=True)
            open_slots = self.keys[slots] == ~free[0]
            put = todo[first[open_slots]]
            self.keys[at[put]] = keys[put]
            self.rank[at[put]] = np.asarray(rank, np.int32)[put]
            self.merged[at[put]] = np.asarray(merged, np.int32)[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, keys):
        return ((keys * self.MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left, right):
        """The table slot of each pair, or -1."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = self._slot(keys)
        found = np.full(len(keys), -1, dtype=np.int64)
        left_over = np.arange(len(keys))
        empty = np.iinfo(np.uint64).max
        for _ in range(self.probes):
            here = self.keys[at[left_over]]
            hit = here == keys[left_over]
            found[left_over[hit]] = at[left_over[hit]]
            left_over = left_over[~hit & (here != empty)]
            if not len(left_over):
                break
            at[left_over] = (at[left_over] + 1) & (len(self.keys) - 1)
        return found


class Codec:
    """Encodes and decodes by one model file; one per worker."""

    def __init__(self, path=MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.unknown, self.end = model.unk_id(), model.eos_id()
        pieces = [model.id_to_piece(i) for i in range(size)]
        byte_ids = [i for i in range(size) if model.is_byte(i)]
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte pieces to fall back on")
        marked = set(byte_ids)
        plain = [
            i
            for i in range(size)
            if i not in marked and not model.is_control(i) and not model.is_unknown(i)
        ]
        ids = {pieces[i]: i for i in plain}
        # Symbols: piece ids, then characters that are in some piece but no piece.
        symbols = dict(ids)
        for piece in ids:
            for c in piece:
                symbols.setdefault(c, size + len(symbols) - len(ids))
        self.size = size
        self.byte_of_id = np.full(size, -1, dtype=np.int64)
        self.byte_of_id[byte_ids] = np.arange(256)
        self.byte_ids = np.array(byte_ids)
        score = {i: model.get_score(i) for i in plain}
        order = sorted(plain, key=lambda i: -score[i])
        ranks, last, rank = {}, None, -1
        for i in order:
            rank, last = (rank if score[i] == last else rank + 1), score[i]
            ranks[i] = rank
        pairs = [
            (symbols[piece[:k]], symbols[piece[k:]], ranks[i], i)
            for piece, i in ids.items()
            for k in range(1, len(piece))
            if piece[:k] in symbols and piece[k:] in symbols
        ]
        self.pairs = Pairs(*np.array(pairs, dtype=np.int64).reshape(-1, 4).T)
        self.alone = np.zeros(size, dtype=bool)
        for left, right, rank, _ in pairs:
            for part in (left, right):
                if part < size and len(pieces[part]) > 1 and ranks[part] >= rank:
                    self.alone[part] = True
        self.character = {c: s for c, s in symbols.items() if len(c) == 1}
        self.joined = {piece[k : k + 2] for piece in ids for k in range(len(piece) - 1)}
        # Spelling of each id: a piece's text with spaces, a byte, nothing for controls.
        spelled = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in range(size):
            if model.is_control(i):
                spelled[i] = b""
            elif model.is_unknown(i):
                spelled[i] = " ⁇ ".encode()
            elif self.byte_of_id[i] >= 0:
                spelled[i] = bytes([self.byte_of_id[i]])
        self.spelling = flat_table(spelled)
        self.decimals = flat_table([b"%d " % i for i in range(size)])
        self.known = Memo()

    # --- encoding ---------------------------------------------------------

    def _words(self, texts):
        """The words of an Arrow text column, each distinct one once.

        A word is its leading spaces and what follows them: no piece holds a space
        after another character. Returns the words as bytes, the number of each
        word of the column, and how many words each text has.
        """
        odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE))
        odd = pc.or_(odd, pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")))
        plain = texts.filter(pc.invert(odd))
        odd = odd.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(plain, " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        mark = SPACE.encode()
        words = [mark + w for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        numbers = coded.indices.to_numpy().astype(np.int64)
        if not odd.any():
            return words, numbers, sizes
        place = {w: i for i, w in enumerate(words)}
        per_text = iter(np.split(numbers, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        out = []
        for i, is_odd in enumerate(odd):
            if is_odd:
                own = [w.encode() for w in WORDS.findall(self._normal(texts[i].as_py()))]
                out.append(np.array([place.setdefault(w, len(place)) for w in own], np.int64))
            else:
                out.append(next(per_text))
        return list(place), np.concatenate(out), np.array([len(o) for o in out], np.int64)

    @staticmethod
    def _normal(text):
        return SPACE + text.replace(" ", SPACE) if text else ""

    def _learn(self, words):
        """The ids of distinct words, as bytes."""
        parts, owner = [], []
        for i, word in enumerate(words):
            text = word.decode()
            own = [text] if len(text) <= LONG_WORD else self._cut(text)
            parts += own
            owner += [i] * len(own)
        # Parts of like length go through the rounds together.
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        found = [b""] * len(parts)
        for lo, hi in slices([len(parts[i]) for i in order], SYMBOLS_AT_ONCE):
            some = order[lo:hi]
            for i, ids in zip(some, self.merge([parts[i] for i in some]), strict=True):
                found[i] = ids.tobytes()
        out = [[] for _ in words]
        for i, ids in zip(owner, found, strict=True):
            out[i].append(ids)
        return [b"".join(ids) for ids in out]

    def _cut(self, word):
        """Cut a long word where no piece can reach across."""
        joined, at, out = self.joined, 0, []
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in joined:
                out.append(word[at:i])
                at = i
        return [*out, word[at:]]

    def merge(self, parts):
        """The ids of many parts, each as an array."""
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        text = "".join(parts)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        points, which = np.unique(codes, return_inverse=True)
        # Characters outside the vocabulary merge with nothing.
        table = np.array([self.character.get(chr(c), -1 - int(c)) for c in points], np.int64)
        symbols = table[which]
        owner = np.repeat(np.arange(len(parts)), lengths)
        done_symbols, done_owner, done_place = [], [], []
        place = np.arange(len(symbols))
        left, right = symbols[:-1], symbols[1:]
        slot = self._slots(left, right, owner[:-1] == owner[1:])
        while len(symbols):
            rank = np.where(slot >= 0, self.pairs.rank[slot], NO_PAIR)
            rank = np.append(rank, NO_PAIR)  # of the last symbol with what follows it
            slot = np.append(slot, -1)
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(symbols)))
            busy = best != NO_PAIR
            if not busy.all():
                rest = np.repeat(~busy, sizes)
                done_symbols.append(symbols[rest])
                done_owner.append(owner[rest])
                done_place.append(place[rest])
                symbols, owner, place = symbols[~rest], owner[~rest], place[~rest]
                rank, slot = rank[~rest], slot[~rest]
                sizes, best = sizes[busy], best[busy]
                if not len(symbols):
                    break
            at = self._chosen(rank == np.repeat(best, sizes), rank, slot, owner)
            symbols[at] = self.pairs.merged[slot[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            # Only pairs next to a merge are new.
            stale = np.zeros(len(symbols), dtype=bool)
            stale[at] = True
            before = at[at > 0] - 1
            # A merge that ends just before this one has lost its right symbol.
            stale[before - (~keep[before]).astype(np.int64)] = True
            symbols, owner, place = symbols[keep], owner[keep], place[keep]
            slot, stale = slot[keep], np.flatnonzero(stale[keep])
            stale = stale[stale < len(symbols) - 1]
            slot[stale] = self._slots(
                symbols[stale], symbols[stale + 1], owner[stale] == owner[stale + 1]
            )
            slot = slot[:-1]
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(np.concatenate(done_place), kind="stable")
        return self._with_bytes(symbols[order], owner[order], len(parts))

    def _slots(self, left, right, same):
        slots = np.full(len(left), -1, dtype=np.int64)
        ask = np.flatnonzero(same & (left >= 0) & (right >= 0))
        slots[ask] = self.pairs.find(left[ask], right[ask])
        return slots

    def _chosen(self, hit, rank, slot, owner):
        """Where this round merges: leftmost first, never two that overlap."""
        at = np.flatnonzero(hit)
        # Occurrences in a row overlap only if they follow each other directly;
        # then every second one is left.
        run = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])])
        first = np.flatnonzero(run)
        number = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        at = at[number % 2 == 0]
        # Equal ranks may belong to different pairs only if scores tie.
        alone = self.alone[self.pairs.merged[slot[at]]]
        if alone.any():
            again = np.concatenate([[False], owner[at[1:]] == owner[at[:-1]]])
            lonely = np.zeros(len(at), dtype=bool)
            lonely[alone] = True
            at = at[~(again & lonely)]
        return at

    def _with_bytes(self, symbols, owner, n):
        """Symbols without an id become the bytes of their character."""
        if (symbols < 0).any() or (symbols >= self.size).any():
            names = {s: c for c, s in self.character.items() if s >= self.size}
            odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
            spelled = {
                int(s): (chr(-1 - int(s)) if s < 0 else names[int(s)]).encode()
                for s in np.unique(symbols[odd])
            }
            count = np.ones(len(symbols), dtype=np.int64)
            count[odd] = [len(spelled[int(s)]) for s in symbols[odd]]
            ends = np.cumsum(count)
            wide, wide_owner = np.repeat(symbols, count), np.repeat(owner, count)
            if len(odd):
                octets = np.frombuffer(b"".join(spelled[int(s)] for s in symbols[odd]), np.uint8)
                starts = ends[odd] - count[odd]
                inner = np.arange(len(octets)) - np.repeat(
                    np.cumsum(count[odd]) - count[odd], count[odd]
                )
                wide[np.repeat(starts, count[odd]) + inner] = self.byte_ids[octets]
            symbols, owner = wide, wide_owner
        cuts = np.cumsum(np.bincount(owner, minlength=n))[:-1]
        return np.split(symbols.astype(np.int32), cuts)

    def encode(self, texts, add_end=False):
        """The ids of each text of an Arrow column, as arrays."""
        words, numbers, counts = self._words(texts)
        table = self.known.values(words, self._learn)
        raw, offsets, lengths = flat_table(table)
        raw, offsets, lengths = raw.view("<i4"), offsets // 4, lengths // 4
        ids = gather(raw, offsets, lengths, numbers)[0]
        of = np.repeat(np.arange(len(counts)), counts)
        sizes = np.bincount(of, lengths[numbers], len(counts)).astype(np.int64)
        out = np.split(ids, np.cumsum(sizes)[:-1]) if len(counts) else []
        if add_end:
            end = np.array([self.end], dtype=np.int32)
            out = [np.concatenate([some, end]) for some in out]
        return out

    # --- decoding ---------------------------------------------------------

    def decode(self, ids):
        """The texts of many id arrays."""
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        flat = np.concatenate([*ids, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        raw, ends = gather(*self.spelling, flat)
        raw = raw.tobytes()
        last = np.concatenate([[0], ends])[np.cumsum(counts)].tolist() if len(ids) else []
        texts, at = [], 0
        for own, to in zip(ids, last, strict=True):
            texts.append(self._text(raw[at:to], own))
            at = to
        return texts

    def _text(self, raw, ids):
        # The space put in front goes again, if the text starts with one.
        first = next((int(i) for i in ids if self.spelling[2][i]), None)
        whole = first is not None and first != self.unknown and self.byte_of_id[first] < 0
        if whole and raw[:1] == b" ":
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            # Bytes that are no character become U+FFFD, one for each byte.
            return _lenient(raw)


def _lenient(raw):
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


def codec(path=MODEL):
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _batches(path, add_end, finish, names):
    def run(batches):
        own = codec(path)
        for batch in batches:
            for lo, hi in slices(text_sizes(batch["text"]), TEXT_AT_ONCE):
                ids = own.encode(batch["text"].slice(lo, hi - lo), add_end)
                docs = batch["doc_id"].slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([docs, *finish(own, ids)], names=names)

    return run


def encoded(docs, doc_id="doc_id", text="text", path=MODEL, add_end=True):
    """``doc_id`` and ``ids`` (array<int>) of every row.

    NULL texts are empty and have the end id alone; NULL ids and repeated rows are
    kept; an empty table gives no row. No text is cut short, whatever its length.
    """
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def finish(own, ids):
        return [pa.array(ids, pa.list_(pa.int32()))]

    return rows.mapInArrow(
        _batches(path, add_end, finish, ["doc_id", "ids"]), f"doc_id {kind}, ids array<int>"
    )


def decoded(rows, doc_id="doc_id", ids="ids", path=MODEL):
    """``doc_id`` and ``text`` of rows with ids; NULL ids spell the empty text."""
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = codec(path)
        for batch in batches:
            texts = own.decode([np.array(i or [], dtype=np.int64) for i in batch["ids"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return rows.mapInArrow(run, f"doc_id {kind}, text string")


def _digests(own, ids):
    counts = np.array([len(i) for i in ids], dtype=np.int64)
    decimals, ends = gather(*own.decimals, np.concatenate(ids).astype(np.int64))
    decimals, last = decimals.tobytes(), ends[np.cumsum(counts) - 1].tolist()
    sums, at = [], 0
    for to in last:
        sums.append(hashlib.sha256(decimals[at : to - 1]).hexdigest())
        at = to
    texts = [hashlib.sha256(t.encode()).hexdigest() for t in own.decode(ids)]
    return [pa.array(counts), pa.array(sums, pa.string()), pa.array(texts, pa.string())]


def round_trip(docs, doc_id="doc_id", text="text", path=MODEL):
    """Encode with an end id, decode again, and report digests of both.

    ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256`` (the decoded text in UTF-8). Cases as in :func:`encoded`.
    """
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return rows.mapInArrow(
        _batches(path, True, _digests, names),
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
