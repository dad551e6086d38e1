import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import packing, word_ids

TEXTS = [
    None,
    "",
    " \n ",
    "Hello, World! it's fine",
    "<|endoftext|> <|startoftext|>x",
    "É́ é ́ \x85\xa0 ß Ａ １２ \x1c\x1f end",
    "日本語 テスト 😀😀",
    "word " * 3000,
    "x" * 5000,
]


def reference_ids(text):
    tokenizer = Tokenizer.from_file(word_ids.TOKENIZER)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "a") for i, t in enumerate(TEXTS)] + [(None, "no id", "b"), (3, "again", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)


def test_ids_equal_the_library_on_whole_texts(docs):
    got = docs.select("doc_id", "text").collect()
    coded = word_ids.encoded(docs).select("doc_id", "ids", "n_tokens").collect()
    want = sorted([str((r.doc_id, reference_ids(r.text))) for r in got])
    have = [
        str((r.doc_id, np.frombuffer(bytes(r.ids), "<u2").tolist())) for r in coded
    ]
    assert sorted(have) == want


@pytest.mark.parametrize("length", [7, 4096])
def test_pieces_cover_every_id_once(docs, length):
    pieces = packing.pack(docs, length=length, with_ids=True).cache()
    rows = pieces.collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for r in docs.collect():
        ids = reference_ids(r.text)
        own = sorted(by_doc[(r.doc_id, len(ids))], key=lambda p: p.start)
        assert sum([p.ids for p in own], []) == ids
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
    at = 0
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert (r.sequence_id, r.offset) == divmod(at, length)
        at += r.length
    whole = packing.sequences(pieces, length).orderBy("sequence_id").collect()
    assert [s.n_tokens for s in whole[:-1]] == [length] * (len(whole) - 1)
    last = whole[-1].n_tokens
    assert len(whole[-1].ids) == (last if last & (last - 1) == 0 else length)
    assert sum(s.n_tokens for s in whole) == at


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0
    assert packing.sequences(packing.pack(docs, with_ids=True)).agg(F.count("*")).first()[0] == 0
