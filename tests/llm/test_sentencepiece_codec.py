import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tillroll.llm import sentencepiece_codec as spm

SYLLABLES = (
    "▁| |a|the|in|g|é|漢|字|😀|\x00|\n|\t|1|2|ing|  |AAAA|er|tion|/|http|::|\x85|\xa0|ı|߿|ß|</s>|<0x41>"
).split("|")


@pytest.fixture(scope="module")
def codec():
    return spm.codec()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)


def texts(seed):
    rng = random.Random(seed)
    made = ["".join(rng.choices(SYLLABLES, k=rng.randint(0, 60))) for _ in range(3000)]
    points = [rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x110000)]) for _ in range(5000)]
    long = "".join(rng.choices("etaoinshrdlu", k=20000))
    return made + ["", " ", "a" * 5000, " " * 3000, "ab" * 2000, "".join(map(chr, points)), long]


def test_ids_and_texts_equal_the_library(codec, library):
    cases = texts(1)
    ids = codec.encode(pa.array(cases), True)
    assert [i.tolist() for i in ids] == library.encode(cases, add_eos=True)
    assert codec.decode(ids) == [library.decode(i.tolist()) for i in ids]


def test_decoding_any_ids(codec, library):
    rng = random.Random(2)
    cases = [[]] + [
        [rng.choice([rng.randrange(32000), rng.randrange(259)]) for _ in range(rng.randint(0, 12))]
        for _ in range(5000)
    ]
    assert codec.decode([np.array(c, dtype=np.int64) for c in cases]) == [
        library.decode(c) for c in cases
    ]


def test_whole_tables(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(texts(3)[-60:])]
    rows += [(None, "no id", "y"), (5, None, "z"), (5, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)

    def want(text):
        ids = library.encode(text or "", add_eos=True)
        spelled = " ".join(map(str, ids)).encode()
        back = library.decode(ids).encode()
        return len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(back).hexdigest()

    got = sorted(map(str, map(tuple, spm.round_trip(docs).collect())))
    assert got == sorted(str((d, *want(t))) for d, t, _ in rows)
    back = spm.decoded(spm.encoded(docs)).collect()
    assert sorted(str(tuple(r)) for r in back) == sorted(
        str((d, library.decode(library.encode(t or "")))) for d, t, _ in rows
    )


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spm.round_trip(docs).count() == 0
    assert spm.decoded(spm.encoded(docs)).count() == 0
