import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import token_shards, wavelet, word_ids


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 5000])
def test_shard_answers_like_a_plain_array(n):
    rng = np.random.default_rng(n)
    ids = rng.choice([0, 1, 2, 7, 300, 49407], n).astype("<u2")
    shard = wavelet.Shard(wavelet.build(ids, [None, 5], [n // 2, n], 16))
    assert shard.decode().tolist() == ids.tolist()
    assert shard.access(np.arange(n)).tolist() == ids.tolist()
    for token in (0, 1, 2, 7, 300, 49407, 4, 1 << 16):
        where = np.flatnonzero(ids == token)
        assert shard.occurrences(token).tolist() == where.tolist()
        assert shard.count(token) == len(where)
        a, b = n // 3, n - n // 4
        assert shard.count(token, a, b) == ((where >= a) & (where < b)).sum()
    assert shard.doc_ids.tolist() == [0, 5] and shard.has_id.tolist() == [0, 1]


ROWS = [(7, "b c"), (None, "no id"), (2, None), (2, "same id"), (-3, ""), (9, "x y z " * 400)]


@pytest.mark.parametrize("shard_ids", [5, 1 << 20])
def test_documents_come_back_in_id_order(spark, tmp_path, shard_ids):
    docs = spark.createDataFrame([(*r, "k") for r in ROWS], "doc_id long, text string, part string")
    folder = token_shards.write_shards(
        docs.repartition(3), str(tmp_path / "s"), shard_ids=shard_ids
    )
    shards = token_shards.read_shards(spark, folder)
    got = sorted(map(tuple, token_shards.documents_of(shards).collect()), key=lambda r: r[1])
    tokenizer = Tokenizer.from_file(word_ids.TOKENIZER)
    want = {}
    for doc, text in ROWS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.setdefault(doc, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    for doc, start, n, crc in got:
        assert start == at and (n, crc) in want[doc]
        want[doc].remove((n, crc))
        at += n
    assert not any(want.values())
    assert [r[0] for r in got] == [None, -3, 2, 2, 7, 9]
    ends = token_shards.token_counts(shards, 2).agg(F.sum("n")).first()[0]
    assert ends == len(ROWS)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_shards.write_and_read(docs).count() == 0
