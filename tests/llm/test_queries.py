"""The registered queries of the subpackage, and the pipeline, end to end."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import differences, duck
from test_simhash import slow_components
from tillroll.llm import queries, secrets_crf, weak_quality, word_ids

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op4": "doc_id start n_tokens ids_crc32",
    "op5": "doc_id fingerprint component_id",
    "op6": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8": "doc_id size text_crc32 law shard slot grown_shard",
    "op9": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op10": "conv_id call_id json",
    "op11": "doc_id held_out score predicted",
    "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13": "doc_id n_features weight score rank",
}


def test_there_is_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_document_is_in_the_result(spark, name):
    number = name.split("_")[0]
    rows = queries.QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[number].split()) <= set(rows.columns)
    if number != "op10":
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        assert rows.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert differences(found, duck(SF_DIR), queries.ORACLE_SQL[name]) is None


def texts():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."

    rows = [(0, None), (1, ""), (2, "too short")]
    for i in range(3, 90):
        rows.append((i, "\n".join(prose(rng.randint(15, 40)) for _ in range(rng.randint(3, 9)))))
    for i in range(90, 110):
        rows.append((i, rows[rng.randrange(3, 90)][1]))
    for i in range(110, 130):
        words = rows[rng.randrange(3, 90)][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    for i in range(130, 145):
        rows.append((i, "### *** $$$ buy!! now!! | " * 40))
    for i in range(145, 160):
        rows.append((i, prose(80) + f" password={rng.getrandbits(80):x} " + prose(20)))
    return rows


def test_pipeline_by_brute_force(spark, tmp_path):
    rows = texts()
    docs = spark.createDataFrame(
        [(d, t, "en", "s", len(t or "")) for d, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # Quality, over vote patterns.
    votes = {d: weak_quality.figures((t or "").encode()) for d, t in rows}
    codes = {d: weak_quality.votes_of(f) for d, (_, f) in votes.items()}
    count = Counter(codes.values())
    rules = len(weak_quality.RULES)
    patterns = [[c // 3**r % 3 for r in range(rules)] for c in sorted(count)]
    model = weak_quality.LabelModel.fit(patterns, [count[c] for c in sorted(count)])
    good = dict(zip(sorted(count), model.posterior(patterns), strict=True))
    kept = [
        (d, t)
        for d, t in rows
        if votes[d][0][0] >= 50
        and 100 * votes[d][0][4] <= 50 * votes[d][0][0]
        and good[codes[d]] >= 0.5
    ]
    assert not {d for d, _ in kept} & {0, 1, 2, *range(130, 145)}
    # One document of each group of near copies.
    kept = [(d, t) for (d, t), (_, _, least) in zip(kept, slow_components(kept), strict=True) if d == least]
    assert {p.doc_id for p in pieces} == {d for d, _ in kept}
    # Secrets are masked: the pattern spans, and what the field adds to them.
    schema = "doc_id long, text string"
    tagged = secrets_crf.scan(spark.createDataFrame(kept, schema)).select("doc_id", "spans").collect()
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in tagged}
    tokenizer = Tokenizer.from_file(word_ids.TOKENIZER)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        by_doc.setdefault(p.doc_id, []).extend(p.ids)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
    for d, t in kept:
        assert set(secrets_crf.base_spans(t)) <= set(spans[d])
        masked = secrets_crf.redacted(t, spans[d])
        assert tokenizer.encode(masked, add_special_tokens=False).ids + [2] == by_doc[d]
    # The field adds a span here and there only.
    assert np.mean([len(spans[d]) == len(secrets_crf.base_spans(t)) for d, t in kept]) > 0.95
    # The sequences have no gap.
    at = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert divmod(at, 4096) == (p.sequence_id, p.offset)
        at += p.length
    assert at == sum(map(len, by_doc.values()))


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, SF_DIR)
        assert docs_after.schema.simpleString() == docs.schema.simpleString()
