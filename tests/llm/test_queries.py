"""Every registered query over the smallest tables, against SQL or a plain version."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import plain
import pytest
from public_tokenizers import path

from ledgerloom.llm.oracle import ORACLE
from ledgerloom.llm.queries import QUERIES


def run(spark, small, name):
    return QUERIES[name](spark, small.folder)


@pytest.fixture(scope="module")
def texts(small):
    return small("SELECT doc_id, text FROM documents ORDER BY doc_id")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, small, name):
    got = run(spark, small, name)
    connection = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small.folder}/{t}.parquet'")
    wanted = connection.sql(ORACLE[name])
    columns = sorted(wanted.columns)
    assert set(columns) <= set(got.columns)
    ordered = wanted.project(", ".join(columns)).fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(ordered)


def test_packing(spark, small, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces = {}
    fills = {}
    for r in run(spark, small, "op2_best_fit_packing").collect():
        pieces.setdefault(r.doc_id, []).append(r)
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for number, r in enumerate(sorted(pieces.pop(doc), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (number, at)
            assert r.length <= 2048 and (number == 0 or r.length == 2048)
            part = np.asarray(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
        assert len(ids) > 2048 or number == 0
        total += at
    assert not pieces
    for parts in fills.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fills) <= -(-total // 2048) + 1


def test_simhash(spark, small, texts):
    wanted = plain.simhash_components(texts)
    got = run(spark, small, "op3_simhash_near_dedup").collect()
    assert sorted(map(tuple, got)) == sorted(
        (doc, f"{plain.simhash(text):016x}", wanted[doc]) for doc, text in texts
    )


def test_sentencepieces(spark, small, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in run(spark, small, "op4_sentencepiece").collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        ids = library.encode(text or "")
        crc = zlib.crc32(np.asarray(ids, "<u4").tobytes())
        assert (got[doc].n_ids, got[doc].ids_crc32) == (len(ids), crc)
    assert all(r.round_trip and r.parity is not False for r in got.values())


def test_sentencepiece_parity_of_every_row(spark, table):
    docs = spark.createDataFrame([(n or None, f"some text {n}") for n in range(70)], "doc_id long, text string")
    got = QUERIES["op4_sentencepiece"](spark, table(documents=docs)).collect()
    assert len(got) == 70 and all(r.parity is True for r in got)


def test_quality_and_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {
        r[0]: r[1:]
        for r in duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{folder}/labels.parquet'").fetchall()
    }
    quality = QUERIES["op5_quality_classifier"](spark, folder).collect()
    held = [r for r in quality if r.held_out and r.doc_id in labels]
    assert len(held) > 40
    assert np.mean([r.kept == bool(labels[r.doc_id][0]) for r in held]) >= 0.9
    toxic = QUERIES["op6_toxicity"](spark, folder).collect()
    assert len(toxic) == len(quality) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxic)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in toxic)
    held = [r for r in toxic if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in held]) >= 0.9


def test_secrets(spark, small, texts):
    got = {r.doc_id: r for r in run(spark, small, "op7_secret_scans").collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        base = plain.base_secrets(text)
        r = got[doc]
        for kind in plain.SECRETS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert {s for s in joined.split(",") if s} <= set(r.spans.split(","))


def test_suffixes(spark, small, texts):
    got = run(spark, small, "op8_suffix_array_dedup").collect()
    assert sorted(map(tuple, got), key=str) == plain.dedup_strings(texts, 400)


def test_vectors(spark, small):
    rows = small("SELECT vec_id, embedding, label FROM embeddings ORDER BY vec_id")
    wanted = plain.vector_links(rows)
    got = run(spark, small, "op9_embedding_near_dedup").collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
