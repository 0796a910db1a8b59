"""Shards of token ids against whole-text encoding."""

import io
import zlib

import numpy as np
import pytest
from llm_cases import empty, rows, table
from pyarrow import fs
from quern.llm import sstable
from quern.llm.tokens import Encoder, TokenConfig, op9_tokens, read_shards, write_shards
from tokenizers import Tokenizer

ODD = ["<|endoftext|> a<|startoftext|>x <|endof<|endoftext|> a<|startoftext|>b <|endoftext|>", "Don't I'LL we've o' s' x\u0085y\x1cz", "é ́e a ̈", " ᠎​﻿x", "１２3 ½ ²", "ΑΣ Σ ΑΣ.", "a" * 3000, "İstanbul ǅ", "", " \n "]


def whole(texts):
    t = Tokenizer.from_file(TokenConfig().tokenizer)
    return [e.ids + [1] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts():
    config = TokenConfig(cache_words=500, piece_bytes=1000)
    encode = Encoder(config)
    texts = [r[1] or "" for r in rows()] + ODD
    for text, want in zip(texts, whole(texts), strict=True):
        assert np.frombuffer(encode(text.encode()), f"<u{encode.width}").tolist() == want, repr(text[:60])


def test_parts_of_words_are_encoded_once():
    """Words that differ in case and in the punctuation after them; odd ones next to them."""
    config = TokenConfig(group_bytes=2000)
    encode = Encoder(config)
    starts = ["lorem", "Lorem", "LOREM", "Don't", "x1", "é", "Straße", "слово", "Ёж", "漢字", "a-b", "a*", "<|endoftext|>", "<|endoftext|>z", "İ", "e\u0301", "\u01c5", ""]
    texts = [f"{a}{b} {a}" for a in starts for b in ("", ".", ",", "...", "?!", "'s.", ".\u0301", "*.", ";\u0338", ":a")]
    assert [np.frombuffer(x, f"<u{encode.width}").tolist() for x in encode.many([x.encode() for x in texts])] == whole(texts)
    sent = []
    encode = Encoder(config)
    inner = encode._encode
    encode._encode = lambda words: inner(sent.extend(words) or words)
    list(encode.many([x.encode() for x in ("Lorem, ipsum lorem.", "ipsum. LOREM lorem, IPSUM")]))
    assert sorted(sent) == [b",", b".", b"ipsum", b"lorem"]


def want_of(data):
    ids = dict(zip(range(len(data)), whole([r[1] or "" for r in data]), strict=True))
    return [(data[i][0], ids[i]) for i in range(len(data))]


def test_shards_read_back(spark):
    data = rows() + [(8000 + i, t, "en", "a", 1) for i, t in enumerate(ODD)]
    manifest = write_shards(table(spark, data).repartition(6))
    got = sorted(read_shards(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in data), key=lambda x: (x is not None, x))
    crc = lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted(repr((d, *crc(ids))) for d, ids in want_of(data)) == sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_shards_stay_where_they_are_told(spark, tmp_path):
    """Files and manifest in a given folder; as many shards as the bytes ask for, equal rows in several."""
    data = rows(n=40) + [(5, "one and the same row " * 30, "en", "a", 1)] * 300
    path = f"file://{tmp_path}/out"
    write_shards(table(spark, data).repartition(3), TokenConfig(shard_bytes=20_000), path=path)
    manifest = spark.read.parquet(f"{path}/manifest")
    files = {f"{path}/{p.name}" for p in (tmp_path / "out").glob("*.sst")}
    named = manifest.collect()
    assert {r.path for r in named} == files and len(files) > 8 and sum(r.documents for r in named) == len(data)
    assert sum(r.first_id == 5 for r in named) > 1
    ordered = sorted(named, key=lambda r: (r.first_id is not None, r.first_id or 0, r.first_hash, r.first_tie))
    got = []
    for r in ordered:
        with open(r.path.removeprefix("file://"), "rb") as file:
            got += [k for k, _, _ in sstable.Reader(file, r.size)]
    assert got == sorted((r[0] for r in data), key=lambda x: (x is not None, x))


def test_lookup_by_identifier(spark):
    data = rows(n=200)
    want = {}
    for d, ids in want_of(data):
        want.setdefault(d, []).append(ids)
    shards = write_shards(table(spark, data)).collect()
    found = {}
    for s in shards:
        store, path = fs.FileSystem.from_uri(s.path)
        with store.open_input_file(path) as file:
            reader = sstable.Reader(file, s.size)
            for d in want:
                if (ids := reader.get(d)) is not None:
                    found.setdefault(d, ids.tolist())
            assert all(reader.get(10**9 + i) is None for i in range(300))
    assert set(found) == set(want) and all(found[d] in want[d] for d in want)


def test_table_format():
    file = io.BytesIO()
    writer = sstable.Writer(file, 2)
    keys = [None, None, -(2**63), -5, 0, 0, 7, 2**63 - 1]
    body = {i: np.arange(i * 40_000, dtype="<u2").tobytes() for i in range(len(keys))}
    for i, k in enumerate(keys):
        writer.add(k, body[i])
    with pytest.raises(ValueError):
        writer.add(3, b"")
    writer.close()
    reader = sstable.Reader(file, len(file.getvalue()))
    assert [(k, ids) for k, _, ids in reader] == [(k, body[i]) for i, k in enumerate(keys)]
    assert [before for _, before, _ in reader] == [sum(range(i)) * 40_000 for i in range(len(keys))]
    assert reader.get(7).size == 6 * 40_000 and reader.get(8) is None and reader.get(None).size == 0
    assert len(reader.index) > 3
    broken = bytearray(file.getvalue())
    broken[-80] ^= 1
    with pytest.raises(ValueError):
        sstable.Reader(io.BytesIO(bytes(broken)), len(broken))


def test_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = op9_tokens(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    at, want = 0, []
    for (d, _), ids in zip(docs, whole([t for _, t in docs]), strict=True):
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_empty_table(spark):
    assert read_shards(write_shards(empty(spark))).count() == 0
