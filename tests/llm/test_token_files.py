from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from wellops.llm import seekable
from wellops.llm.token_files import Encoder, default_tokenizer, encode_documents, op10_token_files, read_tokens, write_tokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(default_tokenizer())
    own.encode_special_tokens = True
    return own


def expected(rows, tokenizer):
    """doc_id -> the ids of each of its rows with the end id, sorted."""
    out = {}
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.setdefault(doc_id, []).append(ids)
    return {k: sorted(v) for k, v in out.items()}


def check(result, rows, tokenizer):
    wanted, position = expected(rows, tokenizer), 0
    got = sorted(result, key=lambda r: r["start"])
    assert len(got) == len(rows)
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda d: (d is not None, d or 0))
    for r in got:
        assert r["start"] == position
        position += r["n_tokens"]
        match = [ids for ids in wanted[r["doc_id"]] if len(ids) == r["n_tokens"]
                 and zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)) == r["ids_crc32"]]
        assert match
        wanted[r["doc_id"]].remove(match[0])


def test_query_is_a_round_trip(spark, sf_dir, documents, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check(op10_token_files(spark, sf_dir).collect(), rows, tokenizer)


def test_odd_documents(spark, odd_documents, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    check(encode_documents(odd_documents, default_tokenizer()).collect(), rows, tokenizer)
    assert encode_documents(odd_documents.limit(0), default_tokenizer()).count() == 0


def test_cached_pieces_equal_whole_texts():
    encode = Encoder(default_tokenizer())
    texts = ["", "a", "  x", "a\n\nb", " a", "a ", "it's <|endoftext|> a", "a\tb c\n d", "é ü\nñ", "a\n", "1 2 3\n'ab 's",
             "x y z", "　x y", "x y z\nq", "don't we'll\nI'm", "😀 😀\n😀", "a\r\nb c", "x\x1cy z"]
    assert encode(texts) == encode.whole(texts) == encode(texts)


def test_reader_takes_one_document_and_finds_damage(tmp_path, monkeypatch):
    monkeypatch.setattr(seekable, "MAX_FRAME", 64)
    path = f"{tmp_path}/deep/part.zst"
    writer = seekable.Writer(path, "attempt-0")
    documents = {k: np.arange(k * 8, dtype="<u4") for k in range(12)}  # of 0 to 88 ids, some full frames
    for k, ids in documents.items():
        writer.add(k, ids.tobytes())
    writer.add(11, documents[3].tobytes())
    writer.close()
    reader = seekable.Reader(path)
    for k in range(11):
        assert [t.tolist() for t in reader.tokens(k)] == [documents[k].tolist()]
    assert [len(t) for t in reader.tokens(11)] == [88, 24] and reader.tokens(99) == []
    assert [(k, len(raw)) for k, raw in reader.documents()] == [(k, 32 * k) for k in range(12)] + [(11, 96)]
    raw = bytearray(open(path, "rb").read())
    import zstandard
    assert zstandard.ZstdDecompressor().decompress(bytes(raw[:int(reader.entries[0][0])]), max_output_size=1) == b""
    reader.entries = reader.entries.copy()
    reader.entries[5][2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        list(reader.documents())


def test_smallest_id_and_no_id_are_told_apart(spark, tokenizer):
    rows = [(-2**63, "a b"), (None, "c"), (None, None), (0, "d"), (-1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = encode_documents(docs, default_tokenizer()).collect()
    check(got, rows, tokenizer)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])][:3] == [None, None, -2**63]


def test_file_systems_that_tasks_cannot_write_to_are_refused(spark, odd_documents):
    with pytest.raises(ValueError, match="pass a folder"):
        write_tokens(odd_documents, "viewfs://cluster/x", default_tokenizer())


def test_manifest_counts(spark, odd_documents, tmp_path):
    manifest = write_tokens(odd_documents, f"{tmp_path}/files", default_tokenizer())
    rows = manifest.collect()
    assert sum(r["n_docs"] for r in rows) == odd_documents.count()
    assert read_tokens(spark.createDataFrame(rows, manifest.schema)).count() == odd_documents.count()
