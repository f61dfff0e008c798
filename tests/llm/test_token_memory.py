from __future__ import annotations

import pyarrow as pa

from wellops.llm import token_files
from wellops.llm.token_files import Encoder, default_tokenizer, encode_documents


def test_a_full_cache_keeps_what_is_asked_for_again(monkeypatch):
    monkeypatch.setattr(token_files, "_CACHE_ENTRIES", 50)
    encode = Encoder(default_tokenizer())
    learnt, learn = [], encode._learn
    monkeypatch.setattr(encode, "_learn", lambda pieces, blank: (learnt.extend(pieces), learn(pieces, blank)))
    for k in range(20):
        texts = ["so the cat " + " ".join(f"w{k}x{i}" for i in range(30))]
        assert encode(texts) == encode.whole(texts)
        assert len(encode.cache) + len(encode.older) <= 2 * (50 + 33)
    assert [learnt.count(w) for w in ("the", "cat", "\nso", "w7x3")] == [1, 1, 1, 1]


def test_arrow_columns_are_encoded_as_they_are():
    encode = Encoder(default_tokenizer())
    texts = ["a b\nc", "", "two  blanks", "\n", "x <|endoftext|> y", "\ta b", "é　ü a", "a b\nc"] * 3
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["z", *texts]).slice(1)):
        assert encode(column) == encode.whole(texts)
    assert encode(pa.array([], pa.string())) == [] and encode(pa.array([None, "a"])) == [b"", *encode.whole(["a"])]


def test_very_long_words_are_not_kept(monkeypatch):
    monkeypatch.setattr(token_files, "_CACHE_CHARS", 1000)
    encode = Encoder(default_tokenizer())
    for k in range(4):
        texts = [f"a {k}" + "x" * 5000]
        assert encode(texts) == encode.whole(texts)
        assert sum(map(len, encode.cache)) + sum(map(len, encode.older)) < 6000


def test_rows_reach_the_encoder_in_small_batches(spark, odd_documents, monkeypatch):
    name, seen, stored = "spark.sql.execution.arrow.maxRecordsPerBatch", [], token_files.stored
    monkeypatch.setattr(token_files, "stored", lambda *a: (seen.append(int(spark.conf.get(name))), stored(*a))[1])
    before = spark.conf.get(name)
    assert encode_documents(odd_documents, default_tokenizer()).count() == odd_documents.count()
    assert seen and max(seen) <= 1024 and spark.conf.get(name) == before
