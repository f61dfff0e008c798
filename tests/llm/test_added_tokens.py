from __future__ import annotations

import struct
import zlib

from tokenizers import Tokenizer

from wellops.llm.token_files import Encoder, default_tokenizer, encode_documents

TEXTS = ["stop <|endoftext|> here", "<|endoftext|>", "a<|endoftext|>b\nc d", "stop here", "a <|endoftext |> b"]


def test_strings_of_added_tokens_are_those_tokens(spark):
    plain = Tokenizer.from_file(default_tokenizer())
    ids = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert ids[0] == [11338, 220, 50256, 994]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = sorted(encode_documents(docs, default_tokenizer()).collect())
    start = 0
    for row, own in zip(got, ids):
        own = [*own, 2]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)))
        start += len(own)
    assert len(got) == len(TEXTS)


def test_caller_may_escape_them():
    escaping = Tokenizer.from_file(default_tokenizer())
    escaping.encode_special_tokens = True
    ids = [escaping.encode(t, add_special_tokens=False).ids for t in TEXTS]
    wanted = [struct.pack(f"<{len(own)}I", *own) for own in ids]
    assert Encoder(default_tokenizer(), escape=True)(TEXTS) == wanted
    assert len(wanted[0]) == 4 * 9
