from __future__ import annotations

import tracemalloc

import pyarrow as pa

from wellops.llm.common import utf8
from wellops.llm.decontamination import _shards, build_index, search_shard
from wellops.llm.words import NOT_ALPHANUMERIC, Hasher


def test_a_batch_of_long_texts_is_searched_in_little_memory():
    item = " ".join(f"w{k}" for k in range(12))
    texts = [f"a{k} {item} " + " ".join(f"w{(k + j) % 50}" for j in range(800)) for k in range(1024)]
    batch, index, hasher = pa.record_batch([pa.array([None, *texts])], names=["text"]), build_index([("i", item.encode())]), Hasher(NOT_ALPHANUMERIC)
    found = []
    tracemalloc.start()
    for part in _shards(batch):
        found += search_shard(index, hasher, utf8(part["text"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20, peak >> 20
    assert [f["n_words"] for f in found] == [0, *[813] * 1024] and all(f["items"] == ["i"] for f in found[1:])


def test_a_text_beyond_the_size_of_a_shard_is_whole():
    long = "x" * (3 << 20)
    parts = list(_shards(pa.record_batch([pa.array(["a", long, "b"])], names=["text"])))
    assert [t for p in parts for t in p["text"].to_pylist()] == ["a", long, "b"]
