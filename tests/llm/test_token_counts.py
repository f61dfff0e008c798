from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest

from wellops.llm.token_counts import Counter, default_tokenizer, n_tokens, op11_token_counts, token_counts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def library(path):
    """Counts of single texts by the plain call of the library."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def wanted(rows, count, limit=512):
    out = [(i, len((t or "").encode()), count(t or "")) for i, t in rows]
    return sorted([(*r, r[2] > limit) for r in out], key=str)


def test_query_against_the_library(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = op11_token_counts(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert sorted(map(tuple, got.collect()), key=str) == wanted(rows, library(default_tokenizer()))


@pytest.mark.parametrize("file", FILES)
def test_odd_documents(spark, odd_documents, file):
    path = public_tokenizers.path(file)
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    clashing = odd_documents.withColumnsRenamed({"score": "n_tokens", "hits": "n_bytes", "cls": "over_limit"})
    assert sorted(map(tuple, token_counts(clashing, path).collect()), key=str) == wanted(rows, library(path))
    assert token_counts(odd_documents.limit(0), path).count() == 0
    other = odd_documents.select(n_tokens("lang", path).alias("n"), "lang")
    assert sorted(r["n"] for r in other.collect()) == sorted(library(path)(r["lang"] or "") for r in other.select("lang").collect())


@pytest.mark.parametrize("file", FILES)
def test_pieces_add_up_for_any_text(file):
    path = public_tokenizers.path(file)
    counter, count, rng = Counter(path), library(path), random.Random(5)
    assert counter.boundary is not None
    parts = ["a", "the", "I'll", "don't", "'s", " ", " ", " ", "  ", "\n", "\n\n", "\t", " ", "　", "​", "\x1c", "▁", "▁▁",
             "é", "é", "́", "日本", "🙂", "12", "3", "...", "<|endoftext|>", "<s>", "Ünï", "ﬁ", "x" * 40, "\r\n", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]
    exact = [count(t) for t in texts]
    for limit, batch in ((1, 1), (7, 64), (25, 1 << 20)):
        assert counter(pa.array(texts), batch, limit).tolist() == exact


def test_batches_hold_about_equal_bytes():
    counter = Counter(default_tokenizer())
    seen, plain = [], counter.lengths
    counter.lengths = lambda texts: seen.append(sum(len(t.encode()) for t in texts)) or plain(texts)
    texts = ["word " * n for n in (1, 20_000, 3, 500, 7, 2, 40_000)] + [None, ""] + ["é" * 30] * 5_000
    total = counter(pa.array(texts), 20_000, 1_000)
    count = library(default_tokenizer())
    assert total.tolist() == [count(t or "") for t in texts]
    assert max(seen) <= 20_000 and min(seen[:-1]) > 15_000


def test_a_text_without_boundaries_is_counted_whole():
    counter = Counter(default_tokenizer())
    text = "abc　" * 30_000
    assert list(counter.pieces(text, 100)) == [text]
    assert counter(pa.array([text])).tolist() == [library(default_tokenizer())(text)]
