from __future__ import annotations

import numpy as np

from wellops.llm import gru
from wellops.llm.language_id import accepted, crc_bucket, fit, op9_language_id, pooled, predict


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    params = {k: v.astype(float) for k, v in gru.initial(5, 3, rng).items()}
    rows, size = rng.integers(0, 256, (4, 7)).astype(np.uint8), np.array([7, 3, 1, 5])
    labels = np.array([0, 2, 1, 1])
    _, grads = gru.loss_and_gradients(params, rows, size, labels)
    for name, values in params.items():
        for place in [tuple(rng.integers(0, s) for s in values.shape) for _ in range(4)] + (
                [(int(rows[0, 1]), 1), (int(rows[3, 4]), 0)] if "_in_" in name else []):
            kept, step = values[place], 1e-5
            values[place] = kept + step
            above = gru.loss_and_gradients(params, rows, size, labels)[0]
            values[place] = kept - step
            below = gru.loss_and_gradients(params, rows, size, labels)[0]
            values[place] = kept
            assert abs((above - below) / (2 * step) - grads[name][place]) < 1e-5 + 1e-3 * abs(grads[name][place])


def test_inference_equals_the_forward_pass_of_training():
    rng = np.random.default_rng(1)
    params = gru.initial(6, 4, rng)
    rows, size = rng.integers(0, 256, (5, 9)).astype(np.uint8), np.array([9, 9, 2, 1, 6])
    p = gru.position_probabilities(params, rows, size).transpose(2, 1, 0)
    ahead, behind = gru._forward(params, "f", rows, size), gru._forward(params, "b", rows, size)
    logits = np.stack([s[-1] @ params["f_out"] for s in ahead], 1) + np.stack([s[-1] @ params["b_out"] for s in behind[::-1]], 1)
    e = np.exp(logits + params["bias"])
    wanted = e / e.sum(axis=2, keepdims=True) * (np.arange(9) < size[:, None])[:, :, None]
    assert np.allclose(p, wanted, atol=1e-5)


def test_every_byte_is_in_one_segment():
    texts = [b"", b"abc", b"x" * 10, b"", b"0123456789abcdef"]
    rows, size, owner = gru.segments(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), 4)
    for k, text in enumerate(texts):
        assert b"".join(rows[i, :size[i]].tobytes() for i in np.flatnonzero(owner == k)) == text


def test_held_out_accuracy(spark, sf_dir, documents):
    got = op9_language_id(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == documents.count()
    seen = got.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in seen) >= 0.97 * len(seen)
    assert all(0.0 <= r["score"] <= 1.0 for r in seen)


def test_odd_documents(spark, odd_documents, documents):
    model = fit(documents.filter(crc_bucket(4) != 2), per_label=100)
    rows = predict(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and rows[0].asDict().keys() >= {"doc_id", "hits", "cls", "lang_pred", "score"}
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0.0)
    kept = accepted(odd_documents, model, min_score=0.0)
    assert kept.schema == odd_documents.schema and kept.count() == sum(r["lang_pred"] != "und" for r in rows)
    assert predict(odd_documents.limit(0), model).count() == 0
    assert fit(odd_documents.limit(0)) is None
    assert {r["lang_pred"] for r in predict(odd_documents, None).collect()} == {"und"}


def test_all_bytes_of_a_long_text_count(documents):
    model = fit(documents, per_label=100)
    texts = {r["lang"]: r["text"].encode() for r in documents.filter("n_chars > 500").collect()}
    two = [texts["de"] * 3 + texts["fr"] * 50, texts["fr"] * 3 + texts["de"] * 50]
    assert [model.labels[k] for k in pooled(model, two).argmax(axis=1)] == ["fr", "de"]


def test_sample_is_of_distinct_texts(spark):
    """A text that repeats very often neither crowds out others nor grows the sample, whichever way its hash falls."""
    from wellops.llm.language_id import _excerpts
    german = [("de", f"der Text Nummer {k} steht hier im Buch") for k in range(60)]
    english = [("en", f"the text number {k} is here in the book") for k in range(60)]
    plain = spark.createDataFrame(german + english, "lang string, text string")
    wanted = _excerpts(plain, 400, 2, 64)
    assert {lang for lang, _ in wanted} == {"de", "en"} and len(wanted) == 240
    for k in range(4):
        copies = spark.range(5_000).selectExpr("'de' AS lang", f"'der Text Nummer {k} steht hier im Buch' AS text")
        assert _excerpts(plain.union(copies), 400, 2, 64) == wanted
    some = _excerpts(plain, 20, 1, 64)
    assert {lang for lang, _ in some} == {"de", "en"} and 10 <= len(some) <= 80
