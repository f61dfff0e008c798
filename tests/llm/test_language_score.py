"""The network decides in the pipeline's language stage: a text of no language goes, one of two languages stays."""

from __future__ import annotations

import random

import corpus_pipeline

WORDS = {"aa": "abe bea eba aebe beab", "cc": "cid dic idci cidi dici", "ff": "fog gof ogfo fogo gofo", "hh": "huj juh ujhu huju juhu",
         "kk": "kyl lyk ylky kyly lyky"}


def _text(seed, *languages):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS[lang].split()) for lang in languages for _ in range(100 // len(languages)))


def test_texts_of_no_language_go(spark, sf_dir):
    pure = [(k, _text(k, lang), lang) for k, lang in enumerate(list(WORDS) * 20)]
    two, none = [(1000, _text(7, "aa", "cc"), None)], [(2000, _text(8, *WORDS), None), (2001, "12 34", None), (2002, None, None)]
    docs = spark.createDataFrame(pure + two + none, "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_known_languages(spark, docs, sf_dir)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(len(pure)), 1000]
