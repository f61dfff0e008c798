"""Token counts of whole texts: batch encoding in an Arrow function that returns lengths only.

The ids never leave the tokenizer's call, so a text costs eight bytes on its way back to Spark. Inside the function the
texts of an Arrow batch are dealt into encoder batches of about equal bytes: one call gets many short texts or a
few long ones. A text of more than ``PIECE_CHARS`` characters is cut at safe boundaries first, places where the
tokenizer starts a new token whatever stands beside them, so that the lengths of the pieces add up to the
length of the text and no call holds the tokens of a very long text at once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import ship, table

VOCABULARY = "byte_bpe_50k.json"
MAX_TOKENS = 512
BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16

# One blank between two characters that are none. The second pattern also takes the blank that sentence pieces use.
_SAFE_BLANK = re.compile(r"(?<=\S)[ \n](?=\S)")
_SAFE_SPACE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_COUNTERS: dict[str, Counter] = {}


def _boundary(pre_tokenizer: dict | None, normalizer: dict | None) -> re.Pattern | None:
    """Where a text may be cut for a tokenizer of the tokenizers library; None if that is not known."""
    if not pre_tokenizer:
        return None
    if pre_tokenizer["type"] == "ByteLevel":
        # Words take one blank before them; blanks in a row are treated apart, so those stay together.
        plain = pre_tokenizer.get("use_regex", True) and not pre_tokenizer.get("add_prefix_space", True)
        return _SAFE_BLANK if plain and normalizer is None else None
    if pre_tokenizer["type"] == "Sequence":
        first, *rest = pre_tokenizer["pretokenizers"]
        pattern = first.get("pattern", {}).get("Regex", " ")
        # Only what the pattern finds is kept, and it finds no blanks.
        drops_blanks = first.get("behavior") == "Removed" and first.get("invert") and not re.search(
            r"\s|\\s", pattern.replace(r"[^\s", "["))
        level = all(r["type"] == "ByteLevel" and not r.get("use_regex", True) and not r.get("add_prefix_space", True) for r in rest)
        return _SAFE_SPACE if drops_blanks and level else None
    return None


class Counter:
    """Numbers of tokens as the library of ``path`` gives them, without begin, end or added special tokens.

    A ``.json`` file is read by tokenizers, where the string of a special token in a text is that token, and a ``.model`` file
    by sentencepiece, where it is ordinary text: the defaults of both. Nothing is cut off or padded.
    """

    def __init__(self, path: str):
        self.boundary: re.Pattern | None = None
        self.dropped = 0  # characters that the start of a piece stands for, at a cut
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.lengths: Callable[[list[str]], list[int]] = lambda texts: list(map(len, model.encode(texts, num_threads=1)))
            pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
            if model.encode("a", out_type=str)[:1] == ["▁a"] and not any("▁" in p[1:] and p.strip("▁") for p in pieces):
                self.boundary, self.dropped = _SAFE_SPACE, 1
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda texts: list(map(len, model.encode_batch_fast(texts, add_special_tokens=False)))
            with open(path, encoding="utf-8") as f:
                settings = json.load(f)
            if not any(" " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"]
                       for t in settings.get("added_tokens") or []):
                self.boundary = _boundary(settings.get("pre_tokenizer"), settings.get("normalizer"))

    def pieces(self, text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
        """``text`` in parts of at least ``limit`` characters, each up to the next safe boundary."""
        start = 0
        while self.boundary and len(text) - start > limit and (cut := self.boundary.search(text, start + limit)):
            yield text[start:cut.start()]
            start = cut.start() + self.dropped
        yield text[start:] if start else text

    def __call__(self, texts: pa.Array, batch_bytes: int = BATCH_BYTES, limit: int = PIECE_CHARS) -> np.ndarray:
        """The number of tokens of each text; a null text is empty."""
        total = np.zeros(len(texts), np.int64)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        owners: list[int] = []
        batch: list[str] = []
        held = 0

        def count() -> None:
            np.add.at(total, owners, self.lengths(batch))
            owners.clear()
            batch.clear()

        for k in np.flatnonzero(sizes).tolist():
            text = texts[k].as_py()
            for piece in self.pieces(text, limit):
                size = int(sizes[k]) if len(piece) == len(text) else len(piece.encode())
                if batch and held + size > batch_bytes:
                    count()
                    held = 0
                owners.append(k)
                batch.append(piece)
                held += size
        if batch:
            count()
        return total


def _counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def n_tokens(text: Column | str, tokenizer_path: str) -> Column:
    """The number of tokens of a text column, null as empty. The file must be at the same path on every executor."""
    ship(SparkSession.active())

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(tokenizer_path)
        for texts in batches:
            yield pa.array(counter(texts), pa.int64())

    # The annotations are text in this module, so the function names its kind itself.
    count.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(count, "long")(text)


def token_counts(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    A null or empty text has no bytes and no tokens; texts of blanks have what the library gives for them. Texts of
    any length are counted whole: long ones in pieces, or in one call where the tokenizer is not known to have safe
    boundaries, or a text has none. Repeated rows and ids, and null ids, are counted row by row. Other columns are
    ignored, whatever their names. An empty table gives an empty result. Nothing is shuffled.
    """
    text = F.col("text").cast("string")
    counted = docs.select(F.col("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                          n_tokens(text, tokenizer_path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), default_tokenizer())
