"""Token ids of whole texts, written as independent zstandard frames with a trailing seek table.

Documents are range-partitioned by id, so file k holds smaller ids than file k + 1 and the files in
order are the documents in ascending order. A task tokenizes and writes its range in one pass and holds
a small Arrow batch at a time, which is split into words and put together again by columns. Reading back goes file
by file, each in a task of its own.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellops.llm.common import in_worker, scratch, ship, small_batches, stored, table, worker_cache
from wellops.llm.seekable import Reader, Writer, open_fs

END_ID = 2
VOCABULARY = "byte_bpe_50k.json"

_BATCH_BYTES = 4 << 20
_BATCH_ROWS = 1024
# Of each of the two halves of the cache.
_CACHE_ENTRIES = 1 << 18
_CACHE_CHARS = 1 << 23
_MISSES_AT_ONCE = 512
# A piece that is empty, or has a blank at either end or beside another one: texts with such are encoded whole.
_NOT_A_PIECE = re.compile(r"^\Z|\s\s|^\s|\s\Z")


class Encoder:
    """Ids of texts as little-endian uint32 bytes, through a bounded cache of pieces.

    Byte-level pre-tokenization always starts a new token at a single space or newline between two other
    characters, and merges never cross that place. So a text is the sequence of its pieces " word" and
    "\\nword", and a distinct piece is encoded by the tokenizer once, as long as the cache holds it. A full cache
    becomes the older half, which keeps what is asked for again. Texts with blanks in a row or the string
    of an added token, and tokenizers of another kind, go to the tokenizer whole. With ``escape`` the strings
    of special tokens are ordinary text; by default they are those tokens, as the library has it.
    """

    def __init__(self, path: str, escape: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = escape
        self.by_piece = type(self.tokenizer.pre_tokenizer) is ByteLevel and self.tokenizer.normalizer is None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # The ids of a piece, empty for what is not one.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        if self.by_piece:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.begins = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in " \n"}
            for token, k in vocabulary.items():
                if token[:1] in "ĠĊ" and token:
                    self.begins[" " if token[0] == "Ġ" else "\n"][k] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str], blank: str) -> None:
        """Encode pieces, joined so that one call serves many of them."""
        lead = " " if blank == " " else ""
        for start in range(0, len(pieces), _MISSES_AT_ONCE):
            part = pieces[start:start + _MISSES_AT_ONCE]
            raw = self.whole([lead + lead.join(part)])[0]
            starts = np.flatnonzero(self.begins[blank][np.frombuffer(raw, "<u4")]) * 4
            if len(starts) == len(part):
                ends = np.append(starts[1:], len(raw))
                self.cache.update((p, raw[a:b]) for p, a, b in zip(part, starts.tolist(), ends.tolist()))
            else:  # a token of this vocabulary begins with a blank elsewhere
                self.cache.update(zip(part, self.whole([lead + p for p in part])))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces, empty for what is not one."""
        if len(self.cache) > _CACHE_ENTRIES or self.held > _CACHE_CHARS:
            self.older = self.cache if self.held <= _CACHE_CHARS else {}  # very long pieces are not kept
            self.cache, self.held = {}, 0
        known = list(map(self.cache.get, pieces))
        absent = [p for p, ids in zip(pieces, known) if ids is None]
        self.held += sum(map(len, absent))
        missing: dict[str, list[str]] = {" ": [], "\n": []}
        for piece in absent:
            ids = self.older.get(piece)
            word = piece.removeprefix("\n")
            if ids is not None:
                self.cache[piece] = ids
            elif word.split() != [word] and _NOT_A_PIECE.search(word):
                self.cache[piece] = b""
            else:
                missing["\n" if piece[0] == "\n" else " "].append(piece)
        for blank, part in missing.items():
            self._learn(part, blank)
        return [self.cache[p] if ids is None else ids for p, ids in zip(pieces, known)]

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not self.by_piece:
            return self.whole(texts.to_pylist())
        whole = np.zeros(len(texts), bool)
        for added in self.added:
            whole |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~whole)
        joined = self._joined(texts.take(pa.array(rest))) if len(rest) else []
        found = dict(zip(rest.tolist(), joined))
        return [self.whole([texts[k].as_py()])[0] if found.get(k) is None else found[k] for k in range(len(texts))]

    def _joined(self, texts: pa.Array) -> list[bytes | None]:
        """The ids of texts from those of their pieces, None for texts that have something else."""
        newline = pa.scalar("\n", texts.type)
        split = pc.split_pattern(
            pc.binary_join_element_wise(newline, pc.replace_substring(texts, "\n", " \n"), pa.scalar("", texts.type)), " ")
        pieces = split.values.dictionary_encode()
        known = self._pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        firsts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(known), "<u4")
        which, begins = pieces.indices.to_numpy(), split.offsets.to_numpy()
        long = sizes[which]
        ends = np.concatenate(([0], np.cumsum(long)))
        places = np.repeat(firsts[which] - ends[:-1], long)
        places += np.arange(len(places))
        ids, ends = ids[places], ends[begins]
        unlike = np.logical_or.reduceat(long == 0, begins[:-1])
        # The newline put before the first word is one id.
        return [None if u else ids[a + 1:b].tobytes() for a, b, u in zip(ends[:-1].tolist(), ends[1:].tolist(), unlike.tolist())]


def _encoder(path: str, escape: bool) -> Encoder:
    kept = worker_cache("token_files")
    if (path, escape) not in kept:
        kept[path, escape] = Encoder(path, escape)
    return kept[path, escape]


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, escape: bool = False) -> DataFrame:
    """Tokenize every text of ``docs`` (doc_id, text) into files below ``folder``; returns the manifest.

    Manifest: file, n_docs, n_tokens, first_id, one row per file. A null text is empty and a document without
    text is its end id alone. Rows without a doc_id come first and are read back without one. Repeated rows and
    rows with the same id are all written, next to each other in the order of a hash of their texts. An empty table gives no file.
    Columns other than the two are ignored. For ``escape`` see ``Encoder``. A task that is run again replaces its own file.
    """
    spark = docs.sparkSession
    ship(spark)
    open_fs(folder)  # fails here, not in a task, where the file system is not one that tasks can write to
    end = struct.pack("<I", end_id)

    @in_worker("token_files")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        file, writer, n_tokens = f"{folder}/part-{context.partitionId():06d}.ids.zst", None, 0
        encode = _encoder(tokenizer_path, escape)
        for batch in batches:
            step = max(1, batch.num_rows * _BATCH_BYTES // max(_BATCH_BYTES, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                for doc_id, raw in zip(part["doc_id"].to_pylist(), encode(part["text"])):
                    writer = writer or Writer(file, f"attempt-{context.taskAttemptId()}")
                    writer.add(doc_id, raw + end)
                    n_tokens += len(raw) // 4 + 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"file": file, "n_docs": len(writer.doc_ids), "n_tokens": n_tokens,
                                               "first_id": writer.doc_ids[0]}], schema=_MANIFEST)

    # The hash and the row number spread a frequent id over several files.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = ["doc_id", "_hash", "_row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "text").mapInArrow(
        write, "file string, n_docs long, n_tokens long, first_id long")


_MANIFEST = pa.schema([("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_id", pa.int64())])


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per stored document, read back from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Every frame's checksum is verified.
    """
    spark = manifest.sparkSession
    ship(spark)

    @in_worker("token_files")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids_crc32", pa.int64())])
        for batch in batches:
            for file, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist()):
                rows: list[tuple[int, int, int, int]] = []
                for doc_id, raw in Reader(file).documents():
                    rows.append((doc_id, start, len(raw) // 4, zlib.crc32(raw)))
                    start += len(raw) // 4
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    # One row per file: the running sum of the files' token counts is all that passes through one task.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file", "start").repartition(parts, "file").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer_path: str, folder: str | None = None, escape: bool = False) -> DataFrame:
    """Write the files below ``folder`` (a new one by default), read them back and describe each document."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token_files")
    with small_batches(spark, _BATCH_ROWS):
        manifest = stored(write_tokens(docs, f"{folder}/files", tokenizer_path, escape=escape), folder, "manifest")
    return read_tokens(manifest)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), default_tokenizer())
