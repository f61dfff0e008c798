"""Token ids as independent zstandard frames with a trailing seek table and a checksum per frame.

Layout of one file (the public "seekable format" of zstandard, readable by any zstandard decoder):

    frame 0 .. frame n-1   each an ordinary zstandard frame with the ids of one document, uint32 little-endian
    skippable frame        magic 0x184D2A5D: n document ids, int64 little-endian, then n bits, set where there is an id
    skippable frame        magic 0x184D2A5E: the seek table, one entry per frame of
                           compressed size, decompressed size, checksum (uint32 each), then the footer
                           frame count (uint32), descriptor 0x80 (checksums present), magic 0x8F92EAB1

The checksum is the low half of the 64-bit xxHash of the decompressed frame. A document of more than
``MAX_FRAME`` bytes takes several frames in a row under the same document id; a frame never holds two
documents, so a reader decompresses exactly what it was asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard

# Fixed values of the public format.
ID_MAGIC = 0x184D2A5D
TABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
FOOTER_BYTES = 9
ENTRY_BYTES = 12

MAX_FRAME = 64 << 20


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


# Names that Hadoop gives to file systems pyarrow knows under another one.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, mark, rest = path.partition("://")
    if not mark and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    try:
        return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}" if mark else path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as e:
        raise ValueError(f"token files cannot be written to {path}: pass a folder on a file system that pyarrow reaches ({e})") from e


class Writer:
    """Writes one file under a temporary name and renames it at ``close``, so a lost task leaves no half file."""

    def __init__(self, path: str, attempt: str, level: int = 3):
        self.fs, self.path = open_fs(path)
        self.temporary = f"{self.path}.{attempt}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temporary)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.doc_ids: list[int | None] = []
        self.entries: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        for start in range(0, len(raw) + 1, MAX_FRAME):  # ends with a frame that is not full
            part = raw[start:start + MAX_FRAME]
            frame = self.compressor.compress(part)
            self.out.write(frame)
            self.doc_ids.append(doc_id)
            self.entries.append((len(frame), len(part), _checksum(part)))

    def close(self) -> None:
        known = np.array([d is not None for d in self.doc_ids], bool)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + np.packbits(known).tobytes()
        table = np.asarray(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", ID_MAGIC, len(ids)) + ids)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(self.temporary, self.path)


class Reader:
    """Reads the seek table, then only the frames of the documents asked for. Raises on a wrong checksum."""

    def __init__(self, path: str):
        self.fs, self.path = open_fs(path)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        count, descriptor, magic = struct.unpack("<IBI", self._at(size - FOOTER_BYTES, FOOTER_BYTES))
        if magic != SEEK_MAGIC or descriptor != CHECKSUMS:
            raise ValueError(f"{path}: no seek table with checksums")
        table = size - FOOTER_BYTES - ENTRY_BYTES * count
        self.entries = np.frombuffer(self._at(table, ENTRY_BYTES * count), "<u4").reshape(count, 3)
        length = 8 * count + (count + 7) // 8
        ids = table - 8 - length
        raw = self._at(ids, length)
        known = np.unpackbits(np.frombuffer(raw[8 * count:], np.uint8), count=count).astype(bool)
        self.doc_ids = [d if k else None for d, k in zip(np.frombuffer(raw[:8 * count], "<i8").tolist(), known.tolist())]
        self.starts = np.concatenate(([0], np.cumsum(self.entries[:, 0], dtype=np.int64)))[:count]
        if struct.unpack("<II", self._at(ids - 8, 8)) != (ID_MAGIC, length):
            raise ValueError(f"{path}: no document ids")
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def frame(self, k: int) -> bytes:
        packed, length, checksum = map(int, self.entries[k])
        raw = self.decompressor.decompress(self._at(int(self.starts[k]), packed), max_output_size=max(1, length))
        if len(raw) != length or _checksum(raw) != checksum:
            raise ValueError(f"{self.path}: frame {k} fails its checksum")
        return raw

    def tokens(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every stored document of that number (repeated rows are stored repeatedly).

        Frames of a long document are joined: all but the last of them are full.
        """
        found, parts = [], []
        for k in (k for k, d in enumerate(self.doc_ids) if d == doc_id):
            parts.append(self.frame(k))
            if len(parts[-1]) < MAX_FRAME:
                found.append(np.frombuffer(b"".join(parts), "<u4"))
                parts = []
        return found

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        """Every document in file order, one in memory at a time."""
        parts: list[bytes] = []
        for k, doc_id in enumerate(self.doc_ids):
            parts.append(self.frame(k))
            if len(parts[-1]) < MAX_FRAME:
                yield doc_id, b"".join(parts)
                parts = []
