"""Compaction of the small files that a live feed leaves behind.

The stream's own log is not touched, so streams that read the table go on as they were and new ones start as before. What
changes is what batch readers see: a numbered commit names the files that were taken, and the larger ones that hold
their rows instead. ``datasets.read`` replaces the former by the latter, and reads files that came later as they are.

Only closed files are taken, that is, files written before a given time, by default the start of the day. Within a
folder of the table (a year, or the table itself) small files are packed by size into as few as hold ``target`` bytes each;
packed files that are still small are packed again together with what came since.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wellops.sinks import commits, evolution
from wellops.sinks.layout import Layout, file_system, unsorted_folders

TARGET_BYTES = 128 << 20
_MANIFEST = "kind string, path string, base string, part string, bytes long"
TAKEN, PACKED = "taken", "packed"


def _plain(uri: str) -> str:
    return unquote(uri)


def _committed(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return spark.read.schema(evolution.stored_schema(spark, layout, name)).parquet(layout.stream(name))


def _listed(spark: SparkSession, base: str) -> dict[str, tuple[str, int, int]]:
    """Folder below ``base``, bytes and time (ms) of every file, by its path as Spark names it."""
    fs, path = file_system(spark, base)
    root = _plain(fs.makeQualified(path).toUri().toString())
    found, files = {}, fs.listFiles(path, True)
    while files.hasNext():
        status = files.next()
        full = _plain(status.getPath().toUri().toString())
        part = full[len(root):].strip("/").rpartition("/")[0]
        found[_key(full)] = (part, status.getLen(), status.getModificationTime())
    return found


def _key(path: str) -> str:
    """A path without the scheme, as file systems write it with one slash or three."""
    return "/" + path.partition(":")[2].lstrip("/") if ":" in path.split("/")[0] else path


def manifest(spark: SparkSession, layout: Layout, name: str) -> tuple[int, list]:
    """The newest commit and its rows; -1 and nothing where the table was never compacted."""
    version = commits.newest(spark, layout.compaction(name))
    if version < 0:
        return -1, []
    path = commits.read(spark, layout.compaction(name), version)["path"]
    return version, spark.read.schema(_MANIFEST).parquet(path).collect()


def _read_files(spark: SparkSession, like: DataFrame, paths: list[str], base: str) -> DataFrame:
    return spark.read.schema(like.schema).option("basePath", base).parquet(*paths).select(*like.columns)


def _union(parts: list[DataFrame], like: DataFrame) -> DataFrame:
    out = like.limit(0) if not parts else parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def read(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The rows of a streaming table, from packed files where there are some."""
    table = _committed(spark, layout, name)
    version, known = manifest(spark, layout, name)
    if version < 0:
        return table
    taken = {r["path"] for r in known if r["kind"] == TAKEN}
    parts, packed = [], defaultdict(list)
    if rest := [p for uri in table.inputFiles() if _key(p := _plain(uri)) not in taken]:
        parts.append(_read_files(spark, table, rest, layout.stream(name)))
    for r in known:
        if r["kind"] == PACKED:
            packed[r["base"]].append(r["path"])
    return _union(parts + [_read_files(spark, table, paths, base) for base, paths in packed.items()], table)


def _start_of_day() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0)


def compact(spark: SparkSession, layout: Layout, name: str, before: dt.datetime | None = None,
            target: int = TARGET_BYTES, partition_by: tuple[str, ...] = ()) -> tuple[int, int] | None:
    """Pack the closed small files of a streaming table; files taken and written, or None where there was nothing to do.

    Of two compactions at a time one is committed, and the other one gives up. Rows are counted on both sides before
    the commit.
    """
    limit = (before or _start_of_day()).timestamp() * 1000
    version, known = manifest(spark, layout, name)
    table = _committed(spark, layout, name)
    taken = {r["path"] for r in known if r["kind"] == TAKEN}
    listed = _listed(spark, layout.stream(name))
    small: dict[str, list[tuple[str, str, int]]] = defaultdict(list)
    for uri in table.inputFiles():
        path = _plain(uri)
        part, size, time = listed[_key(path)]
        if _key(path) not in taken and size < target / 2 and time < limit:
            small[part].append((layout.stream(name), path, size))
    fresh = {part for part, files in small.items() if files}
    for r in known:
        if r["kind"] == PACKED and r["part"] in fresh and r["bytes"] < target / 2:
            small[r["part"]].append((r["base"], r["path"], r["bytes"]))
    small = {part: files for part, files in small.items() if len(files) > 1}
    if not small:
        return None

    by_base: dict[str, list[str]] = defaultdict(list)
    for files in small.values():
        for base, path, _ in files:
            by_base[base].append(path)
    rows = _union([_read_files(spark, table, paths, base) for base, paths in by_base.items()], table)
    bins = {part: max(1, math.ceil(sum(size for *_, size in files) / target)) for part, files in small.items()}
    packed_rows = rows.withColumn("_bin", _bin(rows, bins, partition_by))
    base = f"{layout.packed(name)}/{uuid.uuid4().hex}"
    seen = Observation(f"compaction_{uuid.uuid4().hex}")
    writer = packed_rows.repartition(sum(bins.values()), *partition_by, "_bin").observe(seen, F.count(F.lit(1)).alias("n")).drop("_bin").write
    with unsorted_folders(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(base)
    if (written := seen.get["n"]) != (found := rows.count()):
        raise RuntimeError(f"compaction of {name} wrote {written} of {found} rows")

    now = _listed(spark, base)
    made = [(PACKED, path, base, part, size) for path, (part, size, _) in now.items() if path.endswith(".parquet")]
    replaced = {path for files in small.values() for b, path, _ in files if b != layout.stream(name)}
    gone = [(TAKEN, _key(path), b, part, size) for part, files in small.items() for b, path, size in files if b == layout.stream(name)]
    kept = [tuple(r) for r in known if not (r["kind"] == PACKED and r["path"] in replaced)]
    place = f"{layout.compaction(name)}-files/{uuid.uuid4().hex}"
    spark.createDataFrame(kept + gone + made, _MANIFEST).coalesce(1).write.parquet(place)
    facts = {"path": place, "taken": len(gone), "written": len(made), "rows": written}
    if not commits.commit_at(spark, layout.compaction(name), version + 1, facts):
        return None
    return len(gone), len(made)


def _bin(rows: DataFrame, bins: dict[str, int], partition_by: tuple[str, ...]) -> Column:
    """The packed file of a row within its folder, by a hash of the row."""
    if not partition_by:
        return F.pmod(F.xxhash64(*rows.columns), F.lit(bins[""]))
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
                                for c in partition_by])
    many = {part: n for part, n in bins.items() if n > 1}
    if not many:
        return F.lit(0).cast("long")
    count = F.create_map(*[F.lit(x) for item in many.items() for x in item])
    return F.pmod(F.xxhash64(*rows.columns), F.coalesce(count[folder], F.lit(1)))
