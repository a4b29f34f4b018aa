"""Table writes for the layered warehouse (plain Parquet, no MERGE).

All warehouse tables are versioned (``sinks.versions``): a step writes its
files once and publishes them by reference, together with what they
replace. Large keyed tables are ``BucketedTable``: partitioned by ``bucket
= pmod(xxhash64(keys), n_buckets)``, and by segment (open or closed rows)
where rows get closed. A run rewrites only the open rows of buckets that
hold a replaced key; closed rows are only ever appended.

``BucketedTable.lookup`` finds the rows that may have one of some keys: the
buckets of the keys first, then a Bloom filter of the keys of every file,
kept beside the data, so files without a match are not opened.

What a run has completed is told by a commit record (``commit``), written
last, and not by the rows a crashed run may have left behind.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.sinks.versions import (RUN, Manifest, Part, VersionedTable, fs_of as _fs,
                                       read_text as _read_text, with_fields)

BUCKET, SEGMENT = "bucket", "segment"
OPEN, CLOSED = "open", "closed"


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


SCHEMA_FILE = "_schema.json"


def has_data(spark: SparkSession, path: str) -> bool:
    """True when the table folder holds a Parquet file (flat or one
    partition level deep)."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    for pattern in ("/*.parquet", "/*=*/*.parquet"):
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + pattern))
        if found is not None and len(found) > 0:
            return True
    return False


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Rename that fails loudly (the file system's own returns False)."""
    fs, a = _fs(spark, src)
    if not fs.rename(a, _fs(spark, dst)[1]):
        raise OSError(f"could not rename {src} to {dst}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: readers see the old or the new text,
    or for a moment none."""
    fs, p = _fs(spark, path)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.create(_fs(spark, tmp)[1], True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    rename(spark, tmp, path)


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    text = _read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    return None if text is None else StructType.fromJson(json.loads(text))


def table_at(spark: SparkSession, path: str) -> VersionedTable | None:
    """The versioned table at a path, with the levels that its manifest names."""
    m = VersionedTable(spark, path).manifest()
    return None if m is None else VersionedTable(spark, path, m.levels)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table (its newest version), or None before its first write. A
    folder without versions (an export) is read with its stored schema, if
    it has one: files that are older than a column give NULL for it, and a
    table without rows is typed."""
    if not exists(spark, path):
        return None
    t = table_at(spark, path)
    if t is not None:
        return t.read()
    schema, filled = stored_schema(spark, path), has_data(spark, path)
    if not filled:
        return None if schema is None else spark.createDataFrame([], schema)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


COMMITS = "_commits"


def commit(spark: SparkSession, path: str, name: str, value: str) -> None:
    """Record what a run has completed. A record that is missing (a crash
    while it is replaced) means that nothing is known to be complete."""
    base = f"{path.rstrip('/')}{COMMITS}"
    fs, p = _fs(spark, base)
    fs.mkdirs(p)
    _write_text(spark, f"{base}/{name}", value)


def committed(spark: SparkSession, path: str, name: str) -> str | None:
    return _read_text(spark, f"{path.rstrip('/')}{COMMITS}/{name}")


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


def overwrite(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace a whole table (or create it)."""
    VersionedTable(spark, path).overwrite(df)


def append(df: DataFrame, path: str) -> None:
    """Add rows (or create the table). New columns extend its schema."""
    VersionedTable(df.sparkSession, path).append(df)


def remember_schema(df: DataFrame, path: str) -> None:
    """Keep the schema next to the data of a plain folder (``_schema.json``
    is ignored by readers): what was known plus the new columns of ``df``."""
    spark = df.sparkSession
    old = stored_schema(spark, path)
    if old is None and has_data(spark, path):
        old = spark.read.parquet(path).schema
    new = with_fields(old, df.schema)
    if old is None or len(new) > len(old):
        fs, p = _fs(spark, path)
        fs.mkdirs(p)
        _write_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", new.json())


# --------------------------------------------------------------- filters ---

# The filters are the warehouse's only Python work in tasks; their functions
# travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOOMS = "_blooms"
#: Keys in one Bloom filter (a larger file has several), bits a key, and probes.
BLOOM_KEYS, BLOOM_BITS, BLOOM_PROBES = 1 << 20, 10, 6


def _probes(hashes: np.ndarray, n_bits: int) -> Iterator[np.ndarray]:
    h = hashes.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(BLOOM_PROBES):
        yield ((low + np.uint64(i) * high) % np.uint64(n_bits)).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(64, -(-BLOOM_BITS * len(hashes) // 8) * 8), np.uint8)
    for at in _probes(hashes, len(bits)):
        bits[at] = 1
    return np.packbits(bits).tobytes()


def may_hold(filter_bits: bytes, hashes: np.ndarray) -> bool:
    """Whether any of the hashes may be in the filter (never False for one that is)."""
    bits = np.frombuffer(filter_bits, np.uint8)
    some = np.ones(len(hashes), bool)
    for at in _probes(hashes, len(bits) * 8):
        some &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return bool(some.any())


def _bloom_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, file, bits) of keys that stream by, a filter per file and BLOOM_KEYS keys."""
    held: dict[tuple[int, str], list[np.ndarray]] = {}

    def out(keys):
        made = [(b, f, bloom(np.concatenate(held.pop((b, f))))) for b, f in keys]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.int32(), pa.string(), pa.binary()))],
                                          names=["bucket", "file", "bits"])

    for batch in batches:
        files = batch.column("file").dictionary_encode()
        names, codes = files.dictionary.to_pylist(), files.indices.to_numpy()
        hashes, buckets = batch.column("h").to_numpy(), batch.column("bucket").to_numpy()
        for i, name in enumerate(names):
            mine = codes == i
            held.setdefault((int(buckets[mine][0]), name), []).append(hashes[mine])
        full = [k for k, v in held.items() if sum(map(len, v)) >= BLOOM_KEYS]
        if full:
            yield out(full)
    if held:
        yield out(list(held))


def _files_hit(keys: pa.Table, filters: pa.Table) -> pa.Table:
    hashes = keys.column("h").to_numpy()
    hit = {f for f, b in zip(filters.column("file").to_pylist(), filters.column("bits").to_pylist())
           if len(hashes) and may_hold(b, hashes)}
    return pa.table({"file": pa.array(sorted(hit), pa.string())})


@dataclass
class Lookup:
    """Rows that may have a key, and how many files were opened for them:
    of the table, of the buckets of the keys, and read."""

    rows: DataFrame | None
    files: int
    files_in_buckets: int
    files_read: int


class BucketedTable(VersionedTable):
    """A keyed table hash-partitioned into ``n_buckets``; with ``segments``,
    rows carry a segment (open or closed) that is a folder level too.
    ``filters``: whether a Bloom filter of the keys of every open file is kept."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], n_buckets: int = 64,
                 segments: bool = False, filters: bool = True):
        super().__init__(spark, path, {SEGMENT: "string", BUCKET: "int"} if segments else {BUCKET: "int"})
        self.keys, self.n, self.segments, self.filters = list(keys), n_buckets, segments, filters

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df if BUCKET in df.columns else df.withColumn(BUCKET, bucket_of(self.keys, self.n))

    def is_open(self, part: Part) -> bool:
        return not self.segments or self.value(part, SEGMENT) == OPEN

    def bucket(self, part: Part) -> int:
        return int(self.value(part, BUCKET))

    def write(self, df: DataFrame, base: Manifest | None) -> str:
        df = self.with_bucket(df)
        if self.segments and SEGMENT not in df.columns:
            df = df.withColumn(SEGMENT, F.lit(OPEN))
        run = super().write(df, base)
        if self.filters:                                      # before the run is published
            names = [f for p in self.parts_of(run) if self.is_open(p) for f in self.paths(p)]
            if names:
                rows = self.spark.read.schema(df.schema).option("basePath", f"{self.path}/{RUN}={run}").parquet(*names)
                rows = rows.select(BUCKET, F.xxhash64(*self.keys).alias("h"), F.concat(F.lit(f"{RUN}="), F.substring_index(
                    F.col("_metadata.file_path"), f"/{RUN}=", -1)).alias("file"))
                rows.mapInArrow(_bloom_rows, "bucket int, file string, bits binary") \
                    .write.parquet(f"{self.path}/{BLOOMS}/{RUN}={run}")
        return run

    def rewrite(self, touched: Sequence[int], content: DataFrame) -> None:
        """Replace the (open) rows of the listed buckets with ``content``,
        which must hold the complete new rows of exactly those buckets."""
        if not touched:
            return
        some = set(touched)
        content = self.with_bucket(content).where(F.col(BUCKET).isin(list(touched)))
        self.change(content, drop=lambda p: self.is_open(p) and self.bucket(p) in some)

    def lookup(self, keys: DataFrame, manifest: Manifest | None = None) -> Lookup:
        """The (open) rows that may have one of ``keys`` (a written table
        with the key columns and their bucket)."""
        m = manifest or self.manifest()
        opened = [p for p in m.parts if self.is_open(p)] if m else []
        buckets = set(touched_buckets(keys)) if opened else set()
        parts = [p for p in opened if self.bucket(p) in buckets]
        total, near = sum(len(p.files) for p in opened), {f for p in parts for f in self.paths(p)}
        if self.filters and near:
            runs = sorted({p.run for p in parts})
            filters = self.spark.read.schema("bucket int, file string, bits binary") \
                .parquet(*[f"{self.path}/{BLOOMS}/{RUN}={r}" for r in runs]).where(F.col(BUCKET).isin(sorted(buckets)))
            hashed = keys.select(BUCKET, F.xxhash64(*self.keys).alias("h"))
            hit = hashed.groupBy(BUCKET).cogroup(filters.groupBy(BUCKET)).applyInArrow(_files_hit, "file string")
            near &= {f"{self.path}/{r[0]}" for r in hit.distinct().collect()}      # at most a name a file
        rows = self.read(m, keep=lambda p: self.is_open(p) and self.bucket(p) in buckets, files=near) if near else None
        return Lookup(rows, total, sum(len(p.files) for p in parts), len(near))

    def expire(self, keep: int | None = None, orphan_s: float | None = None) -> list[str]:
        given = {k: v for k, v in (("keep", keep), ("orphan_s", orphan_s)) if v is not None}
        gone = super().expire(**given)
        runs = {p.run for v in self.versions() for p in self.manifest(v).parts}
        fs, root = _fs(self.spark, f"{self.path}/{BLOOMS}")
        for name in [f[len(self.path) + 1:] for f in gone]:
            if "/" not in name and name.split("=", 1)[1] not in runs:
                fs.delete(_fs(self.spark, f"{self.path}/{BLOOMS}/{name}")[1], True)
        return gone


def files_per_bucket(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Files (below the table) of each bucket, from the manifest."""
    t = table_at(spark, path)
    found: dict[int, list[str]] = {}
    for p in t.manifest().parts if t else ():
        for f in t.paths(p):
            found.setdefault(int(t.value(p, BUCKET)), []).append(f[len(t.path) + 1:])
    return found


def compact(table: "BucketedTable", max_files: int = 32) -> list[tuple[str, ...]]:
    """Write every (segment,) bucket of more than ``max_files`` files anew
    with few; appends of many runs otherwise leave many small files.
    Returns the level values of the compacted ones."""
    m = table.manifest()
    count: dict[tuple, int] = {}
    for p in m.parts if m else ():
        count[p.values] = count.get(p.values, 0) + len(p.files)
    crowded = {v for v, n in count.items() if n > max_files}
    if crowded:
        inside: Callable[[Part], bool] = lambda p: p.values in crowded
        table.change(table.read(m, keep=inside), drop=inside, base=m)
    return sorted(crowded)


def touched_buckets(df: DataFrame) -> list[int]:
    """Distinct bucket ids of ``df`` (at most ``n_buckets`` small ints reach
    the driver; used for partition pruning by literal IN-list)."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())
