"""Helpers shared by the training-data operators.

Durable intermediates go to the folder named by ``spark.checkpoint.dir``
(through ``session.work_dir``), so a lost executor never loses them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import work_dir

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python worker holds at once (one longer text is a block of its own).
BLOCK_BYTES = 8 << 20
#: Spark's setting that removes the shuffle files of a query when it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: a durable
    lineage cut that survives lost executors. With ``tidy`` the shuffle files
    of the write go with it, not when the driver next collects its garbage."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    before = spark.conf.get(TIDY, None)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a
    task, and what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                         # another C library
        pass


def freed(run: Callable, *args):
    """The result of ``run``; what else it held is given back. (A call of
    ``give_back`` within a function comes before its variables are gone.)"""
    try:
        return run(*args)
    finally:
        give_back()


@lru_cache(maxsize=1)
def one_blas_thread() -> None:
    """Let numpy's matrix products use one thread. Spark's tasks already use
    every core; the products here are small, and a second thread only waits
    busily (it doubled the CPU time without any gain)."""
    import numpy.linalg  # noqa: F401  the library is loaded by now

    try:
        with open("/proc/self/maps") as f:
            libs = {x.split()[-1] for x in f if "openblas" in x}
        for lib in map(ctypes.CDLL, sorted(libs)):
            for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads",
                         "openblas_set_num_threads64_", "openblas_set_num_threads"):
                if hasattr(lib, name):
                    getattr(lib, name)(1)
    except OSError:                                           # another system or library: as it is
        pass


def joined(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one of up to ``limit`` bytes, for steps that
    pack what they find in a block: small blocks would make rows of few
    values, and the more of them the more blocks and ranges there are."""
    held, size = [], 0
    for b in batches:
        if held and size + b.nbytes > limit:
            yield _one(held)
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    whole = pa.Table.from_batches(held).combine_chunks().to_batches()
    return whole[0] if whole else held[0]


def text_blocks(batches: Iterable[pa.RecordBatch], text: str = "text",
                limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of about ``limit`` text bytes. Yields
    the slice and its texts (null: empty). Memory is given back after every
    ``limit`` bytes, and at the end."""
    held = 0
    try:
        for part, texts in _text_blocks(batches, text, limit):
            size = part.nbytes
            yield part, texts
            del part, texts
            held += size
            if held >= limit:
                give_back()
                held = 0
    finally:
        give_back()


def _text_blocks(batches, text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for b in batches:
        sizes = pc.binary_length(b.column(text)).fill_null(0).to_pylist()
        i, held = 0, 0
        for j, n in enumerate(sizes):
            if j > i and held + n > limit:
                part = b.slice(i, j - i)
                yield part, [t or "" for t in part.column(text).to_pylist()]
                i, held = j, 0
            held += n
        if i < len(sizes):
            part = b.slice(i)
            yield part, [t or "" for t in part.column(text).to_pylist()]


def first_by_hash(rows: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The first ``n`` distinct keys of each value of ``by``, in the order
    of a hash (all, where there are fewer). A value may hold most rows: a
    cut at its expected n-th hash, from counts, leaves little for the window
    that takes exactly n."""
    span = 1 << 30
    rows = rows.select(by, key, F.pmod(F.xxhash64(key), F.lit(span)).alias("_u")).distinct()
    size = rows.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_n"))
    cut = F.lit(float(span)) * (n * 1.2 + 200) / F.col("_n")
    near = rows.join(size, F.col(by) == F.col("_by")).where(F.col("_u") < cut)
    order = Window.partitionBy(by).orderBy("_u", key)
    return near.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n).select(by, key)


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def packed(keys: list[np.ndarray], values: np.ndarray) -> list[pa.Array]:
    """Runs of equal keys (rows are sorted by them) as one row each: the
    keys and a binary column with the run's values."""
    n = len(values)
    change = np.ones(n, bool)
    change[1:] = False
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(change)
    ends = (np.append(first, n) * values.itemsize).astype(np.int32)
    blob = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()),
                                                           pa.py_buffer(np.ascontiguousarray(values).tobytes())])
    return [pa.array(k[first]) for k in keys] + [blob]


def unpacked(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and the row of each."""
    blobs = column.to_pylist()
    values = np.frombuffer(b"".join(blobs), kind)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // np.dtype(kind).itemsize
    return values, np.repeat(np.arange(len(blobs)), sizes)


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph ``edges(a, b)`` (longs):
    one row ``(node, root)`` per node of an edge, ``root`` the smallest node
    reachable. Every round attaches each node's larger neighbours to its
    smallest one, then each node to the smallest of its smaller ones, until
    the edge list is a set of stars. Both steps aggregate before they join,
    so the centre of a large group is a sum over tasks, never one list.
    """
    cur = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(), f"{name}-0", tidy=True)
    last = None
    for i in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")) \
            .select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_min, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        nxt = saved(small.select("e.a", "e.b").where("a <> b").distinct(), f"{name}-{i + 1}", tidy=True)
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        cur = nxt
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components of {name} did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
