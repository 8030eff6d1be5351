"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_BYTES = np.zeros(256, dtype=bool)
SPACE_BYTES[[32, 9, 10, 11, 12, 13]] = True
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def key_of(col: str) -> Column:
    """A string that is never null and tells null from empty; it sorts by code point, null last."""
    return F.when(F.col(col).isNull(), F.lit("\U0010ffff")).otherwise(F.concat(F.lit("="), F.col(col).cast("string")))


def order_bits(rows: int, per_bin: int = 20_000, least: int = 6, most: int = 24) -> int:
    """Bits of a hash that cut `rows` rows into bins of about `per_bin`."""
    return int(min(most, max(least, int(np.ceil(np.log2(max(1, rows) / per_bin))))))


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with checkpoint() in spark.checkpoint.dir, which executors share. Only where that is unset,
    as in tests on one machine, a folder of the session's warehouse is set."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(root)
    out = df.checkpoint()
    if _SCRATCH:
        _SCRATCH[-1].append(out)
    return out


_SCRATCH: list[list[DataFrame]] = []


def release(spark: SparkSession) -> None:
    """Let shuffles of finished jobs leave the executors' disks: Spark drops them once the driver's collector has seen that
    nothing refers to them. The driver's freed memory goes back to the system too."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()
    trim_driver(spark)


def trim_driver(spark: SparkSession) -> str:
    """Give memory that the driver freed outside its heap back to the system: each exchange of a plan runs in a thread of its
    own, and what those threads freed stays with their arenas else. Returns what the Java machine says, nothing from one without that command."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    lang = jvm.java.lang

    def array(kind, *values):
        out = gateway.new_array(kind, len(values))
        for i, x in enumerate(values):
            out[i] = x
        return out

    try:
        none, words, name = array(lang.Object), array(lang.String), jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        kinds = array(lang.Class, name.getClass(), lang.Class.forName("java.lang.String"), none.getClass(), words.getClass())
        call = lang.Class.forName("javax.management.MBeanServerConnection").getMethod("invoke", kinds)  # the server's own class isn't exported
        return call.invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), array(lang.Object, name, "systemTrimNativeHeap", none, words))
    except Py4JError:
        return ""


def forget(df: DataFrame) -> None:
    """Delete the files of a result of reliable() that nothing reads any more."""
    with contextlib.suppress(Py4JError):  # a plan of another form keeps its files
        held = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if held.isDefined():
            jvm, jsc = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc
            path = jvm.org.apache.hadoop.fs.Path(held.get())
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Results of reliable() made inside are deleted at the end, but for those put on the list. The driver's collector then
    runs, so that shuffles of finished jobs leave the executors' disks too."""
    _SCRATCH.append([])
    keep: list[DataFrame] = []
    try:
        yield keep
    finally:
        for df in _SCRATCH.pop():
            if all(df is not k for k in keep):
                forget(df)
            elif _SCRATCH:
                _SCRATCH[-1].append(df)
        release(spark)


def lean(df: DataFrame, rows: int = 1000, size: str = "8m") -> DataFrame:
    """df, after lowering the session's Arrow batches for Python workers to what suits columns of whole texts. A batch is held
    several times over (buffer, strings, results), by two workers or more on an executor."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def trim() -> None:
    """Give freed memory back to the system, at the end of a partition: workers live on and would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits (the constants are those of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64


def _powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE, piece: int = 1 << 19) -> np.ndarray:
    """64-bit hashes of data[starts:ends], equal for equal bytes wherever they stand: prefix sums of a polynomial,
    brought back to position 0 with the inverse power, then mixed with the length. starts and ends ascend. Works in
    pieces, so that long inputs need no long tables."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, at + piece)))
        out[i:j] = _piece_hashes(data[at : int(ends[j - 1])], starts[i:j] - at, ends[i:j] - at, base)
        i = j
    return out


def _piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    up, down = _powers(len(data) + 1, base)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        return mix64(h + np.uint64(0x632BE59BD9B4E019) * (ends - starts).astype(np.uint64))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def claim(df: DataFrame, name: str) -> None:
    """ValueError if df has a column of that name already."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {name} already; give another name with into=")


def slices(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most` bytes of the text column with that number; a longer text is alone."""
    if batch.num_rows:
        at, sizes = 0, np.cumsum(pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
