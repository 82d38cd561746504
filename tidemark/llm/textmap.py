"""Shared helpers: run a batch function over the texts of a table, look up
per-word values, split rows into training and held-out, store a table in the
shared folder.

``map_texts`` carries whole input rows inside one struct column, so no column
name of the input can clash with a name the operator adds.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

#: Rows handed to a batch function at once; bounds the Python copies of texts.
SLICE_ROWS = 256
#: Rows of an Arrow batch of texts between the JVM and a worker, both of which hold it
#: whole, and again while its buffers grow.
BATCH_ROWS = 512
#: Distinct words a task remembers before it starts over.
WORD_LIMIT = 500_000

BatchFn = Callable[[list], Sequence]


def map_texts(docs: DataFrame, make: Callable[[], BatchFn], fields: Sequence[T.StructField],
              text: str = "text", row: str = "row",
             keep: Sequence[str] | None = None, once: bool = False) -> DataFrame:
    """``row`` (struct of every input column, or of those of ``keep``) plus ``fields``.
    With ``once`` a text of type string that is in ``row`` is sent once, not twice.

    ``make()`` runs once per task and returns a function from a list of texts
    (``None`` for null) to one array per field, aligned with the texts.
    """
    bound_batches(docs.sparkSession)
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(row),
                      F.col(f"`{text}`").cast("string").alias("t"))
    in_row = None
    if once and text in src.schema[row].dataType.names \
            and isinstance(docs.schema[text].dataType, T.StringType):
        src, in_row = src.select(row), src.schema[row].dataType.names.index(text)
    schema = T.StructType([T.StructField(row, src.schema[row].dataType), *fields])
    names = [f.name for f in schema]

    def run(batches: Iterable[pa.RecordBatch]):
        fn = make()
        try:
            yield from parts(fn, batches)
        finally:
            del fn
            give_back_memory()

    def parts(fn: BatchFn, batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                texts = part.column(1) if in_row is None else \
                    pc.struct_field(part.column(0), [in_row])
                cols = fn(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(c if isinstance(c, pa.Array) else pa.array(c)
                                       for c in cols)], names)

    return src.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows at most from now on in this session, for a
    plan takes their size when it is run: Spark's usual 10,000 texts of some KB take
    tens of MB several times over in each task.  A smaller bound stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back_memory() -> None:
    """Free memory of this worker back to the system: workers are used again, and what
    the tasks of one step have freed would add to what the next step takes."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def give_back_driver_memory(spark: SparkSession) -> None:
    """The same for the driver, its Python and its JVM: what the planning and compiling of
    each job has freed stays with the C library and adds up over a pipeline's many jobs."""
    give_back_memory()
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    find = jvm.java.lang.Class.forName
    try:  # jcmd's System.trim_native_heap; through the interface, as the server's class is not public
        kinds, args = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(["javax.management.ObjectName", "java.lang.String",
                                  "[Ljava.lang.Object;", "[Ljava.lang.String;"]):
            kinds[i] = find(kind)
        args[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        args[1] = "systemTrimNativeHeap"
        find("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(
            jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # a JVM without that command
        pass


class WordTable:
    """Values of distinct words, computed once per task and word.

    ``build(words)`` returns a tuple of arrays with one row per word.  The
    table starts over once it holds ``limit`` words, so its memory is bounded
    by that and the words of one batch, whatever the vocabulary.
    """

    def __init__(self, build: Callable[[list], tuple], limit: int = WORD_LIMIT):
        self.build, self.limit = build, limit
        self._restart()

    def _restart(self) -> None:
        self.rows = defaultdict(count().__next__)
        self.cols: list[np.ndarray] = []

    def lookup(self, words: list) -> np.ndarray:
        """Row number of every word; ``cols`` holds the values by row."""
        if len(self.rows) > self.limit:
            self._restart()
        first = len(self.rows)
        idx = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        grown = len(self.rows) - first
        if grown:
            new = list(islice(reversed(self.rows), grown))[::-1]
            for k, made in enumerate(map(np.asarray, self.build(new))):
                if not first:
                    self.cols.append(made)
                    continue
                if first + grown > len(self.cols[k]):
                    room = np.zeros((2 * (first + grown), *made.shape[1:]), made.dtype)
                    room[:first] = self.cols[k][:first]
                    self.cols[k] = room
                self.cols[k][first:first + grown] = made
        return idx


def code_points(words: list, lead: str = "<", tail: str = ">") -> tuple[np.ndarray, np.ndarray]:
    """Code points of ``<word><word>...`` and the word number of each."""
    marked = "".join([f"{lead}{w}{tail}" for w in words])
    chars = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + len(lead) + len(tail)
    return chars, np.repeat(np.arange(len(words)), lens)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer for 64-bit keys (wraps around on purpose)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def char_ngrams(chars: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character n-grams that lie inside one word, and the word
    number of each."""
    if len(chars) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    end = len(chars) - n + 1
    h = np.full(end, n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + chars[k:k + end]
    inside = owner[:end] == owner[n - 1:]
    return mix64(h[inside]), owner[:end][inside]


def segment_sums(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of ``values``; run ``i`` has ``lens[i]`` items."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    ends = np.cumsum(lens)
    return total[ends] - total[ends - lens]


def id_crc(doc_id: str | Column = "doc_id") -> Column:
    """CRC-32 of a document id written as text (a null id as the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def held_out(mod: int, rest: int, doc_id: str | Column = "doc_id") -> Column:
    return id_crc(doc_id) % mod == rest


def bounded_share(df: DataFrame, bound: int, key: str = "doc_id") -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of ``key``; all rows if
    there are no more than that."""
    n = df.count()
    if n <= bound:
        return df
    share = int(bound / n * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("share")), F.lit(1 << 30)) < share)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, so
    a lost executor never costs more than the step that reads it.  The driver gives
    back the memory that the write has freed."""
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    give_back_driver_memory(spark)
    return spark.read.schema(df.schema).parquet(path)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int,
                   max_chars: int) -> list[tuple[str, int]]:
    """Training rows ``(text, label)`` on the driver, in a fixed order.

    At most about ``bound`` labelled documents (chosen by a hash of the id) of
    at most ``max_chars`` characters each, so at most ``bound * max_chars``
    characters.  Rows with a null id, label or text are not used, nor are documents
    whose labels contradict each other.  Of an id with several texts the smallest is
    taken.
    """
    y = F.col(label).cast("int")
    marks = (labels.where(y.isNotNull() & F.col("doc_id").isNotNull()).where(train)
             .groupBy("doc_id").agg(F.min(y).alias("y"), F.max(y).alias("most"))
             .where("y = most").select("doc_id", "y"))
    marks = bounded_share(marks, bound)
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .where(F.length("text") <= max_chars)
            .join(F.broadcast(marks), "doc_id")  # about `bound` rows of two numbers
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
            .toPandas().sort_values("doc_id"))
    return list(zip(rows["text"].tolist(), rows["y"].tolist()))
