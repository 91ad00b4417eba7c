"""Helpers that several training-data operators share.

Intermediate tables go to the folder that the cluster names in ``spark.checkpoint.dir``, so that any
executor (and a retried task) can read them again. Nothing here collects rows that grow with the input.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Takes the place of a null id where ids are compared; null ids sort before all others.
NULL_ID = -(2**63)
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dir: list[str] = []
_made: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for a Spark context, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_isohyet_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-")).resolve() / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._isohyet_shipped = True


def shipped(operator):
    """An operator on a DataFrame whose tasks import this package: it is sent to them first."""

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **kwargs):
        ship(df.sparkSession)
        return operator(df, *args, **kwargs)

    return run


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer files than there are cores, dealt out evenly; any other scan as it is.

    A file that was written as one row group can't be split, and most operators do their work where the
    text is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def shards(size: int, full: int) -> int:
    """How many shards of at most about ``full`` units: 64 at least, unless they would be tiny."""
    return max(min(64, 40 * size // full + 1), size // full)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one of our own only where none is set (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="spark-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


@contextlib.contextmanager
def session_settings(spark: SparkSession, **values: str):
    """Set SQL settings for a while ('__' in a name stands for '.')."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Parquet options for tables of rows of a MB and more: each row is a row group, so that readers hold one at a time.
ROW_BY_ROW = {"parquet.block.row.count.limit": "1"}


def materialise(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: cuts lineage, frees its shuffles. ``options`` are the writer's."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with session_settings(spark, **{_CLEAN_SHUFFLES.replace(".", "__"): "true"}):
        df.write.options(compression="zstd", **(options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._isohyet_path = path
    return out


def new_path(spark: SparkSession, label: str) -> str:
    """A name in the shared folder that nothing has yet; ``discard_all`` deletes it."""
    path = f"{shared_dir(spark)}/isohyet-{label}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _made.discard(name)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialise`` that nothing reads any more."""
    _delete(df.sparkSession, df._isohyet_path)


@contextlib.contextmanager
def temporary(spark: SparkSession):
    """Tables that ``materialise`` makes inside are deleted at the end, but for those given to what this yields."""
    before, kept = set(_made), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._isohyet_path)
        return df

    yield keep
    for name in _made - before - kept:
        _delete(spark, name)


def discard_all(spark: SparkSession) -> None:
    """Delete every table that ``materialise`` made here: for when all results that read them are written."""
    for name in list(_made):
        _delete(spark, name)


def if_few(df: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """``df``, a written table of short rows, marked for broadcast where it has at most ``limit``: the texts that it is joined with stay where they are."""
    return F.broadcast(df) if df.count() <= limit else df


def id_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh_ids(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` as a written table with a row number that no later retry can change."""
    return materialise(df.withColumn(name, F.monotonically_increasing_id()), label)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links between longs to (node, root) with root the smallest node reachable.

    Alternates large-star and small-star steps. Each takes a grouped minimum, which Spark combines
    before the shuffle, and a join of the links with it, which AQE splits at a hot node; no group is
    gathered. A step keeps at most one link for each link it got. An empty input gives no rows.
    """
    links = materialise(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links")
    for _ in range(max_rounds):
        both = links.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(links.select(F.col("hi"), F.col("lo")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.explode(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi <> lo").distinct()
        after = materialise(small.select("lo", "hi"), "links")
        # Done when the links are stars: nobody who hangs on a root has a second root or hangers of its own.
        roots = after.select(F.col("lo").alias("x"), F.lit(1).alias("is_lo"), F.lit(0).alias("n_lo")).distinct().union(after.groupBy("hi").agg(F.lit(0), F.count("*").cast("int")))
        open_ends = roots.groupBy("x").agg(F.max("is_lo").alias("is_lo"), F.sum("n_lo").alias("n_lo")).where("n_lo > 1 or (is_lo = 1 and n_lo > 0)").limit(1).count()
        discard(links)
        links = after
        if not open_ends:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(links.select(F.col("lo"), F.col("lo")).distinct())


# --- hashing of token runs in numpy ---------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base`` modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(1 << (n - 1).bit_length(), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than space and 0x09-0x0D."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words_of(texts, fold: bool = False):
    """(codes, vocabulary, first) of an Arrow array of texts: the words are runs of other than space and
    0x09-0x0D, with A-Z lower-cased if ``fold``. codes is each word's place in the vocabulary of distinct
    words (an Arrow array of bytes), first where each text's words begin (one more entry)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = texts.cast(pa.large_string())
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts) if fold else texts)
    flat = pieces.flatten()
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty piece
    ends = np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(real, dtype=np.int64)])[np.concatenate([[0], ends])]
    coded = flat.filter(pa.array(real)).cast(pa.large_binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, first


def hash_words(vocabulary, seed: int = 42) -> np.ndarray:
    """XXH64 of each entry of an Arrow array of bytes."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _FOLD[data]


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, with ``gap`` after each; and where each begins (one more at the end)."""
    data = np.frombuffer(gap.join([*texts, b""]), np.uint8)
    at = np.cumsum([0, *(len(t) + len(gap) for t in texts)], dtype=np.int64)
    return data, at


def chunks(batches, size: int = 4_000_000):
    """Arrow batches as (batch, first row, end row) with about ``size`` bytes of the column 'text' in each."""
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        total, first = np.cumsum(lengths), 0
        while first < batch.num_rows:
            end = int(np.searchsorted(total, (total[first - 1] if first else 0) + size, "right"))
            end = min(max(end, first + 1), batch.num_rows)
            yield batch, first, end
            first = end


def text_bytes(batch, first: int, end: int) -> list[bytes]:
    import pyarrow as pa

    return batch.column("text").slice(first, end - first).cast(pa.binary()).to_pylist()
