"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every 64-bit shingle hash below 2**64 / scale. The same fraction is kept of any text, so
sketches merge by union and give unbiased containment estimates between texts of very unequal length.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm import common


def hashes(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """A 64-bit hash of each shingle of each text; a text of fewer than ``size`` words is one shingle."""
    import pyarrow as pa

    codes, vocabulary, first = common.words_of(pa.array(texts, pa.binary()).cast(pa.string()))
    h = common.hash_words(vocabulary)[codes]
    n = len(h)
    runs = h.copy()
    for j in range(1, size):
        m = max(0, n - j)
        runs[:m] = common.mix(runs[:m]) + h[n - m :]
    runs = common.mix(runs)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(runs[a : b - size + 1])
            continue
        own = h[a : a + 1].copy() if b > a else h[:0]
        for j in range(a + 1, b):
            own = common.mix(own) + h[j : j + 1]
        out.append(common.mix(own ^ np.uint64(b - a)))
    return out


def kept(own: np.ndarray, scale: int) -> np.ndarray:
    """Of the hashes those below the threshold, sorted; the smallest of all if none is."""
    below = own[own <= np.uint64((2**64 - 1) // scale)]
    return np.unique(below) if len(below) else own[:0] if not len(own) else own.min(keepdims=True)


def sketch(texts: list[bytes], scale: int = 8, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct kept hashes of each text.

    A text with words and no hash below the threshold keeps its smallest, so that only texts without words
    have an empty sketch and equal sketches mean equal shingles. Such a hash stands for itself alone:
    ``merge`` drops it where the other text has hashes below the threshold.
    """
    return [kept(own, scale) for own in hashes(texts, size)]


def encode(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merge(a: np.ndarray, b: np.ndarray, scale: int = 8) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return kept(np.concatenate([a, b]), scale)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that are in b (1 if both are empty, 0 if only a is). A text too short
    for a hash below the threshold is found only in texts with the same sketch."""
    return float(np.isin(a, b, assume_unique=True).mean()) if len(a) else float(not len(b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated resemblance: shared shingles among all of both (1 if both are empty)."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scale: int = 8, size: int = 5) -> DataFrame:
    """(doc_id, fingerprint) for each row. Null texts count as empty; their fingerprint is ''."""

    def run(batches):
        import pyarrow as pa

        for batch, lo, hi in common.chunks(batches):
            prints = [encode(s) for s in sketch(common.text_bytes(batch, lo, hi), scale, size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, *, id_col: str, text_col: str, rows_per_bucket: int = 2_000, max_buckets: int = 100_000) -> DataFrame:
    """Deal the rows into buckets of consecutive ids so that each row meets the next one, by descending id.

    The bounds are quantiles of the id column alone, ``max_buckets`` at most. An id (or the null id) with more
    rows than two buckets hold has buckets of its own, by the hash of the text, in which order rows with one
    id follow each other. Buckets are streamed, so their size costs no memory. The head of each bucket is
    also sent, as a guest, to the bucket before it; the head of all goes to the last one. One shuffle of the
    texts.
    """
    spark = docs.sparkSession
    text = common.text_of(text_col)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.id_key(id_col).alias("key"), text.alias("text"), F.xxhash64(text).alias("name"))
    parts = min(max_buckets, max(1, source.count() // rows_per_bucket))
    bounds = source.select("key").approxQuantile("key", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    hot = {r["key"]: r["n"] // rows_per_bucket + 1 for r in source.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 2 * rows_per_bucket).collect()}  # no more than half as many as full buckets
    alone = [x for k in hot for x in (k, max(k - 1, common.NULL_ID))]
    edges = np.unique(np.concatenate([np.array(bounds, np.float64).astype(np.int64), np.array(alone, np.int64)]))
    keys = np.array(sorted(hot), np.int64)
    shared = spark.sparkContext.broadcast((edges, keys, np.array([hot[k] for k in keys.tolist()], np.float64)))

    @F.pandas_udf("bucket int, part int")
    def bucket(key: pd.Series, name: pd.Series) -> pd.DataFrame:  # bucket b holds keys in (edges[b-1], edges[b]]
        edges, keys, pieces = shared.value
        key = key.to_numpy(np.int64)
        part = np.zeros(len(key))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            share = (name.to_numpy(np.int64).astype(np.float64) + 2.0**63) / 2.0**64
            part = np.where(keys[at] == key, np.floor(share * pieces[at]), 0)
        return pd.DataFrame({"bucket": np.searchsorted(edges, key, "left").astype(np.int32), "part": part.astype(np.int32)})

    dealt = source.withColumn("b", bucket("key", "name")).select("doc_id", "key", "text", "name", (-F.col("b.bucket")).alias("bucket"), "b.part")
    heads = dealt.groupBy("bucket", "part").agg(F.min(F.struct((-1 - F.col("key")).alias("down"), "name")).alias("head"))
    along = Window.orderBy("bucket", "part")  # one row per bucket
    heads = heads.withColumn("host", F.lag(F.struct("bucket", "part")).over(along)).withColumn("end", F.last(F.struct("bucket", "part")).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = F.broadcast(heads.select(F.col("bucket").alias("h_bucket"), F.col("part").alias("h_part"), "head", F.coalesce("host", "end").alias("host")))
    own = F.struct("bucket", "part", F.lit(0).alias("guest"))
    places = F.array(own, F.struct(F.col("host.bucket"), F.col("host.part"), F.lit(1).alias("guest")))
    first = (F.col("bucket") == F.col("h_bucket")) & (F.col("part") == F.col("h_part")) & (-1 - F.col("key") == F.col("head.down")) & (F.col("name") == F.col("head.name"))
    both = dealt.join(heads, first, "left")
    both = both.select("doc_id", "key", "text", "name", F.explode(F.when(F.col("head").isNotNull(), places).otherwise(F.array(own))).alias("p"))
    both = both.select("doc_id", "key", "text", "name", "p.bucket", "p.part", "p.guest").repartition("bucket", "part")
    return both.sortWithinPartitions("bucket", "part", "guest", F.desc("key"), "name", "text")


@common.shipped
def fingerprint_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scale: int = 8, size: int = 5, rows_per_bucket: int = 2_000) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    in_edited, edited_in: the shares of the text's shingles that the edited text has, and the other way round.

    The edited text has the last third of the code points replaced by as many of the next document's
    first (all of them if it is shorter); next is by descending id, after the last comes the first.
    Null texts are empty; null ids come last and stay null; rows with one id follow each other by the hash of
    their text.
    A table of one row has itself as next. Empty in, empty out.
    """

    def run(batches):
        import hashlib

        import pyarrow as pa

        def pairs():
            """(doc_id, text, next text): a row waits for the one after it in its bucket; guests only end."""
            wait = None
            for batch in batches:
                cols = [batch.column(c) for c in ("doc_id", "text", "bucket", "part", "guest")]
                for r in range(batch.num_rows):
                    doc_id, text, bucket, part, guest = (c[r].as_py() for c in cols)
                    if wait and wait[2] == (bucket, part):
                        yield wait[0], wait[1], text
                    wait = None if guest else (doc_id, text, (bucket, part))

        def flush(todo):
            texts = [t for _, t, _ in todo]
            cut = [len(t) // 3 for t in texts]
            edited = [t[: len(t) - c] + nxt[:c] for (_, t, nxt), c in zip(todo, cut, strict=True)]
            as_bytes = [t.encode() for t in edited]
            one, two, three = (sketch(x, scale, size) for x in ([t.encode() for t in texts], as_bytes, [n.encode() for _, _, n in todo]))
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([i for i, _, _ in todo], pa.int64()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "edited_sha256": [hashlib.sha256(t).hexdigest() for t in as_bytes],
                    "fingerprint": [encode(s) for s in one],
                    "edited_fingerprint": [encode(s) for s in two],
                    "near_edited": pa.array([likeness(a, b) for a, b in zip(one, two, strict=True)], pa.float64()),
                    "near_next": pa.array([likeness(a, b) for a, b in zip(one, three, strict=True)], pa.float64()),
                    "in_edited": pa.array([containment(a, b) for a, b in zip(one, two, strict=True)], pa.float64()),
                    "edited_in": pa.array([containment(b, a) for a, b in zip(one, two, strict=True)], pa.float64()),
                }
            )

        todo, held = [], 0
        for pair in pairs():
            todo.append(pair)
            held += len(pair[1]) + len(pair[2])
            if held > 4_000_000:
                yield flush(todo)
                todo, held = [], 0
        if todo:
            yield flush(todo)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, in_edited double, edited_in double"
    dealt = with_next(docs, id_col=id_col, text_col=text_col, rows_per_bucket=rows_per_bucket)
    return dealt.select("doc_id", "text", "bucket", "part", "guest").mapInArrow(run, schema)
