"""Line dedup with a sharded minimal perfect hash.

Lines are told apart by 128 bits of XXH3 of their key. Spark counts the documents of each key and keeps what is
found often enough. These keys are dealt into shards of bounded size; each becomes a minimal perfect hash
whose slots point into arrays: a fingerprint, the number of documents, and the last document. Documents then probe
the arrays with the keys of their lines; a key that isn't in the index meets a foreign fingerprint.

An index of fewer bytes than ``broadcast_limit`` (they are added up first) goes to all tasks. A larger one stays
in shards: blocks of documents are written, ask for each of their keys once, in groups of bounded size, and
meet the answers by block. Both ways give the same rows, and lines themselves are never joined.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common

_BLANK = " \t\n\x0b\x0c\r"
INDEX = "shard long, levels binary, prints binary, counts binary, lasts binary"
OUT = "doc_id long, n_lines long, n_dropped long, text string"


class PerfectHash:
    """Distinct pairs of 64-bit words to 0 .. n - 1. Each level has a bit for each slot that one key alone falls
    into; the others go on to the next level. A key's number is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.ranks = np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))
        self.words = words

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (common.mix(a ^ common.mix(b + np.uint64(level))) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, load: float = 1.5) -> PerfectHash:
        levels = []
        while len(a):
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
            n_words = int(len(a) * load) // 64 + 1
            slot = cls._slot(a, b, len(levels), 64 * n_words)
            alone = np.bincount(slot, minlength=64 * n_words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            left = ~alone[slot]
            a, b = a[left], b[left]
        return cls(levels)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for some of those that were not built in (others get any number)."""
        out, open_, before = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, own in enumerate(self.levels):
            slot = self._slot(a[open_], b[open_], level, 64 * len(own))
            word, bit = before + (slot >> 6), (slot & 63).astype(np.uint64)
            bits = self.words[word]
            hit = (bits >> bit & np.uint64(1)) == 1
            below = bits[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.ranks[word[hit]] + np.bitwise_count(below)
            open_, before = open_[~hit], before + len(own)
        return out

    def to_bytes(self) -> bytes:
        return np.array([len(self.levels), *(len(x) for x in self.levels)], "<i8").tobytes() + self.words.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8)
        words = np.frombuffer(data, "<u8", offset=8 * (n + 1))
        return cls(np.split(words, np.cumsum(sizes)[:-1]) if n else [])


class Index:
    """The arrays of some shards. A key's shard is ``b`` modulo ``shards``, its fingerprint is ``a``."""

    def __init__(self, rows, shards: int):
        self.shards = shards
        self.parts = {shard: (PerfectHash.from_bytes(levels), np.frombuffer(prints, "<u8"), np.frombuffer(counts, "<i8"), np.frombuffer(lasts, "<i8")) for shard, levels, prints, counts, lasts in rows}

    def probe(self, a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(hit, last) of each key: was it found in at least ``least`` documents, and which is the last of these?"""
        hit, last = np.zeros(len(a), bool), np.zeros(len(a), np.int64)
        shard = (b % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edge = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for lo, hi in zip(edge, np.append(edge[1:], len(order))[: len(edge)], strict=True):
            own = order[lo:hi]
            if (part := self.parts.get(int(shard[own[0]]))) is None:
                continue
            table, prints, counts, lasts = part
            at = table.find(a[own], b[own])
            ok = (at >= 0) & (prints[at] == a[own]) & (counts[at] >= least)
            hit[own], last[own] = ok, np.where(ok, lasts[at], 0)
        return hit, last


class Lines:
    """The lines of an Arrow array of texts and the keys of the long ones: ``row`` and ``code`` of each long line
    (``at`` among all lines); ``a`` and ``b`` of each distinct key."""

    def __init__(self, texts, min_chars: int):
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash

        lists = pc.split_pattern(texts.cast(pa.large_string()), "\n")
        self.sizes = pc.list_value_length(lists).to_numpy()
        self.flat = lists.flatten()
        keys = pc.ascii_lower(pc.ascii_trim(self.flat, characters=_BLANK))
        self.at = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
        coded = keys.take(pa.array(self.at)).cast(pa.large_binary()).dictionary_encode()
        self.code = coded.indices.to_numpy()
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)[self.at]
        names = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
        self.a, self.b = np.frombuffer(names, "<u8").reshape(-1, 2).T.copy()

    def documents(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct key: in how many rows it is, and the largest of ``d`` (a row's id) there."""
        pairs = np.unique(self.row * len(self.a) + self.code) if len(self.at) else np.zeros(0, np.int64)
        row, code = np.divmod(pairs, max(len(self.a), 1))
        last = np.full(len(self.a), common.NULL_ID, np.int64)
        np.maximum.at(last, code, d[row])
        return np.bincount(code, minlength=len(self.a)), last

    def cut(self, d: np.ndarray, hit: np.ndarray, last: np.ndarray):
        """(n_dropped, text): lines of keys that are hit go, but where the row's id is the last."""
        import pyarrow as pa

        gone = np.zeros(len(self.flat), bool)
        gone[self.at] = hit[self.code] & (last[self.code] != d[self.row])
        first = np.append(0, np.cumsum(self.sizes))
        dropped = np.diff(np.append(0, np.cumsum(gone))[first])
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(np.diff(first) - dropped)), self.flat.filter(pa.array(~gone)))
        return dropped, pa.compute.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())


def _ids(batch) -> np.ndarray:
    return batch.column("d").to_numpy(zero_copy_only=False)


def _counted(source: DataFrame, min_docs: int, min_chars: int, chunk: int) -> DataFrame:
    """(a, b, n, last) of the keys found in at least ``min_docs`` documents; a task counts each key of a chunk once."""

    def run(batches):
        import pyarrow as pa

        for batch, lo, hi in common.chunks(batches, chunk):
            own = batch.slice(lo, hi - lo)
            lines = Lines(own.column("text"), min_chars)
            n, last = lines.documents(_ids(own))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lines.a.view(np.int64), lines.b.view(np.int64), n, last)], ["a", "b", "n", "last"])

    found = source.mapInArrow(run, "a long, b long, n long, last long").groupBy("a", "b")
    return found.agg(F.sum("n").alias("n"), F.max("last").alias("last")).where(F.col("n") >= min_docs)


def _index(keys: DataFrame, shards: int) -> DataFrame:
    """INDEX of keys (a, b, n, last): one row for each shard that has keys."""

    def build(table):
        import pyarrow as pa

        a, b = (table.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        found = PerfectHash.build(a, b)
        order = np.argsort(found.find(a, b))
        arrays = [a[order], table.column("n").to_numpy()[order], table.column("last").to_numpy()[order]]
        return pa.table([[table.column("shard")[0].as_py()], [found.to_bytes()], *([x.tobytes()] for x in arrays)], schema=pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("levels", "prints", "counts", "lasts"))]))

    return keys.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(build, INDEX)


def _shard(shards: int) -> F.Column:
    """``b``, read as unsigned, modulo ``shards``."""
    return F.expr(f"cast(pmod(cast(b as decimal(20,0)) + if(b < 0, 18446744073709551616, 0), {shards}) as long)")


def _result(doc_ids, lines: Lines, d: np.ndarray, hit: np.ndarray, last: np.ndarray):
    import pyarrow as pa

    dropped, text = lines.cut(d, hit, last)
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(lines.sizes.astype(np.int64)), pa.array(dropped.astype(np.int64)), text], ["doc_id", "n_lines", "n_dropped", "text"])


def _probe_broadcast(source: DataFrame, index: DataFrame, shards: int, min_docs: int, min_chars: int, chunk: int) -> DataFrame:
    rows = [(r.shard, bytes(r.levels), bytes(r.prints), bytes(r.counts), bytes(r.lasts)) for r in index.collect()]
    shared = source.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        found = Index(shared.value, shards)
        for batch, lo, hi in common.chunks(batches, chunk):
            own = batch.slice(lo, hi - lo)
            lines = Lines(own.column("text"), min_chars)
            yield _result(own.column("doc_id"), lines, _ids(own), *found.probe(lines.a, lines.b, min_docs))

    return source.mapInArrow(run, OUT)


def _probe_sharded(source: DataFrame, index: DataFrame, shards: int, min_docs: int, min_chars: int, chunk: int, group: int) -> DataFrame:
    spark = source.sparkSession

    def blocks_of(batches):
        import pyarrow as pa

        for batch, lo, hi in common.chunks(batches, chunk):
            own = batch.take(pa.array(np.arange(lo, hi)))
            one = pa.array([0, hi - lo], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(one, own.column(c)) for c in ("doc_id", "d", "text")], ["doc_id", "d", "text"])

    types = {f.name: f.dataType.simpleString() for f in source.schema}
    found = source.mapInArrow(blocks_of, ", ".join(f"{c} array<{types[c]}>" for c in ("doc_id", "d", "text")))
    blocks = common.materialise(found.withColumn("block", F.monotonically_increasing_id()), "line-blocks")

    def ask(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                lines = Lines(batch.column("text")[row].values, min_chars)
                block = np.full(len(lines.a), batch.column("block")[row].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(lines.a.view(np.int64)), pa.array(lines.b.view(np.int64))], ["block", "a", "b"])

    asked = common.materialise(blocks.select("block", "text").mapInArrow(ask, "block long, a long, b long"), "line-probes")
    parts = asked.count() // (shards * group) + 1
    # Each shard's arrays are read by groups of about ``group`` probes: copies of the index weigh as much as the probes.
    asked = asked.select("block", "a", "b", _shard(shards).alias("shard"), F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"))
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def answer(probes, rows):
        import pyarrow as pa

        own = Index(list(zip(*(rows.column(c.split()[0]).to_pylist() for c in INDEX.split(", ")), strict=True)), shards)
        a, b = (probes.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        hit, last = own.probe(a, b, min_docs)
        table = probes.select(["block", "a", "b"]).append_column("last", pa.array(last))
        return table.filter(pa.array(hit))

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards * parts // 4)
    keyed = [x.repartition(n, "shard", "part").groupBy("shard", "part") for x in (asked, copies)]
    answers = keyed[0].cogroup(keyed[1]).applyInArrow(answer, "block long, a long, b long, last long")

    def cut(block, answered):
        import pyarrow as pa

        if not block.num_rows:
            return pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())]).empty_table()
        ids, d, texts = (block.column(c).chunk(0)[0].values for c in ("doc_id", "d", "text"))
        lines = Lines(texts, min_chars)
        at = {k: v for k, v in zip(zip(answered.column("a").to_pylist(), answered.column("b").to_pylist(), strict=True), answered.column("last").to_pylist(), strict=True)}
        last = [at.get(k) for k in zip(lines.a.view(np.int64).tolist(), lines.b.view(np.int64).tolist(), strict=True)]
        hit = np.array([x is not None for x in last], bool)
        batch = _result(ids, lines, d.to_numpy(zero_copy_only=False), hit, np.array([x or 0 for x in last], np.int64))
        return pa.Table.from_batches([batch])

    n = max(1, blocks.count())
    both = [x.repartition(n, "block").groupBy("block") for x in (blocks, answers)]
    return both[0].cogroup(both[1]).applyInArrow(cut, OUT)


@common.shipped
def drop_repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, min_chars: int = 40,
    broadcast_limit: int = 64_000_000, shard_keys: int = 1_000_000, chunk: int = 8_000_000, group: int = 2_000_000,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_lines, n_dropped, text (lines that stay).

    A line's key is the line without blanks at its ends, A-Z lower-cased. A key of ``min_chars`` characters in
    ``min_docs`` documents keeps its lines in the document with the largest id that has it alone. Each row counts
    as a document; rows that share the largest id all keep the line; a null id is smaller than all others and
    stays null; a null text is one empty line; other columns are ignored. Empty in, empty out.
    ``broadcast_limit``, ``shard_keys``, ``chunk`` and ``group`` change the work, never the result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.id_key(id_col).alias("d"), common.text_of(text_col).alias("text"))
    keys = common.materialise(_counted(source, min_docs, min_chars, chunk), "line-keys")
    shards = keys.count() // shard_keys + 1
    index = common.materialise(_index(keys, shards), "line-index")
    common.discard(keys)
    size = index.agg(F.coalesce(F.sum(sum(F.octet_length(c) for c in ("levels", "prints", "counts", "lasts"))), F.lit(0))).first()[0]
    if size <= broadcast_limit:
        return _probe_broadcast(source, index, shards, min_docs, min_chars, chunk)
    return _probe_sharded(source, index, shards, min_docs, min_chars, chunk, group)
