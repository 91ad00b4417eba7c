"""Repeated-substring removal by distributed prefix doubling.

Two suffixes need comparing over ``size`` bytes at most, and a position drops out as soon as the prefix ranked
so far is that of one document alone. Ranks of the first ``gram`` bytes are taken at one position in about 15,
the anchors of ``repeats``, which every repeat has at equal places; shards of these ranks drop the unique
ones, most of the corpus. Equal stretches around an anchor are a class: its member in the smallest document
represents it, and all windows of the members in other documents recur.

What is left, representatives with an anchor that has other surroundings elsewhere, is ranked by Spark. In the
first round it sorts positions (the anchor and those 10 and 20 bytes before, one of which every window has
within its first 10 bytes) by the pair of their rank of 20 bytes and that of the 20 at the next offset, which
ranks 40 bytes; positions whose pair no other document has drop out with their windows. In the second round it
sorts the windows of the others by that rank and the name of their ``size`` bytes, past which ranks need not go.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm import common, repeats
from isohyet.llm.repeats import Rule

WINDOW = Rule(size=50, gram=20, words=False)
_BYTES_AT_ONCE = 1_500_000
_STRETCHES = 600_000


def _earlier(h, y, d):
    """(order, gone, group): rows sorted by (h, y, d), which of them have an equal stretch in a document before, and
    the number of their (h, y)."""
    order = np.lexsort((d, y, h))
    h, y, d = h[order], y[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (y[1:] != y[:-1])
    group = np.cumsum(new) - 1
    return order, d > d[np.flatnonzero(new)[group]] if len(h) else new[:0], group


def find_stretches(docs: DataFrame, rule: Rule, bytes_per_shard: int = 6_000_000) -> DataFrame:
    """(pending, d, t, s, e, a) for ``docs`` (d, t, text): stretches that an earlier document has (to remove) and
    representatives whose anchor has other surroundings elsewhere (pending).

    (d, t) name a row: its id and the hash of its text. Rows that repeat both are one document. A task sends a
    shard one row of arrays for each ``_STRETCHES`` that it cuts; stretches that recur inside a task are settled there.
    """
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = common.shards(total, bytes_per_shard)
    names = ("d", "t", "doc", "s", "n", "h", "y")

    def split(batches):
        import pyarrow as pa
        import xxhash

        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())

        def flush(parts):
            doc, s, n, h, y, d, t = (np.concatenate([p[k] for p in parts]) for k in range(7))
            order, gone, _ = _earlier(h, y, d[doc])
            where = np.where(gone, -1 - doc[order] % shards, (common.mix(h[order]) % np.uint64(shards)).astype(np.int64))
            by = np.argsort(where, kind="stable")
            order, where = order[by], where[by]
            edge = np.flatnonzero(np.diff(where, prepend=where[0] - 1))
            columns = [[] for _ in names]
            for a, b in zip(edge, np.append(edge[1:], len(where)), strict=True):
                own = order[a:b]
                docs_of, back = np.unique(doc[own], return_inverse=True)
                settled = where[a] < 0
                for column, x in zip(columns, (d[docs_of], t[docs_of], back, s[own], n[own], h[own[:0] if settled else own].view(np.int64), y[own[:0] if settled else own].view(np.int64)), strict=True):
                    column.append(x)
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, c)]), pa.int32()), pa.array(np.concatenate(c), kind)) for c, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(where[edge].astype(np.int64)), *lists], ["shard", *names])

        parts, held, base = [], 0, 0
        for batch, lo, hi in common.chunks(batches, _BYTES_AT_ONCE):
            own = batch.take(pa.array(np.arange(lo, hi)))
            data, first = repeats.units_of(own.column("text"), rule)
            doc, s, e, a, h = repeats.stretches(data, first, rule)
            whole, digest = data.tobytes(), xxhash.xxh64_intdigest
            y = np.fromiter((digest(whole[a:b]) for a, b in zip((first[doc] + s).tolist(), (first[doc] + e).tolist(), strict=True)), np.uint64, len(s))
            parts.append((doc + base, s, (a - s) << 16 | (e - s), h, y, own.column("d").to_numpy(), own.column("t").to_numpy()))
            held, base = held + len(s), base + own.num_rows
            if held > _STRETCHES:
                yield flush(parts)
                parts, held, base = [], 0, 0
        if held:
            yield flush(parts)

    def settle(table):
        import pyarrow as pa

        columns = {c: table.column(c).combine_chunks() for c in names}
        size = np.diff(columns["s"].offsets.to_numpy())
        base = np.repeat(columns["d"].offsets.to_numpy()[:-1], size)
        flat = {c: x.values.to_numpy() for c, x in columns.items()}
        at = flat["doc"] + base
        d, t, s = flat["d"][at], flat["t"][at], flat["s"]
        e, a = s + (flat["n"] & 0xFFFF), s + (flat["n"] >> 16)
        if table.column("shard")[0].as_py() < 0:
            keep, pending = np.arange(len(d)), np.zeros(len(d), bool)
        else:
            h, y = flat["h"].view(np.uint64), flat["y"].view(np.uint64)
            order, gone, group = _earlier(h, y, d)
            new = np.ones(len(h), bool)
            new[1:] = h[order][1:] != h[order][:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(h)) - 1
            several = (group[last] > group[first])[np.cumsum(new) - 1]
            keep, pending = order[gone | several], ~gone[gone | several]
        return pa.table([pa.array(pending), pa.array(d[keep]), pa.array(t[keep]), pa.array(s[keep]), pa.array(e[keep]), pa.array(a[keep])], ["pending", "d", "t", "s", "e", "a"])

    schema = "shard long, d array<long>, t array<long>, doc array<int>, s array<int>, n array<int>, h array<long>, y array<long>"
    dealt = docs.select("d", "t", "text").mapInArrow(split, schema).repartition(shards, "shard")
    return common.materialise(dealt.groupBy("shard").applyInArrow(settle, "pending boolean, d long, t long, s int, e int, a int"), "stretches")


def _per_text(docs: DataFrame, places: DataFrame, columns: list[str], cut, schema: str) -> DataFrame:
    """``cut(d, t, text as bytes, rows of columns)`` gives arrays, one for each column of ``schema``, for each text that has places."""
    gathered = places.groupBy("d", "t").agg(F.collect_list(F.struct(*columns)).alias("places"))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            places = batch.column("places")
            starts, own = places.offsets.to_numpy(), [places.values.field(c).to_numpy() for c in columns]
            for row, (d, t) in enumerate(zip(batch.column("d").to_pylist(), batch.column("t").to_pylist(), strict=True)):
                at = slice(starts[row], starts[row + 1])
                parts.append(cut.one(d, t, batch.column("text")[row].as_buffer().to_pybytes(), *(x[at] for x in own)))
                held += len(parts[-1][0])
                if held > 500_000:
                    yield cut.many(parts, names)
                    parts, held = [], 0
        if parts:
            yield cut.many(parts, names)

    return docs.select("d", "t", "text").join(gathered, ["d", "t"]).mapInArrow(run, schema)


def _names(data: bytes, start: list[int], length: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(data[i : i + length]) for i in start), np.uint64, len(start)).view(np.int64)


class Cores:
    """The 40-byte strings around the anchors of pending stretches, one of which each of their windows holds."""

    def __init__(self, rule: Rule):
        self.rule, self.step = rule, rule.size - 2 * rule.gram

    def one(self, d, t, data, s, e, a):
        size, step = self.rule.size, self.step
        parts = []
        for k in range((size - self.rule.gram) // step):
            core = a.astype(np.int64) - k * step
            lo, hi = np.maximum(s, core - step), np.minimum(e - size, core - (k > 0))
            some = lo <= hi
            parts.append((core[some], lo[some], hi[some]))
        core, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
        at, gram = core.tolist(), self.rule.gram
        return np.full(len(core), d, np.int64), np.full(len(core), t, np.int64), lo, hi, _names(data, at, gram), _names(data, [i + gram for i in at], gram)

    @staticmethod
    def many(parts, names):
        import pyarrow as pa

        d, t, lo, hi, rank, after = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(t), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(rank), pa.array(after)], names)


class Windows:
    """The windows that hold a string of several documents. Of equal ones in a task those after the first document
    are decided there; in place of a rank and a name they have what spreads them."""

    def __init__(self, rule: Rule):
        self.rule = rule

    def one(self, d, t, data, lo, hi, rank):
        n = (hi - lo + 1).astype(np.int64)
        p = np.repeat(lo.astype(np.int64) - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.full(len(p), d, np.int64), np.full(len(p), t, np.int64), p, np.repeat(rank, n), _names(data, p.tolist(), self.rule.size)

    @staticmethod
    def many(parts, names):
        import pyarrow as pa

        d, t, p, rank, name = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((d, name, rank))
        new = np.ones(len(order), bool)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (name[order][1:] != name[order][:-1])
        decided = np.zeros(len(order), bool)
        decided[order] = d[order] > d[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank, name = np.where(decided, t, rank), np.where(decided, p, name)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(t), pa.array(p.astype(np.int32)), pa.array(rank), pa.array(name), pa.array(decided)], names)


def later_windows(docs: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """(d, t, s, e) of the windows of pending stretches that start in a document with a smaller d too."""
    if (rule.size - rule.gram) % (rule.size - 2 * rule.gram):
        raise ValueError("size - 2 * gram must divide size - gram")
    cores = _per_text(docs, found.where("pending"), ["s", "e", "a"], Cores(rule), "d long, t long, lo int, hi int, rank long, after long")
    cores = common.materialise(cores, "cores")
    pairs = cores.groupBy("rank", "after").agg(F.min("d").alias("first"), F.max("d").alias("final")).where("first < final")
    pairs = pairs.select(F.col("rank").alias("p_rank"), F.col("after").alias("p_after"))
    ranked = cores.join(pairs, (F.col("rank") == F.col("p_rank")) & (F.col("after") == F.col("p_after"))).select("d", "t", "lo", "hi", F.xxhash64("rank", "after").alias("rank"))
    ranked = common.materialise(ranked, "ranks")
    common.discard(cores)
    at = _per_text(docs, ranked, ["lo", "hi", "rank"], Windows(rule), "d long, t long, p int, rank long, name long, decided boolean")
    # equal windows have met in each task, so a window that a third of all documents have is a row for each task
    same = Window.partitionBy("decided", "rank", "name")
    later = at.withColumn("first", F.min("d").over(same)).where("decided or d > first")
    return later.select("d", "t", F.col("p").alias("s"), (F.col("p") + rule.size).alias("e"))


@common.shipped
def remove_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rule: Rule = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, n_bytes, n_removed, n_spans, kept_sha256 and the ``carry`` columns.

    ``text`` has the kept bytes; where a cut splits a character, the bytes left of it are dropped from the
    text (not from the digest). Null texts are empty; a null id stays null and counts as the smallest; rows
    with one id never repeat each other. Empty in, empty out.
    """
    held = {c: f"__c{i}" for i, c in enumerate(carry)}
    named = repeats.keyed(docs, id_col, text_col, held)
    with common.temporary(docs.sparkSession) as keep:
        found = find_stretches(named, rule)
        gone = found.where("not pending").select("d", "t", "s", "e").unionAll(later_windows(named, found, rule))
        gone = keep(common.materialise(gone, "gone"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, n_bytes, n_gone, n_spans, names = [], [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                gone = repeats.gone_mask(len(data), ranges.values)
                kept = data[~gone].tobytes()
                texts.append(kept.decode("utf-8", "ignore"))
                n_bytes.append(len(data))
                n_gone.append(int(gone.sum()))
                n_spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                names.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_bytes, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(names), *(batch.column(c) for c in held.values())], ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", *held.values()])

    kinds = "".join(f", {n} {docs.schema[c].dataType.simpleString()}" for c, n in held.items())
    cut = repeats.with_ranges(named, gone).select("doc_id", "text", "ranges", *held.values()).mapInArrow(run, "doc_id long, text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + kinds)
    return cut.withColumnsRenamed({n: c for c, n in held.items()})
