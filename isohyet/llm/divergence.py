"""How far do the sources of a language differ in their words?

Terms are counted in the tasks that read them, in buckets of equal width: terms of up to eight bytes are packed
into one 64-bit word and those of up to sixteen into two, which are sorted by radix and counted by runs; longer
ones are padded to the next power of two and sorted as bytes. Spark adds up the counts by language, source and
term. A source's distance to another is a sum over all terms of the language: terms are dealt into blocks, each
block's shares are a matrix of terms and sources in numpy, and Spark adds up the blocks' sums. Shares are whole
numbers, reckoned with decimals, so the results are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm import common

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """A stable order of rows of unsigned 64-bit words, the first column being the highest: by digits of 16 bits from
    the lowest up, each sorted by radix. Digits that all rows share are left out."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        for shift in (0, 16, 32, 48):
            digit = (column >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed_words(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """One or two words of each term, the first byte highest, zeros after its end. ``data`` has 16 bytes after the last term."""
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)

    def word(at, n):
        gap = (8 - n).astype(np.uint64) << np.uint64(3)
        return windows[at].view(">u8").ravel().astype(np.uint64) >> gap << gap

    if size.max(initial=0) <= 8:
        return [word(start, size)]
    return [word(start, np.full(len(start), 8)), word(start + 8, size - 8)]


def runs(data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray, doc: np.ndarray):
    """(terms, group, n, docs) of each run of equal terms of a group, bucket by bucket; terms are numpy bytes.
    ``group`` never falls, nor does ``doc`` within one; ``data`` is padded with 16 bytes or the longest term's width."""
    width = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w <= 16:
            columns = packed_words(data, start[own], size[own])
            order = radix_order(columns)
            terms = np.stack(columns, axis=1)[order].astype(">u8").view(f"S{w}").ravel()
        else:
            bytes_ = np.lib.stride_tricks.sliding_window_view(data, w)[start[own]]
            bytes_[np.arange(w) >= size[own, None]] = 0
            terms = bytes_.view(f"S{w}").ravel()
            order = np.argsort(terms, kind="stable")
            terms = terms[order]
        own = own[order]
        other = np.ones(len(own), bool)
        other[1:] = terms[1:] != terms[:-1]
        begins, next_doc = other.copy(), other.copy()
        begins[1:] |= np.diff(group[own]) != 0
        next_doc[1:] |= np.diff(doc[own]) != 0
        at = np.flatnonzero(begins)
        yield terms[at], group[own[at]], np.diff(np.append(at, len(own))), np.add.reduceat(next_doc.astype(np.int64), at)


def _counted(source: DataFrame, chunk: int) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term of a group; the term '' stands for the group."""

    def run(batches):
        import pyarrow as pa

        for batch, lo, hi in common.chunks(batches, chunk):
            keys = list(zip(*(batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("lang", "source")), strict=True))
            groups = sorted(set(keys))
            number = {k: i for i, k in enumerate(groups)}
            group = np.array([number[k] for k in keys])
            order = np.argsort(group, kind="stable")
            texts = common.text_bytes(batch, lo, hi)
            data, at = common.joined([texts[i] for i in order])
            data = np.append(common.fold_ascii(data), np.zeros(16, np.uint8))
            inside = np.zeros(len(data) + 1, np.int8)
            inside[1:] = _TERM[data]
            edge = np.diff(inside)
            start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            size, doc = end - start, np.searchsorted(at, start, "right") - 1
            data = np.append(data, np.zeros(2 * size.max(initial=0), np.uint8))
            found = [*runs(data, start, size, group[order][doc], doc), (np.full(len(groups), b""), np.arange(len(groups)), np.zeros(len(groups), np.int64), np.bincount(group))]
            names = [pa.array([k[i] for k in groups], pa.string()) for i in (0, 1)]
            for terms, own, n, docs in found:
                own = pa.array(own)
                yield pa.RecordBatch.from_arrays([*(x.take(own) for x in names), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])

    found = source.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, v: str, smoothing: int) -> F.Column:
    """1 + floor(10**9 * (n + smoothing) / (total + smoothing * v))."""
    return F.expr(f"1 + ((cast({n} as decimal(19,0)) + {smoothing}) * 1000000000) div (cast({total} as decimal(19,0)) + cast({v} as decimal(19,0)) * {smoothing})")


def _pairs(shares: DataFrame, groups: DataFrame, cells: int, tile: int) -> DataFrame:
    """(lang, one, other, value, seen): sums of the distance of two sources' shares over the ``seen`` kept terms that some
    source of the same two tiles has, for the numbers of any two sources. ``shares``: lang, no, term, p; ``groups``: lang, no, p0 (share of a term that a source lacks), v."""
    spread = F.expr(f"cast(ceil(v * least(n_sources, {2 * tile}) / {cells}) as int)")
    sized = groups.withColumn("n_sources", F.max("no").over(Window.partitionBy("lang")) + 1)
    sized = sized.select("lang", "no", "p0", F.greatest(spread, F.lit(1)).alias("buckets"), F.expr(f"cast((n_sources - 1) div {tile} as int)").alias("last"))
    per_lang = sized.select("lang", "buckets", "last").distinct()
    rows = shares.join(per_lang, "lang").select("lang", "no", "p", "term", "last", F.pmod(F.xxhash64("term"), "buckets").cast("int").alias("bucket"))
    # A source lies in every bucket, with the share of the terms that it lacks.
    empty = sized.select("lang", "no", F.col("p0").alias("p"), F.lit(None).cast("string").alias("term"), "last", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    rows = rows.unionAll(empty).withColumn("own", F.expr(f"cast(no div {tile} as int)")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last"))))
    rows = rows.select("lang", "bucket", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "no", "term", "p")

    def distances(table):
        import pyarrow as pa

        table = table.combine_chunks()
        no, p = table.column("no").to_numpy(), table.column("p").to_numpy()
        term = table.column("term").combine_chunks().dictionary_encode()
        code = term.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        sources = np.unique(no)
        column = np.searchsorted(sources, no)
        known = code >= 0
        lacks = np.zeros(len(sources), np.int64)
        lacks[column[~known]] = p[~known]
        matrix = np.tile(lacks, (len(term.dictionary), 1))
        matrix[code[known], column[known]] = p[known]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        one, other, value = [], [], []
        for k, x in enumerate(sources):
            if x // tile == low:
                others = np.flatnonzero((sources // tile == high) & (sources > x))
                sums = np.abs(matrix[:, others] - matrix[:, k, None]).sum(axis=0)
                for a, b in ((np.full(len(others), x), sources[others]), (sources[others], np.full(len(others), x))):
                    one.append(a), other.append(b), value.append(sums)
        join = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
        lang = pa.array([table.column("lang")[0].as_py()], pa.string()).take(pa.array(np.zeros(sum(map(len, one)), np.int64)))
        seen = pa.array(np.full(len(lang), len(matrix)))
        return pa.table([lang, join(one), join(other), join(value), seen], ["lang", "one", "other", "value", "seen"])

    sums = rows.groupBy("lang", "bucket", "low", "high").applyInArrow(distances, "lang string, one long, other long, value long, seen long")
    return sums.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


@common.shipped
def audit(
    docs: DataFrame, *, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 30, smoothing: int = 5, top: int = 50,
    chunk: int = 8_000_000, cells: int = 200_000, tile: int = 512,
) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: how far each source of a language is from each other one.
    Part ``term``: the ``top`` terms that a source uses more than its language does.

    Nulls in the three columns count as ''. A language keeps the terms that are in ``min_docs`` of its documents (rows);
    where it keeps none, all pairs have 0 and there are no terms. A source without any term is a source too. Equal
    values are ranked by item in UTF-8 order. Other columns are ignored; an empty table gives no rows. ``chunk``,
    ``cells`` and ``tile`` change the work, never the result.
    """
    source = docs.select(*(common.text_of(c).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = common.materialise(_counted(source, chunk), "term-counts")
    terms = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    terms = common.materialise(terms.drop("docs"), "kept-terms")
    kept = common.materialise(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "kept-counts")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    groups = counts.where("term = ''").select("lang", "source").join(kept.groupBy("lang", "source").agg(F.sum("n").alias("own_n")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["own_n", "v", "lang_n"]).withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    p0 = F.when(F.col("v") > 0, _share("0", "own_n", "v", smoothing)).otherwise(0)
    groups = common.materialise(groups.withColumn("p0", p0), "source-groups")
    common.discard(counts)

    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "no", "term", _share("n", "own_n", "v", smoothing).alias("p"), _share("total", "lang_n", "v", smoothing).alias("q"))
    pairs = _pairs(shares.select("lang", "no", "term", "p"), groups, cells, tile)
    pairs = pairs.join(groups.select("lang", F.col("no").alias("one"), "source", "p0", "v"), ["lang", "one"])
    pairs = pairs.join(groups.select("lang", F.col("no").alias("other"), F.col("source").alias("item"), F.col("p0").alias("other_p0")), ["lang", "other"])
    pairs = pairs.withColumn("value", F.expr("value + (v - seen) * abs(p0 - other_p0)"))  # terms that neither has
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    own = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionAll(own)
