"""Benchmark decontamination with DataFrame functions only.

Every window of ``window`` words of the test items goes into a hash set that is broadcast while its measured
size is under ``broadcast_bytes``; a larger one is joined by a shuffle of the probes. All windows of all
documents are probed against it by a hash of their words; hits are verified word by word on either path, and
what they cover is counted. Words are hashed once; the hashes of windows come from those of 1, 2, 4 and 8 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common
from isohyet.llm.common import id_key, text_of

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: All ASCII characters but digits and letters.
_GAPS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of ASCII digits, letters and anything beyond ASCII."""
    spaced = F.translate(text, _GAPS + _UPPER, " " * len(_GAPS) + _LOWER)
    return F.array_remove(F.split(spaced, " "), "")


def _bind(value: Column, of) -> Column:
    """``of(value)`` with the value worked out once."""
    return F.transform(F.array(value), of)[0]


def window_hashes(tokens: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` tokens; none if there are fewer tokens."""
    both = lambda left, right, at: F.zip_with(left, F.slice(right, at + 1, F.size(right)), lambda a, b: F.xxhash64(a, b))

    def grow(known: dict[int, Column], length: int):
        """``known`` has the hashes of runs of 1, 2, 4, ... words; double until these make up ``size``."""
        if 2 * length <= size:
            return _bind(both(known[length], known[length], length), lambda twice: grow(known | {2 * length: twice}, 2 * length))
        out, have = known[length], length
        while have < size:
            part = 1 << (size - have).bit_length() - 1
            out, have = both(out, known[part], have), have + part
        return F.slice(out, 1, F.greatest(F.size(out) - (size - 1), F.lit(0)))

    return _bind(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: grow({1: h}, 1))


def benchmark_windows(items: DataFrame, window: int = 13, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the items: win (its words), hash, size, item_ids; a written table.

    An item of fewer words than ``window`` is one window of its own length; one without words (or null)
    has none. A null item id still makes hits but is not counted among the items.
    """
    tokens = items.select(F.col(id_col).alias("item_id"), words(text_of(text_col)).alias("w")).where(F.size("w") > 0)
    sized = tokens.withColumn("size", F.least(F.size("w"), F.lit(window)))
    each = None
    for size in range(1, window + 1):
        runs = F.transform(window_hashes(F.col("w"), size), lambda h, i: F.struct(F.slice("w", i + 1, size).alias("win"), h.alias("hash")))  # noqa: B023
        own = sized.where(F.col("size") == size).select("item_id", "size", F.explode(runs).alias("r")).select("item_id", "size", "r.win", "r.hash")
        each = own if each is None else each.unionAll(own)
    return common.materialise(each.groupBy("win", "hash", "size").agg(F.collect_set("item_id").alias("item_ids")), "windows")


def contamination(docs: DataFrame, items: DataFrame, *, window: int = 13, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated, hits.

    ``hits`` are the word positions (from 0) and lengths of the verified windows. A document is
    contaminated if a word is hit and at least one in ``one_in`` words is. Null or empty
    texts have no words and are clean; repeated rows each get a row; null ids stay null; an empty
    benchmark leaves all clean. Other columns are not read.
    """
    bench = benchmark_windows(items, window)
    weight = F.sum(F.octet_length(F.array_join("win", " ")) + 16 * F.col("size") + 16 * F.size("item_ids") + 100)
    sizes = bench.groupBy("size").agg(weight.alias("bytes")).orderBy("size").collect()  # at most ``window`` rows
    few = sum(r["bytes"] for r in sizes) <= broadcast_bytes
    known = bench.select(F.col("hash").alias("b_hash"), "win", F.col("size").alias("b_size"), "item_ids")
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    tokens = source.select("doc_id", F.xxhash64("t").alias("text_key"), words(F.col("t")).alias("w")).withColumn("n", F.size("w"))
    if few:
        # probes keep their document's words at hand (no copy is made before a hit) to compare those of a hit
        known, probes = F.broadcast(known), _probes(tokens, sizes, ["doc_id", "text_key", "n", "w"])
    else:
        # the many probes are shuffled without words; the few that meet a hash get their words back
        plain = _probes(tokens, sizes, ["doc_id", "text_key"]).where("size > 0")
        met = plain.join(known.select("b_hash", "b_size").distinct(), (F.col("probe") == F.col("b_hash")) & (F.col("size") == F.col("b_size")), "left_semi")
        key = lambda id_col: F.coalesce(F.col(id_col).cast("string"), F.lit(""))
        hit = met.groupBy(key("doc_id").alias("m_id"), F.col("text_key").alias("m_key")).agg(F.collect_set(F.struct("pos", "probe", "size")).alias("met"))
        none = F.struct(F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("probe"), F.lit(0).alias("size"))
        again = tokens.join(hit, (key("doc_id") == F.col("m_id")) & (F.col("text_key") == F.col("m_key")), "left")
        probes = again.select("doc_id", "text_key", "n", "w", F.explode(F.concat(F.array(none), F.coalesce("met", F.slice(F.array(none), 1, 0)))).alias("m")).select("doc_id", "text_key", "n", "w", "m.*")
    verified = F.slice("w", F.greatest("pos", F.lit(0)) + 1, F.greatest("size", F.lit(1))) == F.col("win")
    found = probes.join(known, (F.col("probe") == F.col("b_hash")) & (F.col("size") == F.col("b_size")) & verified, "left").where("size = 0 or win is not null")
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count_if(F.col("size") == 0).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("size") > 0, F.struct(F.col("pos").alias("start"), "size")))).alias("hits"),
        F.collect_set(F.when(F.col("size") > 0, F.col("item_ids"))).alias("sets"),
    )
    item_ids = F.array_sort(F.transform(F.array_distinct(F.flatten("sets")), lambda i: i.cast("string")))
    out = per_doc.select("doc_id", "text_key", "n_words", F.size(_covered("hits")).cast("long").alias("n_hit"), item_ids.alias("items"), "hits", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return out.select(
        "doc_id",
        "text_key",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "hits",
    )


def _covered(hits: str) -> Column:
    """Positions of the words in any of the hits."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))))


def _probes(tokens: DataFrame, sizes: list, keep: list[str]) -> DataFrame:
    """A row for each window of each document (keep..., pos, probe, size) and one of size 0 for the document itself."""
    blank = F.array(F.lit(0).cast("long"))
    if len(sizes) == 1:  # the usual case: one flat array
        size = int(sizes[0]["size"])
        runs = F.concat(blank, window_hashes(F.col("w"), size))
        probes = tokens.withColumn("runs", runs).select(*keep, F.posexplode("runs").alias("at", "probe"))
        return probes.select(*keep, (F.col("at") - 1).alias("pos"), "probe", F.when(F.col("at") == 0, 0).otherwise(size).alias("size"))
    arrays = [F.struct(F.lit(0).alias("size"), blank.alias("runs"))]
    arrays += [F.struct(F.lit(int(r["size"])).alias("size"), window_hashes(F.col("w"), int(r["size"])).alias("runs")) for r in sizes]
    by_size = tokens.withColumn("by_size", F.array(*arrays)).select(*keep, F.explode("by_size").alias("a"))
    return by_size.select(*keep, F.col("a.size").alias("size"), F.posexplode("a.runs").alias("pos", "probe"))


def decontaminate(docs: DataFrame, items: DataFrame, *, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove='spans'``) without the words that were hit.

    Rows are told apart by id and text, nulls included; columns, order of columns and repeated rows stay
    as they are. A text that loses a span becomes its normalised words joined by spaces; others keep
    their text.
    """
    found = contamination(docs, items, id_col=id_col, text_col=text_col, **rule).where("contaminated" if remove == "documents" else "n_hit > 0")
    bad = found.groupBy(F.coalesce("doc_id", F.lit(None)).alias("__bad_id"), F.col("text_key").alias("__bad_text")).agg(F.first("hits").alias("__hits"))
    key = (id_key(id_col) == F.coalesce(F.col("__bad_id").cast("long"), F.lit(-(2**63)))) & (F.xxhash64(text_of(text_col)) == F.col("__bad_text"))
    if remove == "documents":
        return docs.join(bad, key, "left_anti")
    if remove != "spans":
        raise ValueError("remove must be 'documents' or 'spans'")
    tokens = words(text_of(text_col))
    left = _bind(tokens, lambda w: F.transform(F.array_except(F.transform(w, lambda x, i: i), _covered("__hits")), lambda i: w[i]))
    return docs.join(bad, key, "left").withColumn(text_col, F.when(F.col("__hits").isNotNull(), F.array_join(left, " ")).otherwise(F.col(text_col))).select(*docs.columns)
