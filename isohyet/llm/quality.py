"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is fitted on all flagged labelled documents and on one half of all trusted ones; the other half sets the
limits. The log probability of a text is a sum of weights of its words and bigrams, each found by its hash: what a
word gives above an unknown one, together with what it takes as a context, and what a bigram that was seen adds to
that. The most frequent weights are broadcast, up to a measured number; whatever a text has besides is shuffled by
hash to the rest of the weights, in slices of documents, so that little of it is on disk at a time. A map of bits says
which words the model has: words without a bit have no weight, nor have their bigrams, so those are not shuffled. Limits are
exact quantiles of the perplexity of all trusted documents of a language that the model has not seen: above the
upper one is text unlike trusted text, below the lower one text that repeats itself. Few tokens of abuse
hardly move a perplexity, so the same smoothing is also fitted to flagged documents and what a document's
tokens gain under it, beyond a margin, is held against the upper quantile of such gains.
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common

_TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
_START, _END = 7, 11  # stand for the hashes of what is before and after a text


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, and runs of other signs."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def _pairs(source: DataFrame, *keep: str) -> DataFrame:
    """One row per token: hashes of the token before (a fixed one at the start) and of its own; one with nulls for a text without tokens."""
    hashed = source.select(*keep, F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    zipped = F.arrays_zip(F.slice(F.concat(F.array(F.lit(_START).cast("long")), "h"), F.lit(1), F.size("h")).alias("v"), F.col("h").alias("w"))
    return hashed.select(*keep, F.posexplode_outer(zipped).alias("pos", "t")).select(*keep, "pos", F.col("t.v").alias("v"), F.col("t.w").alias("w"))


def _discount(counts: DataFrame, column: str) -> dict[str, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    n = counts.agg(*[F.count_if(F.col(column) == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in n)
    if not (n1 and n2 and n3):  # too few n-grams to estimate
        return {"d1": 0.5, "d2": 0.75, "d3": 0.9}
    y = n1 / (n1 + 2 * n2)
    return {"d1": max(0.05, 1 - 2 * y * n2 / n1), "d2": max(0.05, 2 - 3 * y * n3 / n2), "d3": max(0.05, 3 - 4 * y * n4 / n3)}


def _discounted(column: str, d: dict[str, float]) -> Column:
    c = F.col(column)
    return F.when(c == 1, d["d1"]).when(c == 2, d["d2"]).otherwise(d["d3"])


class KneserNey:
    """Tables of an interpolated modified Kneser-Ney bigram model: bigrams (v, w, c, lp2, lift), contexts (v, n, g), words (w, a, c, p).
    ``lift`` is what lp2 has above the log probability of a bigram that was not seen. Contexts are written when first asked for."""

    def __init__(self, source: DataFrame, label: str):
        self._fit(common.materialise(_counted(_pairs(source)), f"kn-{label}"), label)

    @classmethod
    def of_counts(cls, counts: DataFrame, label: str) -> KneserNey:
        """The model of a written table of bigrams (v, w, c)."""
        made = cls.__new__(cls)
        made._fit(counts, label)
        return made

    def _fit(self, raw: DataFrame, label: str) -> None:
        types = common.materialise(raw.groupBy("w").agg(F.count("*").alias("a"), F.sum("c").alias("c")), f"kn-{label}-words")
        d1 = _discount(types, "a")
        total, size, freed = types.agg(F.coalesce(F.sum("a"), F.lit(0)), F.count("*"), F.coalesce(F.sum(_discounted("a", d1)), F.lit(0.0))).first()
        total, share = max(total, 1), (freed or 1.0) / max(total, 1) / (size + 1)
        self.unknown, self.size = float(share), size  # probability of a word never seen, number of words
        self.words = types.select("w", "a", "c", ((F.col("a") - _discounted("a", d1)) / total + share).alias("p"))
        self._raw, self._label = raw, label

    @functools.cached_property
    def _d2(self) -> dict[str, float]:
        return _discount(self._raw, "c")

    @functools.cached_property
    def contexts(self) -> DataFrame:
        contexts = self._raw.groupBy("v").agg(F.sum("c").alias("n"), F.sum(_discounted("c", self._d2)).alias("freed"))
        return common.materialise(contexts.select("v", "n", (F.col("freed") / F.col("n")).alias("g")), f"kn-{self._label}-contexts")

    @functools.cached_property
    def bigrams(self) -> DataFrame:
        small = F.broadcast if self.size <= 1_000_000 else (lambda table: table)  # there are no more contexts than words, but for the start
        full = self._raw.join(small(self.contexts), "v").join(small(self.words.select("w", "p")), "w")
        seen, unseen = (F.col("c") - _discounted("c", self._d2)) / F.col("n"), F.col("g") * F.col("p")
        return full.select("v", "w", "c", F.log(seen + unseen).alias("lp2"), F.log1p(seen / unseen).alias("lift"))

    def weights(self) -> DataFrame:
        """(key, c, value): what each word (key: its hash), bigram (key: of both) and end of a text adds to the log
        probability of a text of unknown words. A word has with it what it takes as a context, which an end takes back."""
        contexts = self.contexts.select("v", F.log("g").alias("lg"))
        words = self.words.join(contexts, F.col("w") == F.col("v"), "left")
        words = words.select(F.col("w").alias("key"), "c", (F.log("p") - math.log(self.unknown) + F.coalesce("lg", F.lit(0.0))).alias("value"))
        bigrams = self.bigrams.select(F.xxhash64("v", "w").alias("key"), "c", F.col("lift").alias("value"))
        ends = contexts.select(F.xxhash64("v", F.lit(_END).cast("long")).alias("key"), F.lit(0).cast("long").alias("c"), (-F.col("lg")).alias("value"))
        return words.unionAll(bigrams).unionAll(ends)


def _counted(pairs: DataFrame, *keep: str) -> DataFrame:
    return pairs.where("w is not null").groupBy(*keep, "v", "w").agg(F.count("*").alias("c"))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _xxhash64(x: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """XXH64 of 64-bit words; ``F.xxhash64(v, w)`` is that of w with that of v, with seed 42, as its seed."""
    turn = lambda y, n: (y << np.uint64(n)) | (y >> np.uint64(64 - n))
    h = turn(((seed + _P5) + np.uint64(8)) ^ (turn(x * _P2, 31) * _P1), 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _keys(h: np.ndarray, first: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(keys, doc): the hashes of all words, and then those of all bigrams, of texts whose words' hashes are ``h``, from
    ``first`` on (one more entry); and the text that each is in. A text has an end and so one more bigram than words.
    With ``known``, words for which it is false are left out, and so are their bigrams."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    at, doc2 = np.arange(len(h)) + doc, np.repeat(np.arange(len(n)), n + 1)
    v, w = np.full(len(h) + len(n), _START, np.uint64), np.full(len(h) + len(n), _END, np.uint64)
    v[at + 1], w[at] = h, h
    if known is not None:
        before, own = np.ones((2, len(v)), bool)
        before[at + 1], own[at] = known, known
        both = before & own
        h, doc, v, w, doc2 = h[known], doc[known], v[both], w[both], doc2[both]
    return np.concatenate([h, _xxhash64(w, _xxhash64(v, np.uint64(42)))]), np.concatenate([doc, doc2])


def _word_map(words: DataFrame, size: int) -> np.ndarray:
    """Bits, as bytes, at the first bits of hashes: set where a word (w) of ``words``, ``size`` in number, has these.
    There are 16 to 32 bits a word, but 2 ** 28 (32 MB) at most: then more words pass that the model doesn't have."""
    wide = min(max(15, (16 * size).bit_length()), 28)
    place = F.shiftrightunsigned("w", 64 - wide) + 1  # Spark counts from 1
    parts = words.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(1 << (wide - 3), np.uint8)
    for part, bits in parts.toLocalIterator():
        out[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _mapped(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(65 - (8 * len(bits)).bit_length())
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _indexed(table: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys in order, their values, where keys with each beginning are) of a table of distinct hashes and values."""
    got = table.toArrow()
    keys, values = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()
    order = np.argsort(keys)
    keys, wide = keys[order], max(16, (2 * len(keys)).bit_length())
    return keys, values[order], np.cumsum([0, *np.bincount((keys >> np.uint64(64 - wide)).astype(np.int64), minlength=1 << wide)], dtype=np.int32)


def _places(named: np.ndarray, keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where each of ``named`` is among ``keys``, -1 if it isn't there; few keys share a beginning."""
    out = np.full(len(named), -1, np.int32)
    beginning = named >> np.uint64(65 - (len(begins) - 1).bit_length())
    at, end = begins[beginning], begins[beginning + np.uint64(1)]
    left = np.flatnonzero(at < end)
    at, end = at[left], end[left]
    while len(left):
        same = keys[at] == named[left]
        out[left[same]] = at[same]
        at += 1
        more = ~same & (at < end)
        left, at, end = left[more], at[more], end[more]
    return out


def _met(source: DataFrame, held: Broadcast, tokens_at_once: int = 500_000) -> DataFrame:
    """(doc_id, text_key, lang, n, value, gain, tail) of texts: the number of tokens, the sums of the broadcast weights
    and gains, and the keys that have no weight there but may have one. ``held``: weights and gains, indexed, and a map of words, if any."""

    def run(batches):
        import pyarrow as pa

        (head_keys, head_values, head_begins), (gain_keys, gain_values, gain_begins), word_map = held.value
        for batch in batches:
            hashes = batch.column("h")
            offsets, words = hashes.offsets.to_numpy().astype(np.int64), hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + tokens_at_once, "right")) - 1)
                h, first = words[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                keys, doc = _keys(h, first, None if word_map is None else _mapped(h, word_map))
                at = _places(keys, head_keys, head_begins)
                value = np.bincount(doc[at >= 0], head_values[at[at >= 0]], hi - lo).astype(float)
                told = _places(h, gain_keys, gain_begins)
                of = np.repeat(np.arange(hi - lo), np.diff(first))
                gain = np.bincount(of[told >= 0], gain_values[told[told >= 0]], hi - lo).astype(float)
                missed = np.flatnonzero(at < 0)
                missed = missed[np.argsort(doc[missed], kind="stable")]
                tail = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *np.bincount(doc[missed], minlength=hi - lo)]).astype(np.int32)), pa.array(keys[missed].view(np.int64)))
                own = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key", "lang")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(first)), pa.array(value, pa.float64()), pa.array(gain, pa.float64()), tail], ["doc_id", "text_key", "lang", "n", "value", "gain", "tail"])
                lo = hi

    hashed = source.select("doc_id", "text_key", "lang", F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    return hashed.mapInArrow(run, "doc_id long, text_key long, lang string, n long, value double, gain double, tail array<long>")


def _least_count(weights: DataFrame, limit: int) -> int:
    """The least power of 2 ** (1 / 4) such that at most ``limit`` weights have that count or more."""
    bands = weights.where("c > 0").groupBy(F.floor(4 * F.log2("c")).cast("int").alias("band")).agg(F.count("*").alias("n")).collect()  # a few hundred at most
    held, least = 0, 2**63 - 1
    for band, n in sorted(bands, reverse=True):
        held += n
        if held > limit:
            break
        least = math.ceil(2 ** (band / 4) - 1e-9)
    return least


def _sums(source: DataFrame, head: DataFrame, rest: DataFrame | None, gains: DataFrame, slices: int, word_map: np.ndarray | None = None) -> DataFrame:
    """(doc_id, text_key, lang, n, value, gain): the number of tokens and the sums of all weights and gains of each text."""
    held = source.sparkSession.sparkContext.broadcast((_indexed(head), _indexed(gains), word_map))
    out = None
    for k in range(slices if rest is not None else 1):
        own = source if rest is None else source.where(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(slices)) == k)
        met = _met(own, held)
        if rest is None:
            return met.drop("tail")
        met = common.fresh_ids(met, "row", "met")
        # each key is there once, so a hash table of a part's weights saves sorting both sides
        tails = met.select("row", F.explode("tail").alias("key")).join(rest.hint("shuffle_hash"), "key").groupBy(F.col("row").alias("t_row")).agg(F.sum("value").alias("more"))
        whole = met.join(tails, F.col("row") == F.col("t_row"), "left").select("doc_id", "text_key", "lang", "n", (F.col("value") + F.coalesce("more", F.lit(0.0))).alias("value"), "gain")
        whole = common.materialise(whole, "sums")
        common.discard(met)
        out = whole if out is None else out.unionAll(whole)
    held.unpersist()
    return out


@common.shipped
def assess(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = 0.999, margin: float = 3.0, support: float = 0.04, broadcast_limit: int = 1_000_000, slices: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, lang, n_tokens, perplexity, min_perplexity,
    max_perplexity, evidence, max_evidence, keep.

    The model is of all flagged documents and of the trusted ones with even id hashes, limits are of the other trusted
    ones. ``broadcast_limit`` bounds the weights and the ids, of some 40 bytes each, that are broadcast, and ``slices``
    is the number of parts in which texts meet the other weights; both change the work, never the result. Weights are
    told apart by 64-bit hashes. A language without trusted documents (null
    included) takes the limits of all languages; without any trusted document everything with tokens is
    kept. Only words with at least ``support`` times as many left neighbours among flagged documents as there
    are such documents can be held against a text. A document without tokens (null text too) has no perplexity and is rejected. Repeated rows each
    get a row; a label table with several rows for an id counts it as trusted only if all agree.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    kind = labels.where("doc_id is not null").groupBy("doc_id").agg(((F.min("quality") >= 1) & (F.max("toxic") <= 0)).alias("trusted"), ((F.min("quality") < 1) | (F.max("toxic") > 0)).alias("flagged"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0  # the other half of the trusted documents never goes into the model
    good_or_bad = F.when(F.col("trusted") & fold, True).when(F.col("flagged"), False)
    chosen = common.materialise(kind.select("doc_id", good_or_bad.alias("good")).where("good is not null"), "chosen")
    n_chosen, n_bad = chosen.agg(F.count("*"), F.count_if(~F.col("good"))).first()
    fit = source.select("doc_id", "text").join(F.broadcast(chosen) if n_chosen <= broadcast_limit else chosen, "doc_id")
    raw = common.materialise(_counted(_pairs(fit, "good"), "good"), "kn")
    good, bad = (KneserNey.of_counts(raw.where(which).drop("good"), which.replace(" ", "-")) for which in ("good", "not good"))

    # words that few flagged documents have say little, however rare they are in trusted text; there are at most
    # (mean tokens of a flagged document) / support of the others
    telling = bad.words.where(F.col("a") >= support * n_bad).select(F.col("w").alias("t_key"), F.col("p").alias("q"))
    telling = common.materialise(telling, "telling")
    telling = telling.join(good.words.select("w", "p"), F.col("t_key") == F.col("w"), "left")
    gain = F.log("q") - F.log(F.coalesce("p", F.lit(good.unknown))) - margin
    telling = common.materialise(telling.select("t_key", gain.alias("gain")).where("gain > 0"), "gains")
    began = good.contexts.where(F.col("v") == _START).select(F.log("g")).first()
    weights = common.materialise(good.weights(), "weights")
    common.discard(raw)
    common.discard(good.contexts)
    size = weights.count()
    few = size <= broadcast_limit
    least = 0 if few else _least_count(weights, broadcast_limit)
    head, rest = weights.where(F.col("c") >= least).select(F.col("key"), "value"), weights.where(F.col("c") < least).select("key", "value")

    word_map = None if few else _word_map(good.words, good.size)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // 500_000)  # so that a part's hash table stays small
    with common.session_settings(docs.sparkSession, spark__sql__shuffle__partitions=str(parts)):
        sums = _sums(source.withColumn("text_key", F.xxhash64("text")), head, None if few else rest, telling, slices, word_map)
    lp = F.col("n") * math.log(good.unknown) + (began[0] if began else 0.0) + F.col("value")
    per_doc = sums.select("doc_id", "text_key", "lang", F.col("n").alias("n_tokens"), F.exp(-lp / F.expr("nullif(n, 0)")).alias("perplexity"), F.col("gain").alias("evidence"))
    scored = common.materialise(per_doc, "scored")

    unseen = kind.where(F.col("trusted") & ~fold).select("doc_id")
    trusted = common.materialise(scored.join(unseen, "doc_id", "left_semi").where("perplexity is not null"), "trusted")
    def limits(end: str) -> list[Column]:
        """Quantiles, moved out by 6 / sqrt(n) of their distance from the median: few documents say little of the tails."""
        q = lambda c, share: F.percentile(F.round(c, 4), share)  # noqa: E731  exact, of values few enough to count
        slack = F.try_divide(F.lit(6.0), F.sqrt(F.count("perplexity")))
        lp = F.log("perplexity")
        low, mid, high = q(lp, 1 - quantile), q(lp, 0.5), q(lp, quantile)
        return [F.exp(low - (mid - low) * slack).alias(f"p_min_{end}"), F.exp(high + (high - mid) * slack).alias(f"p_max_{end}"), (q(F.col("evidence"), quantile) * (1 + slack)).alias(f"e_max_{end}")]

    by_lang = trusted.where("lang is not null").groupBy(F.col("lang").alias("l_lang")).agg(*limits("lang"))
    overall = trusted.agg(*limits("all")).first()
    by_lang = common.materialise(by_lang, "limits")
    if by_lang.count() <= 10_000:
        by_lang = F.broadcast(by_lang)
    none = float("inf")
    judged = scored.join(by_lang, F.col("lang") == F.col("l_lang"), "left").withColumns({
        "min_perplexity": F.coalesce("p_min_lang", F.lit(0.0 if overall.p_min_all is None else overall.p_min_all)),
        "max_perplexity": F.coalesce("p_max_lang", F.lit(none if overall.p_max_all is None else overall.p_max_all)),
        "max_evidence": F.coalesce("e_max_lang", F.lit(none if overall.e_max_all is None else overall.e_max_all)),
    })
    keep = F.col("perplexity").between(F.col("min_perplexity"), F.col("max_perplexity")) & (F.col("evidence") <= F.col("max_evidence"))
    return judged.select("doc_id", "text_key", "lang", "n_tokens", "perplexity", "min_perplexity", "max_perplexity", "evidence", "max_evidence", F.coalesce(keep, F.lit(False)).alias("keep"))


@common.shipped
def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` without the documents that ``assess`` rejects; columns and repeated rows stay as they are."""
    with common.temporary(docs.sparkSession) as keep:
        bad = assess(docs, labels, id_col=id_col, text_col=text_col, **rule).where("not keep")
        bad = bad.select(F.coalesce("doc_id", F.lit(common.NULL_ID)).alias("__bad_id"), F.col("text_key").alias("__bad_text")).distinct()
        bad = keep(common.materialise(bad, "rejected"))
    key = (common.id_key(id_col) == F.col("__bad_id")) & (F.xxhash64(common.text_of(text_col)) == F.col("__bad_text"))
    return docs.join(common.if_few(bad), key, "left_anti")
