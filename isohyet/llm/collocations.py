"""Phrases whose words go together, counted in HAT-tries.

Texts are cut at punctuation and line ends into pieces, and these into words. Every place in a piece is a path
of up to four words. A task counts paths in a trie for each language: its upper levels are words that are hot in
the whole corpus, and under the first word that isn't hot hangs a hash container with what follows. A hot word
is a container that has burst: what follows it is told apart by one word more. How far a path bursts depends on
the corpus's word counts alone, so all tasks cut their tries alike, and no container holds more occurrences than
a word that isn't hot has.

A full trie is spilled: each container is one row, its paths sorted and counted. Spark deals the rows out by
prefix and sorts them; each partition then merges the runs of one prefix after the other and keeps the phrases
that are frequent enough. Scores, containment and the ranks of a language are joins and groupings of those.

Words have numbers: the most frequent ones (65,535 at most, the only thing broadcast) by rank, the others by
63 bits of XXH64. Should two words of a language get the same number, another seed is taken, so counts are exact.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm import common

_TABLE = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 * (65 <= b <= 90) for b in range(256))
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 32]] = True
#: Bits of a word's place in a trie's vocabulary: three of them make the key of a container.
_BITS = 21
_MASK = (1 << _BITS) - 1
_HASHED = 1 << 63
GRAM = ("g1", "g2", "g3", "g4")
PREFIX = ("p1", "p2", "p3", "p4")
#: ``run`` has the paths of a container, ENTRY after ENTRY.
RUN = "lang string, p1 long, p2 long, p3 long, p4 long, run binary"
ENTRY = np.dtype([("r1", "<u8"), ("r2", "<u8"), ("r3", "<u8"), ("n", "<u4")])


def pieces_of(texts: list[bytes]):
    """(codes, vocabulary, piece): each word's place among the distinct words (an Arrow array of bytes), and the number of its piece."""
    import pyarrow as pa

    data = b"\n".join([*texts, b""]).translate(_TABLE)
    codes, vocabulary, _ = common.words_of(pa.array([data], pa.large_binary()).view(pa.large_string()))
    data = np.frombuffer(data, np.uint8)
    inside = ~_SEPARATOR[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    return codes, vocabulary, np.cumsum(data == 10, dtype=np.int32)[begins]


def word_ids(vocabulary, seed: int) -> np.ndarray:
    return common.hash_words(vocabulary, seed) | np.uint64(_HASHED)


def by_language(batches, size: int):
    """(lang, texts) of each language of each chunk."""
    for batch, lo, hi in common.chunks(batches, size):
        own: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").slice(lo, hi - lo).to_pylist(), common.text_bytes(batch, lo, hi), strict=True):
            own.setdefault(lang, []).append(text)
        yield own


class HatTrie:
    """Paths of up to four words of one language. ``ids`` are the sorted numbers of the ranked words, ``ranks`` their
    ranks (from 1, the most frequent first); ranks up to ``n_hot`` are hot."""

    def __init__(self, ids: np.ndarray, ranks: np.ndarray, n_hot: int):
        self.ids, self.ranks, self.n_hot = ids, ranks, n_hot
        self.entries = 0
        self.places: dict[int, int] = {}
        #: code of the hot words so far -> the word below them -> what follows (packed places) -> count
        self.nodes: dict[int, dict[int, dict[int, int]]] = {}
        #: paths through nodes of two and three hot words
        self.upper: dict[int, int] = {}

    def full(self, coming: int) -> bool:
        return len(self.places) + coming >= _MASK

    def _numbers(self, vocabulary: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return vocabulary.view(np.int64)
        at = np.minimum(np.searchsorted(self.ids, vocabulary), len(self.ids) - 1)
        return np.where(self.ids[at] == vocabulary, self.ranks[at], vocabulary.view(np.int64))

    def add(self, vocabulary: np.ndarray, codes: np.ndarray, piece: np.ndarray) -> None:
        numbers, places = self._numbers(vocabulary), self.places
        place = np.fromiter((places.setdefault(x, len(places) + 1) for x in numbers.tolist()), np.int64, len(numbers))
        heat = np.where((numbers > 0) & (numbers <= self.n_hot), numbers, 0)
        word, hot = [place[codes]], [heat[codes]]
        for k in (1, 2, 3):
            same = np.zeros(len(codes), bool)
            same[:-k] = piece[k:] == piece[:-k]
            word.append(np.where(same, np.roll(word[0], -k), 0))
            hot.append(np.where(same, np.roll(hot[0], -k), 0))
        one, two, three = hot[0] > 0, (hot[0] > 0) & (hot[1] > 0), (hot[0] > 0) & (hot[1] > 0) & (hot[2] > 0)
        code2 = hot[0] << 16 | hot[1]
        code3 = code2 << 16 | hot[2]
        for code in (code2[two], code3[three]):
            for node, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True)), strict=True):
                self.upper[node] = self.upper.get(node, 0) + n
        node = np.where(three, code3, np.where(two, code2, hot[0]))
        below = np.where(three, word[3], np.where(two, word[2], np.where(one, word[1], word[0])))
        w3, w4 = np.where(one, word[2], word[1]), np.where(one, word[3], word[2])
        rest = np.where(three, 0, np.where(two, word[3] << 2 * _BITS, w3 << 2 * _BITS | w4 << _BITS | np.where(one, 0, word[3])))
        live = np.flatnonzero((below > 0) & ((node > 0) | (rest > 0)))
        live = live[np.lexsort((below[live], node[live]))]
        node, below, rest = node[live], below[live], rest[live].tolist()
        edge = np.flatnonzero((np.diff(node, prepend=-1) != 0) | (np.diff(below, prepend=-1) != 0))
        ends = np.append(edge[1:], len(rest))[: len(edge)]
        for head, x, lo, hi in zip(node[edge].tolist(), below[edge].tolist(), edge.tolist(), ends.tolist(), strict=True):
            kids = self.nodes.get(head)
            if kids is None:
                kids = self.nodes[head] = {}
            container = kids.get(x)
            if container is None:
                container = kids[x] = {}
            before = len(container)
            for key in rest[lo:hi]:
                container[key] = container.get(key, 0) + 1
            self.entries += len(container) - before

    def spill(self, lang: str):
        """An Arrow batch of RUN: a row for each container and each upper node, the paths of each in the order of their words' numbers."""
        import pyarrow as pa

        heads = [(head, x) for head, kids in self.nodes.items() for x in kids]
        containers = [c for kids in self.nodes.values() for c in kids.values()]
        sizes = np.array([len(c) for c in containers], np.int64)
        keys = np.fromiter(chain.from_iterable(containers), np.int64, sizes.sum())
        counts = np.fromiter(chain.from_iterable(c.values() for c in containers), np.int32, sizes.sum())
        numbers = np.array([0, *self.places], np.int64)
        by_number = np.argsort(numbers.view(np.uint64), kind="stable")
        rank = np.empty(len(numbers), np.int64)
        rank[by_number] = np.arange(len(numbers))
        packed = rank[keys >> 2 * _BITS] << 2 * _BITS | rank[keys >> _BITS & _MASK] << _BITS | rank[keys & _MASK]
        order = np.lexsort((packed, np.repeat(np.arange(len(sizes)), sizes)))
        packed, counts = packed[order], counts[order]
        ordered = numbers[by_number]
        n_upper = len(self.upper)
        sizes = np.append(sizes, np.ones(n_upper, np.int64))
        entries = np.zeros(len(packed) + n_upper, ENTRY)
        for name, shift in (("r1", 2 * _BITS), ("r2", _BITS), ("r3", 0)):
            entries[name][: len(packed)] = ordered[packed >> shift & _MASK].view(np.uint64)
        entries["n"] = np.append(counts, np.array([*self.upper.values()], np.int32))
        code = np.array([*(h for h, _ in heads), *self.upper], np.int64)
        last = np.append(numbers[np.array([x for _, x in heads], np.int64)], np.zeros(n_upper, np.int64))
        depth = (code > 0).astype(np.int64) + (code >> 16 > 0) + (code >> 32 > 0)
        prefix = np.zeros((4, len(code)), np.int64)
        for k in range(3):
            has = depth > k
            prefix[k, has] = code[has] >> 16 * (depth[has] - 1 - k) & 0xFFFF
        prefix[depth, np.arange(len(code))] = last
        cut = pa.py_buffer(np.append(0, np.cumsum(sizes) * ENTRY.itemsize).astype(np.int32))
        run = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, cut, pa.py_buffer(entries)])
        langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(code), np.int64)))
        return pa.RecordBatch.from_arrays([langs, *map(pa.array, prefix), run], ["lang", *PREFIX, "run"])


def merged(table, least: int):
    """Of runs whose rows with equal prefixes are neighbours: an Arrow batch (lang, g1 to g4, a) of all phrases of two
    words and more that occur ``least`` times."""
    import pyarrow as pa

    table = table.combine_chunks()
    prefix = np.array([table.column(c).to_numpy() for c in PREFIX])
    lang = table.column("lang").combine_chunks().dictionary_encode()
    new = np.ones(table.num_rows, bool)
    new[1:] = (prefix[:, 1:] != prefix[:, :-1]).any(0) | (np.diff(lang.indices.to_numpy()) != 0)
    first = np.flatnonzero(new)
    run = table.column("run").combine_chunks()
    cut = np.frombuffer(run.buffers()[1], np.int32, len(run) + 1, 4 * run.offset)
    entries = np.frombuffer(run.buffers()[2], np.uint8)[cut[0] : cut[-1]].view(ENTRY)
    group = np.repeat(np.cumsum(new) - 1, np.diff(cut) // ENTRY.itemsize)
    rest, counts = [np.ascontiguousarray(entries[c]) for c in ("r1", "r2", "r3")], entries["n"].astype(np.int64)
    order = np.lexsort((*reversed(rest), group))  # stable: sorted runs are merged
    group, counts, rest = group[order], counts[order], [x[order] for x in rest]
    edge, depth, found = np.zeros(len(group), bool), (prefix[:, first] != 0).sum(0), []
    edge[:1] = True
    for level in range(4):
        own = (group, *rest)[level]
        edge[1:] |= own[1:] != own[:-1]
        start = np.flatnonzero(edge)
        a = np.add.reduceat(counts, start) if len(start) else counts[:0]
        ok = a >= least
        ok &= (depth[group[start]] > 1) if level == 0 else (rest[level - 1][start] != 0)
        start, a = start[ok], a[ok]
        own = group[start]
        grams = prefix[:, first[own]]
        for k in range(level):
            grams[depth[own] + k, np.arange(len(own))] = rest[k][start].view(np.int64)
        found.append((own, grams, a))
    own = np.concatenate([f[0] for f in found])
    grams = np.concatenate([f[1] for f in found], axis=1)
    names = lang.take(pa.array(first[own])).cast(pa.string())
    return pa.RecordBatch.from_arrays([names, *map(pa.array, grams), pa.array(np.concatenate([f[2] for f in found]))], ["lang", *GRAM, "a"])


def _words(source: DataFrame, seed: int, chunk: int) -> DataFrame:
    """(lang, id, word, n) of all words."""

    def run(batches):
        import pyarrow as pa

        for own in by_language(batches, chunk):
            for lang, texts in own.items():
                codes, vocabulary, _ = pieces_of(texts)
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(vocabulary), np.int64)))
                numbers = pa.array(word_ids(vocabulary, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays([langs, numbers, vocabulary.cast(pa.string()), pa.array(np.bincount(codes, minlength=len(vocabulary)))], ["lang", "id", "word", "n"])

    found = source.mapInArrow(run, "lang string, id long, word string, n long")
    return common.materialise(found.groupBy("lang", "id", "word").agg(F.sum("n").alias("n")), "words")


def _numbered_words(source: DataFrame, chunk: int, seeds: int = 8) -> tuple[DataFrame, int]:
    """``_words``, and the first seed for which no two words of a language have one number."""
    for seed in range(seeds):
        words = _words(source, seed, chunk)
        if words.groupBy("lang", "id").count().where("count > 1").limit(1).count() == 0:
            return words, seed
        common.discard(words)
    raise RuntimeError(f"words shared a number under {seeds} seeds")


def _most_frequent(words: DataFrame, most: int) -> DataFrame:
    """(lang, id, n) of the most frequent words: as many whole classes of frequency (64 for each doubling) as have ``most`` words."""
    level = F.floor(F.log2("n") * 64).cast("int")
    sizes = sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True)  # 4,096 rows at most
    fit = np.cumsum([r["count"] for r in sizes]) <= most
    least = min((r["level"] for r, ok in zip(sizes, fit, strict=True) if ok), default=64 * 64)
    return words.where(level >= least).select("lang", "id", "n")


def _grams(source: DataFrame, ranked, n_hot: int, seed: int, least: int, spill: int, chunk: int) -> DataFrame:
    """(lang, g1, g2, g3, g4, a): phrases of two to four words with at least ``least`` occurrences; 0: no word."""
    table: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for lang in {r.lang for r in ranked}:
        own = [(r.id & (2**64 - 1), r.rank) for r in ranked if r.lang == lang]
        ids, ranks = np.array([i for i, _ in own], np.uint64), np.array([k for _, k in own], np.int64)
        order = np.argsort(ids)
        table[lang] = (ids[order], ranks[order])
    shared = source.sparkSession.sparkContext.broadcast(table)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def count(batches):
        tries: dict[str, HatTrie] = {}
        for own in by_language(batches, chunk):
            for lang, texts in own.items():
                codes, vocabulary, piece = pieces_of(texts)
                if lang in tries and tries[lang].full(len(vocabulary)):
                    yield tries.pop(lang).spill(lang)
                if lang not in tries:
                    tries[lang] = HatTrie(*shared.value.get(lang, none), n_hot)
                tries[lang].add(word_ids(vocabulary, seed), codes, piece)
            if sum(t.entries for t in tries.values()) >= spill:
                while tries:
                    lang, trie = tries.popitem()
                    yield trie.spill(lang)
        while tries:
            lang, trie = tries.popitem()
            yield trie.spill(lang)

    def merge(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
            last = np.ones(held.num_rows, bool)
            for c in PREFIX:
                own = held.column(c).to_numpy()
                last &= own == own[-1]
            last &= np.array(held.column("lang").to_pylist(), object) == held.column("lang")[-1].as_py()
            start = int(np.argmax(last))  # the last prefix may go on in the next batch
            if start:
                yield merged(held.slice(0, start), least)
                held = held.slice(start)
        if held:
            yield merged(held, least)

    key = ("lang", *PREFIX)
    runs = source.mapInArrow(count, RUN).repartition(*key).sortWithinPartitions(*key)
    return common.materialise(runs.mapInArrow(merge, "lang string, g1 long, g2 long, g3 long, g4 long, a long"), "grams")


def _gram(*words: str) -> F.Column:
    """A lookup of a part: its words, filled up with zeros."""
    return F.struct(*(F.col(w).alias(f"h{k}") if w else F.lit(0).cast("long").alias(f"h{k}") for k, w in enumerate([*words, "", "", ""][:3], 1)))


def _scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """``grams`` with a cut of least score: score, l, r."""
    parts = {"l1": _gram("g1"), "r1": _gram("g2", "g3", "g4"), "l2": _gram("g1", "g2"), "r2": _gram("g3", "g4"), "l3": _gram("g1", "g2", "g3"), "r3": _gram("g4")}
    asked = F.array(*(F.when(F.col("g3" if p[1] == "2" else "g4") != 0 if p[1] != "1" else F.lit(True), F.struct(F.lit(p).alias("part"), v.alias("h"))) for p, v in parts.items()))
    lookups = grams.select("lang", *GRAM, "a", F.explode(F.array_compact(asked)).alias("x")).select("lang", *GRAM, "a", "x.part", "x.h.*")
    known = words.select("lang", F.col("number").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(0).cast("long").alias("h3"), F.col("n").alias("f"))
    known = known.unionAll(grams.where("g4 = 0").select("lang", "g1", "g2", "g3", "a"))
    sides = [F.max(F.when(F.col("part") == p, F.col("f"))).alias(p) for p in parts]
    found = lookups.join(known, ["lang", "h1", "h2", "h3"]).groupBy("lang", *GRAM, "a").agg(*sides)
    score = lambda k: F.expr(f"(cast(a as decimal(19,0)) * 2000000) div (cast(l{k} as decimal(19,0)) + r{k})")
    cuts = F.array(*(F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in (1, 2, 3)))
    return found.select("lang", *GRAM, "a", F.array_min(cuts).alias("cut")).select("lang", *GRAM, "a", "cut.score", "cut.l", "cut.r")


def _independent(scored: DataFrame, grams: DataFrame, share: int) -> DataFrame:
    """Without phrases of which some longer phrase has ``share`` hundredths. Of all longer ones that hold a phrase, one with a word more is the most frequent."""
    ends = F.array(F.struct(F.col("g1"), F.col("g2"), F.when(F.col("g4") != 0, F.col("g3")).otherwise(0).alias("g3")), F.struct(F.col("g2").alias("g1"), F.col("g3").alias("g2"), F.col("g4").alias("g3")))
    longer = grams.where("g3 <> 0").select("lang", "a", F.explode(ends).alias("x")).groupBy("lang", "x.g1", "x.g2", "x.g3").agg(F.max("a").alias("longer")).withColumn("g4", F.lit(0).cast("long"))
    keep = F.expr(f"longer is null or cast(longer as decimal(38,0)) * 100 < cast(a as decimal(38,0)) * {share}")
    return scored.join(longer, ["lang", *GRAM], "left").where(keep).drop("longer")


@common.shipped
def mine(
    docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = 30, share: int = 80, top: int = 2000,
    most_ranked: int = 65_535, least_hot: int = 100_000, spill: int = 600_000, chunk: int = 3_000_000, salts: int = 256,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases have two to four words and occur ``least`` times within pieces. A null language counts as ``und``, a
    null text is empty, repeated rows count each, other columns are ignored. Ties in the score go to the more
    frequent phrase, then to the first in UTF-8 order. Languages without such a phrase have no rows; an empty
    table gives none. ``most_ranked`` (65,535 at most), ``least_hot``, ``spill``, ``chunk`` and ``salts`` change the
    work, never the result: a word is hot if it makes up 1 / ``most_ranked`` of all words and occurs
    ``least_hot`` times; a trie spills at ``spill`` paths.
    """
    source = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), common.text_of(text_col).alias("text"))
    words, seed = _numbered_words(source, chunk)
    ranked = _most_frequent(words, most_ranked).toPandas().sort_values(["n", "lang", "id"], ascending=[False, True, True])
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = max(least_hot, -(-total // most_ranked))
    ranked["rank"] = np.arange(1, len(ranked) + 1)
    n_hot = int((ranked["n"] >= hot).sum())
    grams = _grams(source, list(ranked.itertuples()), n_hot, seed, least, spill, chunk)

    if len(ranked):
        ranks = docs.sparkSession.createDataFrame(ranked[["lang", "id", "rank"]])
        numbered = words.where(F.col("n") >= least).join(F.broadcast(ranks), ["lang", "id"], "left").select("lang", F.coalesce("rank", "id").alias("number"), "word", "n")
    else:
        numbered = words.select("lang", F.col("id").alias("number"), "word", "n")
    numbered = common.materialise(numbered, "frequent-words")
    best = _independent(_scored(grams, numbered), grams, share).withColumn("salt", F.pmod(F.xxhash64(*GRAM), F.lit(salts)))
    order = [F.desc("score"), F.desc("a")]
    best = best.withColumn("k", F.rank().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("k") <= top)
    own = best.select("*", F.posexplode(F.array_remove(F.array(*GRAM), 0)).alias("at", "number"))
    spelt = own.join(numbered.select("lang", "number", "word"), ["lang", "number"]).groupBy("lang", *GRAM, "salt", "a", "l", "r", "score")
    spelt = spelt.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order.append(F.asc("phrase"))
    for group in (["lang", F.col("salt") % 16], ["lang"]):
        spelt = spelt.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= top)
    sums = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return spelt.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
