"""SimHash near-duplicate detection with vantage-point trees.

Fingerprints are made in one pass. Distinct ones are dealt to the leaves of a vantage-point tree: at each
node the Hamming distance to a vantage fingerprint decides the side, and a fingerprint whose distance is
within the link radius above the boundary also visits the near side, so by the triangle inequality every
linked pair meets in a leaf. The upper tree is grown on a bounded sample (it only steers the balance);
each leaf goes on splitting locally and compares what is left. Leaves give a spanning forest of their
links, never all pairs, and a distributed component step joins the forests.

``drop_near_duplicates`` also joins documents whose five-word shingles are 0.8 alike. Their fingerprints are
about 10 bits apart, where the distances of a vantage point to all others lie too close together for a tree
to prune; such pairs come from buckets of shingle minima and are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common

_LOCAL_LEAF = 1024


def _fingerprints(texts: list[bytes], size: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for k, text in enumerate(texts):
        data = common.fold_ascii(np.frombuffer(text, np.uint8))
        start, end = common.word_spans(data)
        n = len(start)
        if not n:
            continue
        # words closed up to one space between them: each shingle is then one slice
        keep = np.ones(len(data), bool)
        keep[common._SPACE[data]] = False
        keep[end[:-1]] = True
        line = data.copy()
        line[end[:-1]] = 32
        line = line[keep].tobytes()
        length = end - start
        first = np.cumsum(length + 1) - length - 1
        m = min(size, n)
        a, b = first[: n - m + 1].tolist(), (first + length)[m - 1 :].tolist()
        h = np.array([digest(line[i:j], 42) for i, j in zip(a, b, strict=True)], np.uint64)
        ones = np.zeros(64, np.int64)
        for lo in range(0, len(h), 100_000):
            ones += np.unpackbits(h[lo : lo + 100_000].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) for each row; a null text or one without words has fingerprint 0."""

    def run(batches):
        import pyarrow as pa

        for batch, lo, hi in common.chunks(batches):
            fp = _fingerprints(common.text_bytes(batch, lo, hi), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(fp)], ["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


class Tree:
    """Inner nodes of a vantage-point tree in arrays; children below 0 are leaves (-1 - leaf number)."""

    def __init__(self, sample: np.ndarray, leaves: int, radius: int, seed: int = 7):
        self.radius, self.point, self.bound, self.child = radius, [], [], []
        self.leaves, rng = 0, np.random.default_rng(seed)
        self.root = self._grow(sample, leaves, rng)
        self.point, self.bound, self.child = np.array(self.point, np.uint64), np.array(self.bound), np.array(self.child)

    def _grow(self, x: np.ndarray, leaves: int, rng) -> int:
        split = _best_split(x, self.radius, rng) if leaves > 1 and len(x) > 4 else None
        if split is None:
            self.leaves += 1
            return -self.leaves
        v, mu, d = split
        self.point.append(v)
        self.bound.append(mu)
        self.child.append([0, 0])
        node = len(self.child) - 1
        inner = self._grow(x[d <= mu], leaves // 2, rng)
        outer = self._grow(x[d > mu], leaves - leaves // 2, rng)
        self.child[node] = [inner, outer]
        return node

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): the home leaf of each fingerprint and the leaves it visits over a boundary."""
        rows, leaves, todo = [], [], [(self.root, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -1 - node))
                continue
            d = np.bitwise_count(x[at] ^ self.point[node]).astype(np.int16)
            todo += [(self.child[node][0], at[d <= self.bound[node] + self.radius]), (self.child[node][1], at[d > self.bound[node]])]
        return np.concatenate(rows or [np.zeros(0, int)]), np.concatenate(leaves or [np.zeros(0, int)])


def _best_split(x: np.ndarray, radius: int, rng, tries: int = 6):
    """Of a few vantage points the one whose boundary band is thinnest; None where none helps."""
    best = None
    look = x if len(x) <= 4096 else rng.choice(x, 4096, replace=False)
    for v in rng.choice(x, min(tries, len(x)), replace=False):
        d = np.bitwise_count(look ^ v).astype(np.int16)
        mu = int(np.median(d))
        inner, outer = (d <= mu + radius).mean(), (d > mu).mean()
        if outer > 0 and (best is None or inner**2 + outer**2 < best[0]):
            best = (inner**2 + outer**2, v, mu)
    if best is None or best[0] > 0.95:
        return None
    return best[1], best[2], np.bitwise_count(x ^ best[1]).astype(np.int16)


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a and b, pair by pair; ``root`` has for each index the smallest of its group."""
    while len(a):
        one, two = root[a], root[b]
        apart = one != two
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while not np.array_equal(up := root[root], root):
            root[:] = up


def forest(x: np.ndarray, radius: int) -> np.ndarray:
    """For each of the distinct fingerprints x, the index of the root of its group under links within radius."""
    root, rng = np.arange(len(x)), np.random.default_rng(11)
    todo = [np.arange(len(x))]
    while todo:
        at = todo.pop()
        split = _best_split(x[at], radius, rng, 3) if len(at) > _LOCAL_LEAF else None
        if split is not None:
            _, mu, d = split
            todo += [at[d <= mu + radius], at[d > mu]]
            continue
        own, step = x[at], max(1, 500_000 // len(at))
        for lo in range(0, len(at), step):
            near = np.bitwise_count(own[lo : lo + step, None] ^ own[None, lo:]) <= radius
            i, j = np.nonzero(np.triu(near, 1))
            _unite(root, at[lo + i], at[lo + j])
    return root


def linked(prints: DataFrame, *, radius: int = 3, leaf_size: int = 4_000, max_leaves: int = 131_072) -> tuple[DataFrame, DataFrame]:
    """(fp, min_id), a written table of the distinct fingerprints, and (a, b), links that join those within ``radius``
    bits into groups.

    The sample that grows the upper tree has eight fingerprints a leaf, a million at most; it decides balance,
    never results. Beyond ``max_leaves`` * ``leaf_size`` fingerprints leaves grow.
    """
    spark = prints.sparkSession
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("min_id"))
    distinct = common.materialise(distinct, "fingerprints")
    n = distinct.count()
    leaves = min(max_leaves, max(1, n // leaf_size))
    sample_size = max(65_536, 8 * leaves)
    part = min(1.0, 1.2 * sample_size / max(n, 1))
    pick = distinct.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 30)) < int(part * (1 << 30))).select("fp").limit(sample_size)
    sample = np.array([r[0] for r in pick.collect()], np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(Tree(sample, leaves, radius))

    def route(batches):
        for frame in batches:
            rows, leaves = tree.value.route(frame["fp"].to_numpy(np.int64).view(np.uint64))
            yield pd.DataFrame({"fp": frame["fp"].to_numpy()[rows], "leaf": leaves.astype(np.int64)})

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.unique(frame["fp"].to_numpy(np.int64))
        root = forest(x.view(np.uint64), radius)
        linked = root != np.arange(len(x))
        return pd.DataFrame({"a": x[linked], "b": x[root[linked]]})

    return distinct, distinct.select("fp").mapInPandas(route, "fp long, leaf long").groupBy("leaf").applyInPandas(link, "a long, b long")


def components(prints: DataFrame, *, radius: int = 3) -> DataFrame:
    """(fp, component_id): each distinct fingerprint and the smallest id reachable over links.

    ``prints`` has doc_id and fp and is read several times, so it should be a written table. Null ids are
    ignored for component_id, which is null only if no member has an id.
    """
    distinct, edges = linked(prints, radius=radius)
    comp = common.connected_components(edges)
    rooted = distinct.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "min_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id")


@common.shipped
def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts without words share fingerprint zero and are linked like any other. Repeated rows each get a
    row; null ids stay null and belong to the component of their fingerprint. Empty in, empty out.
    """
    prints = common.materialise(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "prints")
    comp = components(prints, radius=radius).select(F.col("fp").alias("c_fp"), "component_id")
    return prints.join(comp, F.col("fp") == F.col("c_fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- documents whose shingles are alike, beyond the reach of the tree ---------------------------------


def _shingles(texts, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``size`` lower-cased words of each text of an Arrow array;
    a text of fewer words is one shingle, one without words has none."""
    codes, vocabulary, first = common.words_of(texts, fold=True)
    h = common.hash_words(vocabulary)[codes]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = h[a:b]
        n = max(1, len(own) - size + 1) if len(own) else 0
        runs = own[:n].copy()
        for j in range(1, min(size, len(own))):
            runs = common.mix(runs) + own[j : j + n]
        out.append(np.unique(common.mix(runs)))
    return out


def _minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """For each set, which is not empty, its least element under each of ``count`` permutations."""
    factors = np.random.default_rng(5).integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    whole = np.concatenate(sets)
    return np.stack([np.minimum.reduceat(whole * f, starts) for f in factors], 1)


def _sets(source: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, name, shingles, keys) of each text with words: name is a hash of its set of shingles, keys one for each band."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch, lo, hi in common.chunks(batches):
            own = batch.take(pa.array(np.arange(lo, hi)))
            sets = _shingles(own.column("text"), shingle)
            some = np.array([k for k, x in enumerate(sets) if len(x)], np.int64)
            if not len(some):
                continue
            sets = [sets[k] for k in some.tolist()]
            least = _minima(sets, bands * rows)
            keys = np.repeat(np.arange(bands, dtype=np.uint64)[None], len(sets), 0)
            for r in range(rows):
                keys = common.mix(keys * common._ODD + least[:, r::rows])
            names = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], np.uint64)
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x))) for x in ([(v >> np.uint64(32)).astype(np.uint32).view(np.int32) for v in sets], list(keys.view(np.int64)))]
            yield pa.RecordBatch.from_arrays([own.column("doc_id").take(pa.array(some)), pa.array(names.view(np.int64)), *lists], ["doc_id", "name", "shingles", "keys"])

    return source.mapInArrow(run, "doc_id long, name long, shingles array<int>, keys array<long>")


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the (a, b) names of sets that have a Jaccard similarity of at least ``similarity``, as a written table."""
    with common.temporary(sets.sparkSession) as keep:
        pairs = common.materialise(pairs.distinct(), "pairs")
        named = pairs.select(F.explode(F.array("a", "b")).alias("p_name")).distinct()
        paired = common.materialise(sets.join(named, F.col("name") == F.col("p_name"), "left_semi").select("name", "shingles"), "paired-sets")
        one, two = (paired.select(F.col("name").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}")) for x in "ab")
        both = pairs.join(one, F.col("a") == F.col("n_a")).join(two, F.col("b") == F.col("n_b"))
        both = both.where(F.least(F.size("s_a"), F.size("s_b")) >= similarity * F.greatest(F.size("s_a"), F.size("s_b")))
        shared = F.size(F.array_intersect("s_a", "s_b"))
        both = both.where(shared >= similarity * (F.size("s_a") + F.size("s_b") - shared)).select("a", "b")
        return keep(common.materialise(both, "alike"))


def _hub_pairs(keyed: DataFrame, rounds: int, few: int) -> DataFrame:
    pairs = None
    for k in range(rounds):
        first = lambda *by: F.min(F.struct(F.xxhash64("name", F.lit(k), *by).alias("by"), "name"))
        hubs = keyed.groupBy("key").agg(first("key").alias("own"), first().alias("common"), F.count("*").alias("n")).where("n > 1")
        hubs = hubs.select(F.col("key").alias("h_key"), F.when(F.col("n") <= few, F.col("own.name")).otherwise(F.col("common.name")).alias("hub"))
        met = keyed.join(hubs, F.col("key") == F.col("h_key")).where("name <> hub").select(F.least("name", "hub").alias("a"), F.greatest("name", "hub").alias("b"))
        pairs = met if pairs is None else pairs.unionAll(met)
    return pairs


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    roots = common.connected_components(links)
    return members.drop("root").join(roots, F.col("name") == F.col("node"), "left").withColumn("root", F.coalesce("root", "name")).select("root", *(c for c in members.columns if c != "root"))


def _open_buckets(members: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``members`` (key, name, root and more) in buckets that hold several groups, and those buckets (key,
    major: the root of the largest group, light: all pairs across groups take at most ``bound`` a member), as written tables."""
    groups = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    sizes = groups.groupBy("key").agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"), F.max_by("root", F.struct("n", "root")).alias("major"))
    sizes = sizes.where("groups > 1").select("key", "major", (F.col("n") * F.col("n") - F.col("same") <= 2 * bound * F.col("n")).alias("light"))
    sizes = common.materialise(sizes, "open-buckets")
    return common.materialise(members.join(sizes.select("key"), "key", "left_semi"), "bucket-members"), sizes


def _light_pairs(own: DataFrame, sizes: DataFrame) -> DataFrame:
    """All pairs across groups of the light buckets, of sizes that may be alike: members outside the largest group with all of other groups."""
    held = own.select("key", "name", "root", "n", "most").join(sizes.where("light"), "key")
    rest = held.where("root <> major").select("key", *(F.col(c).alias(f"x_{c}") for c in ("name", "root", "n", "most")))
    pairs = held.join(rest, "key").where("root <> x_root and (root = major or name < x_name) and n <= x_most and x_n <= most")
    return pairs.select(F.least("name", "x_name").alias("a"), F.greatest("name", "x_name").alias("b"))


_SLOTS = 1 << 20


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(root, key, name, tail, n, most) of sets (root, name, shingles): each set's first shingles in one order of all shingles, rare
    ones first, as many as make two sets of that similarity share one. ``tail`` is a hash of the set's shingles from this
    one on, ``n`` the set's size, ``most`` the largest size of a set alike with it of which this is the first shingle they share.

    Of a group's sets with one tail a task returns the smallest alone: it is alike with whatever the others are alike with
    there. The order is by counts in ``_SLOTS`` slots of hashes, which are broadcast; it decides how full buckets get, never
    results. Shingles that are alone in their slot are in one set only and no keys.
    """

    def tally(frames):
        n = np.zeros(_SLOTS, np.int64)
        for frame in frames:
            for s in frame["shingles"]:
                np.add.at(n, np.unique(np.asarray(s, np.int32)).view(np.uint32) >> np.uint32(12), 1)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"slot": at.astype(np.int32), "n": n[at]})

    often = sets.select("shingles").mapInPandas(tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    counts = np.zeros(_SLOTS, np.int64)
    counts[often.column("slot").to_numpy()] = often.column("n").to_numpy()
    counts = sets.sparkSession.sparkContext.broadcast(counts)

    def rows(root: int, name: int, s: np.ndarray) -> dict:
        s = np.unique(np.asarray(s, np.int32)).view(np.uint32)
        s = s[np.lexsort((s, counts.value[s >> np.uint32(12)]))].astype(np.uint64)
        first = len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1
        tail = np.cumsum(common.mix(s + common._ODD)[::-1])[::-1][:first]
        most = np.floor((1 + similarity) / similarity * (len(s) - np.arange(first)) + 1e-6).astype(np.int64) - len(s)
        found = {"root": np.full(first, root), "key": s[:first].astype(np.int64), "name": np.full(first, name), "tail": tail.view(np.int64), "n": np.full(first, len(s)), "most": most}
        shared = counts.value[s[:first] >> np.uint64(12)] > 1
        return {c: x[shared] for c, x in found.items()}

    def smallest(out: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([x[c] for x in out]) for c in out[0]}).sort_values(["n", "name"]).drop_duplicates(["root", "key", "tail"])

    def cut(frames):
        for frame in frames:
            out, held = [], 0
            for root, name, s in zip(frame["root"].tolist(), frame["name"].tolist(), frame["shingles"], strict=True):
                out.append(rows(root, name, s))
                held += len(out[-1]["key"])
                if held > 500_000:
                    yield smallest(out)
                    out, held = [], 0
            if out:
                yield smallest(out)

    return sets.select("root", "name", "shingles").mapInPandas(cut, "root long, key long, name long, tail long, n long, most long")


_WORDS = 16  # of 64 bits, in a map of parities


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 1,024 bits for each set: in each slot of hashes, whether the number of elements is odd. Two sets differ
    in at least as many elements as their rows differ in bits."""
    bits = [np.bincount(s.view(np.uint32) & np.uint32(64 * _WORDS - 1), minlength=64 * _WORDS) & 1 for s in sets]
    return np.packbits(np.array(bits, np.uint8), axis=1).view(np.uint64)


def _block_links(one: pd.DataFrame, two: pd.DataFrame, similarity: float) -> list[tuple[int, int]]:
    """Links (name, name) of rows of ``one`` with rows of ``two`` (name, root, n, most, shingles), enough to join the groups
    of all such pairs that are alike. Sizes are compared first, then parities; what is left, exactly."""
    x, y = ([np.unique(np.asarray(s, np.int32)) for s in frame["shingles"]] for frame in (one, two))
    px, py = _parities(x), _parities(y)
    nx, ny, mx, my, name_x, name_y = (frame[c].to_numpy(np.int64) for c in ("n", "most", "name") for frame in (one, two))
    _, root = np.unique(np.concatenate([one["root"].to_numpy(np.int64), two["root"].to_numpy(np.int64)]), return_inverse=True)
    rx, ry = root[: len(x)], root[len(x) :]
    up, found, step = np.arange(len(root)), [], max(1, 200_000 // len(y))
    for lo in range(0, len(x), step):
        at = np.arange(lo, min(lo + step, len(x)))
        i, j = np.nonzero((up[rx[at]][:, None] != up[ry][None]) & (nx[at][:, None] <= my[None]) & (ny[None] <= mx[at][:, None]))
        i += lo
        near = np.bitwise_count(px[i] ^ py[j]).sum(1) <= (1 - similarity) / (1 + similarity) * (nx[i] + ny[j]) + 1e-6
        i, j = i[near], j[near]
        while len(i):
            for a, b in zip(i[:1000].tolist(), j[:1000].tolist(), strict=True):
                if up[rx[a]] == up[ry[b]]:
                    continue
                shared = len(np.intersect1d(x[a], y[b], assume_unique=True))
                if shared >= similarity * (len(x[a]) + len(y[b]) - shared):
                    found.append((int(name_x[a]), int(name_y[b])))
                    up[up == max(up[rx[a]], up[ry[b]])] = min(up[rx[a]], up[ry[b]])
            i, j = i[1000:], j[1000:]
            apart = up[rx[i]] != up[ry[j]]
            i, j = i[apart], j[apart]
    return found


def _heavy_links(members: DataFrame, sets: DataFrame, similarity: float, *, rows: int = 2_048, elements: int = 1_000_000) -> DataFrame:
    """(a, b): links of the members of each bucket (key, name, tail, n, most, root) with the smallest set of each tail in it.

    Both are cut into blocks of about ``rows`` sets and ``elements`` shingles, and each pair of blocks is a group of its
    own; it returns a forest of its links, no other pair leaves it.
    """
    least = members.groupBy("key", "tail").agg(F.min(F.struct("n", "name", "root", "most")).alias("s")).select("key", "s.*")

    def blocks(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / rows, F.sum("n") / elements)).cast("int").alias(name))

    cuts = common.materialise(blocks(members, "n_x").join(blocks(least, "n_y"), "key"), "blocks")
    block = lambda count: F.pmod(F.xxhash64("name", F.lit(3)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ("key", "name", "root", "n", "most")
    one = members.join(cuts, "key").select(*columns, F.lit(0).alias("side"), block("n_x").alias("x"), every("n_y").alias("y"))
    two = least.join(cuts, "key").select(*columns, F.lit(1).alias("side"), every("n_x").alias("x"), block("n_y").alias("y"))
    dealt = one.unionAll(two).join(sets.select(F.col("name").alias("s_name"), "shingles"), F.col("name") == F.col("s_name")).drop("s_name")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame["side"] == 0
        links = _block_links(frame[first], frame[~first], similarity) if first.any() and not first.all() else []
        return pd.DataFrame({"a": [min(p) for p in links], "b": [max(p) for p in links]}, dtype=np.int64)

    return dealt.groupBy("key", "x", "y").applyInPandas(compare, "a long, b long")


def _more(links: DataFrame, found: DataFrame) -> DataFrame:
    merged = common.materialise(links.unionAll(found).distinct(), "alike")
    common.discard(links)
    return merged


def similar_links(sets: DataFrame, *, similarity: float, rounds: int, few: int = 16, bound: int = 16) -> DataFrame:
    """(a, b) names of sets with a Jaccard similarity of at least ``similarity``; not all such pairs, but enough
    to hold together the groups of all pairs that share a key.

    Sets that share a key meet in its bucket. There each is first compared with one of them, the hub, exactly;
    another hub is drawn in each of the ``rounds``. Buckets of up to ``few`` sets draw their hubs independently; larger
    ones go by one order of all sets, so that the many buckets of a large group share their hubs. That links nearly all
    members of a group. Then buckets that still hold several groups are gone through: where that takes at most
    ``bound`` comparisons a member, all pairs across groups are compared, so such a bucket loses no link.

    Sets of heavier buckets (many that are not alike, as of a page template) meet anew under each of their rarest
    shingles, one of which any two that are alike share. Buckets of these are gone through likewise if light. In
    a heavy one, sets that are alike, and of which this is the first shingle they share, have in common what their tails from there
    on have in common; so the smallest set of a tail is alike with whatever any set of that tail is alike with, and comparing
    all sets with the smallest of each tail loses no link. That is done in pairs of blocks. How much is left from a
    shingle on bounds what two sets can share, so most are told apart by their sizes, and most others by parities.
    """
    keyed = sets.select("name", F.explode("keys").alias("key"))
    links = _alike(_hub_pairs(keyed, rounds, few), sets, similarity)
    n = F.size("shingles").cast("long")
    sized = sets.select("name", "keys", n.alias("n"), F.floor(n / similarity + 1e-6).alias("most"))
    own, sizes = _open_buckets(_rooted(sized, links).withColumn("key", F.explode("keys")).drop("keys"), bound)
    found = _alike(_light_pairs(own, sizes), sets, similarity)
    links = _more(links, found)
    heavy = common.materialise(own.join(sizes.where("not light"), "key", "left_semi").select("name").distinct(), "heavy-names")
    for table in (found, own, sizes):
        common.discard(table)
    if heavy.isEmpty():
        return links
    heavy = common.materialise(_rooted(sets.join(heavy, "name", "left_semi").select("name", "shingles"), links), "heavy-sets")
    own, sizes = _open_buckets(_prefixes(heavy, similarity), bound)
    found = _alike(_light_pairs(own, sizes), heavy, similarity)
    members = own.join(sizes.where("not light").select("key"), "key", "left_semi")
    links = _more(links, found.unionAll(_heavy_links(members, heavy, similarity)))
    for table in (found, own, sizes, heavy):
        common.discard(table)
    return links


@common.shipped
def similar_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 3, bands: int = 14, rows: int = 3, rounds: int = 3, **search: int) -> DataFrame:
    """(doc_id, node, component_id) of the rows of ``docs`` that links join to others: the id, a name of the row (the
    id, or a hash of the text where it is null) and the smallest id of the group, null if no member has one.

    Links are fingerprints of ``shingle`` words within ``radius`` bits, found by the vantage-point tree, and sets
    of shingles with a Jaccard similarity of at least ``similarity``. The latter are found in buckets of shingle
    minima, as fingerprints so far apart (about 10 bits) leave a tree nothing to prune, and compared exactly. A
    pair at the limit shares no bucket with a chance of (1 - similarity ** rows) ** bands. Texts without words
    are one group. Repeated rows each get a row. Empty in, empty out. ``search``: see ``similar_links``.
    """
    text = common.text_of(text_col)
    source = docs.select(F.col(id_col).cast("long").alias("own_id"), _node(id_col, text_col).alias("doc_id"), text.alias("text"))
    prints = common.materialise(fingerprints(source, shingle=shingle), "prints")
    same_bits, bits = linked(prints, radius=radius)
    named = common.materialise(_sets(source.select("doc_id", "text"), shingle, bands, rows), "shingle-sets")
    sets = common.materialise(named.groupBy("name").agg(F.min("doc_id").alias("min_id"), F.first("shingles").alias("shingles"), F.first("keys").alias("keys")), "sets")
    owners = common.materialise(named.select("doc_id", "name"), "owners")
    common.discard(named)  # the shingles of repeated sets are not needed again
    alike = similar_links(sets, similarity=similarity, rounds=rounds, **search)

    def ends(links: DataFrame, table: DataFrame, key: str) -> DataFrame:
        """The links between fingerprints or sets as links between the smallest documents that have them."""
        one, two = (table.select(F.col(key).alias(f"key_{x}"), F.col("min_id").alias(f"id_{x}")) for x in "ab")
        return links.join(one, F.col("a") == F.col("key_a")).join(two, F.col("b") == F.col("key_b")).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))

    ties = ends(bits, same_bits, "fp").unionAll(ends(alike, sets, "name"))
    for own, table, key in ((prints, same_bits, "fp"), (owners, sets, "name")):  # documents that share one
        ties = ties.unionAll(own.select("doc_id", key).join(table.select(F.col(key).alias("t_key"), "min_id"), F.col(key) == F.col("t_key")).select("doc_id", "min_id"))
    ties = common.materialise(ties.where("a <> b").distinct(), "ties")
    for table in (prints, owners, sets):
        common.discard(table)
    groups = common.materialise(common.connected_components(ties), "groups")
    members = source.select("own_id", F.col("doc_id").alias("m_node")).join(groups, F.col("m_node") == F.col("node"))
    best = groups.join(members.groupBy("m_node").agg(F.min("own_id").alias("own_id")), F.col("node") == F.col("m_node")).groupBy(F.col("root").alias("b_root")).agg(F.min("own_id").alias("component_id"))
    return members.join(best, F.col("root") == F.col("b_root")).select(F.col("own_id").alias("doc_id"), "node", "component_id")


def _node(id_col: str, text_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(common.text_of(text_col)))


@common.shipped
def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with one document of each group of ``similar_groups``, that with the smallest id.

    Rows without an id stay only if no member of their group has one. Rows that repeat the kept id all stay:
    ids are what tells documents apart.
    """
    with common.temporary(docs.sparkSession) as keep:
        found = similar_groups(docs, id_col=id_col, text_col=text_col, **rule)
        gone = found.where("doc_id <> component_id or (doc_id is null and component_id is not null)").select(F.col("node").alias("__gone")).distinct()
        gone = keep(common.materialise(gone, "near-duplicates"))
    return docs.join(common.if_few(gone, 2_000_000), _node(id_col, text_col) == F.col("__gone"), "left_anti")
