"""Repeated-phrase removal with sharded Aho-Corasick automata.

Passages are confirmed by counts, shards compile them into automata, and every place of every document where a
passage may be is streamed through the automaton of its shard, which locates all occurrences.

Each window of ``size`` words has an anchor: its least run of ``gram`` words by hash, the leftmost of equals.
Equal windows have equal anchors, so a window can recur only if its anchor does; neighbouring windows mostly
share theirs and form one stretch of words. Spark counts the anchors of all documents and sends the
stretches whose anchor occurs more than once to the shard of the anchor, equal stretches of a task once with
all their places. A shard holds a bounded number of stretches. Its automaton, over word numbers, has as
patterns the stretches of anchors with one wording and the windows of those with several. What it finds in
the stretches are the occurrences; the first place of each pattern stays, all others are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common, repeats
from isohyet.llm.repeats import Rule

WINDOW = Rule(size=20, gram=8, words=True)


def anchors(docs: DataFrame, rule: Rule) -> DataFrame:
    """(h, d, t, s, e) of each stretch of ``docs`` (d, t, text): anchor, document, words from and to."""

    def run(batches):
        import pyarrow as pa

        for batch, lo, hi in common.chunks(batches):
            own = batch.take(pa.array(np.arange(lo, hi)))
            values, first = repeats.units_of(own.column("text"), rule)
            doc, s, e, _, h = repeats.stretches(values, first, rule)
            d, t = (own.column(c).to_numpy()[doc] for c in ("d", "t"))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(d), pa.array(t), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["h", "d", "t", "s", "e"])

    return docs.select("d", "t", "text").mapInArrow(run, "h long, d long, t long, s int, e int")


def cut_out(texts: DataFrame, rule: Rule, shards: int, flush_bytes: int = 6_000_000) -> DataFrame:
    """(shard, h, words, d, t, s) of ``texts`` (d, t, text, places): the words of each place, equal ones of a task
    once; d, t and s are lists of all the documents and positions that have them.

    Places of a hot anchor are cut into single windows, dealt by what they hold.
    """

    def run(batches):
        import pyarrow as pa
        import xxhash

        def flush(found):
            keys, lists = list(found), list(found.values())
            shard = [(xxhash.xxh64_intdigest(w) if hot else h) % shards for h, w, hot in keys]
            columns = [pa.array([x[k::3] for x in lists], pa.list_(kind)) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))]
            return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary()).cast(pa.string()), *columns], ["shard", "h", "words", "d", "t", "s"])

        found, held = {}, 0
        for batch in batches:
            places = batch.column("places")
            starts, flat = places.offsets.to_numpy().tolist(), places.values
            s, e, h, hot = (flat.field(c).to_numpy(zero_copy_only=False).tolist() for c in ("s", "e", "h", "hot"))
            for row, (d, t) in enumerate(zip(batch.column("d").to_pylist(), batch.column("t").to_pylist(), strict=True)):
                words = batch.column("text")[row].as_buffer().to_pybytes().split()
                for k in range(starts[row], starts[row + 1]):
                    for a in range(s[k], e[k] - rule.size + 1) if hot[k] else (s[k],):
                        piece = b" ".join(words[a : a + rule.size if hot[k] else e[k]])
                        own = found.get((h[k], piece, hot[k]))
                        if own is None:
                            own = found[h[k], piece, hot[k]] = []
                            held += len(piece) + 50
                        own += (d, t, a)
                        held += 20
                if held > flush_bytes:
                    yield flush(found)
                    found, held = {}, 0
        if found:
            yield flush(found)

    return texts.select("d", "t", "text", "places").mapInArrow(run, "shard long, h long, words string, d array<long>, t array<long>, s array<int>")


def locate(h: list[int], lines: list[tuple], places: list[np.ndarray], rule: Rule) -> list[np.ndarray]:
    """Rows (d, t, from, to) of all occurrences but the first of what recurs in a shard.

    ``lines`` are the distinct stretches as tuples of word numbers, h their anchors, ``places`` for each an array
    of rows (d, t, s). The automaton finds the patterns in the lines; nothing else tells where they are.
    """
    import ahocorasick

    wordings: dict[int, int] = {}
    for anchor in h:
        wordings[anchor] = wordings.get(anchor, 0) + 1
    automaton, patterns = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE), 0
    for anchor, line in zip(h, lines, strict=True):
        for pattern in (line,) if wordings[anchor] == 1 else (line[i : i + rule.size] for i in range(len(line) - rule.size + 1)):
            if not automaton.exists(pattern):
                automaton.add_word(pattern, (patterns, len(pattern)))
                patterns += 1
    automaton.make_automaton()
    hits = [[(end - n + 1, n, p) for end, (p, n) in automaton.iter(line)] for line in lines]

    order = [x[np.lexsort((x[:, 2], x[:, 0]))] for x in places]
    first: list[tuple[int, int]] = [(2**63, 0)] * patterns
    for own, found in zip(order, hits, strict=True):
        d, s = int(own[0, 0]), int(own[0, 2])
        for at, _, p in found:
            if (d, s + at) < first[p]:
                first[p] = (d, s + at)
    gone = []

    def remove(rows, spans):
        at = 0
        while at < len(spans):
            a, b = spans[at]
            while at + 1 < len(spans) and spans[at + 1][0] <= b:
                at += 1
                b = max(b, spans[at][1])
            gone.append(np.column_stack([rows[:, 0], rows[:, 1], rows[:, 2] + a, rows[:, 2] + b]))
            at += 1

    for own, found in zip(order, hits, strict=True):
        lead = (own[:, 0] == own[0, 0]) & (own[:, 2] == own[0, 2])  # more than one where rows are repeated
        found.sort()
        remove(own[~lead], [(at, at + n) for at, n, _ in found])
        d, s = int(own[0, 0]), int(own[0, 2])
        remove(own[lead], [(at, at + n) for at, n, p in found if first[p] < (d, s + at)])
    return gone


def occurrences(pieces: DataFrame, rule: Rule, shards: int) -> DataFrame:
    """(d, t, s, e): words of ``cut_out`` pieces that occur earlier, shard by shard."""

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks()
        text = table.column("words").dictionary_encode().combine_chunks()
        key = np.stack([table.column("h").to_numpy(), text.indices.to_numpy(zero_copy_only=False).astype(np.int64)], 1)
        pairs, back = np.unique(key, axis=0, return_inverse=True)
        number: dict[str, int] = {}
        split = [tuple([number.setdefault(w, len(number)) for w in line.split(" ")]) for line in text.dictionary.to_pylist()]
        lists = [table.column(c).combine_chunks() for c in ("d", "t", "s")]
        size = np.diff(lists[0].offsets.to_numpy())
        rows = np.stack([x.values.to_numpy().astype(np.int64) for x in lists], 1)
        line = np.repeat(back.reshape(-1), size)
        order = np.argsort(line, kind="stable")
        places = np.split(rows[order], np.searchsorted(line[order], np.arange(1, len(pairs))))
        gone = locate(pairs[:, 0].tolist(), [split[k] for k in pairs[:, 1].tolist()], places, rule)
        out = np.concatenate(gone) if gone else np.zeros((0, 4), np.int64)
        return pa.table([pa.array(out[:, k]) for k in range(4)], ["d", "t", "s", "e"])

    return pieces.repartition(shards, "shard").groupBy("shard").applyInArrow(run, "d long, t long, s long, e long")


@common.shipped
def remove_phrases(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rule: Rule = WINDOW, shard_places: int = 25_000, hot: int = 20_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (kept words joined by one space), n_words, n_removed, kept_sha256.

    Earlier means a smaller id or, in one document, an earlier start. Null texts have no words; a null id
    stays null and counts as the smallest; rows that repeat id and text are one document and lose the same
    words; rows with one id but other texts are ordered by start alone. ``shard_places`` stretches make a
    shard; an anchor with more than ``hot`` of them is dealt window by window. Neither changes the result.
    Empty in, empty out.
    """
    keyed = repeats.keyed(docs, id_col, text_col)
    stretches = common.materialise(anchors(keyed, rule), "anchors")
    recurring = common.materialise(stretches.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("r_h"), "n"), "recurring")
    total = recurring.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = common.shards(total, shard_places)
    places = stretches.join(recurring, F.col("h") == F.col("r_h")).groupBy("d", "t").agg(F.collect_list(F.struct("s", "e", "h", (F.col("n") > hot).alias("hot"))).alias("places"))
    places = common.materialise(places, "places")
    common.discard(stretches)
    found = occurrences(cut_out(keyed.join(places, ["d", "t"]), rule, shards), rule, shards)
    found = common.materialise(found, "occurrences")
    common.discard(places)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, n_words, n_gone, names = [], [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                gone = repeats.gone_mask(len(words), ranges.values)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if gone.any() else b" ".join(words)
                texts.append(kept.decode())
                n_words.append(len(words))
                n_gone.append(int(gone.sum()))
                names.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(names)], ["doc_id", "text", "n_words", "n_removed", "kept_sha256"])

    return repeats.with_ranges(keyed, found).select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, text string, n_words long, n_removed long, kept_sha256 string")

