"""Language-model scoring with a weighted backoff automaton.

Every word, bigram and trigram of the training texts is counted and is a state, whatever its count. An arc
from context h to word w has the weight (c(hw) + k * p(w | h')) / (c(h) + k), where h' is the longest proper
suffix of h; a word that h has no arc for takes the failure arc to h', of weight k / (c(h) + k). The root's
arcs are the smoothed word frequencies, so the weights of any state sum to one.

Texts are dealt into written blocks. A block sends each of its distinct n-grams once, with its count in
training texts, to the shard of the n-gram's hash; the shard adds up and answers with the totals in the
order in which it was asked. A block then makes one pass over its texts from left to right, which carries
the state (the context and its count) from token to token and adds up log weights. The states of a shard
and the n-grams of a block are bounded; their numbers grow with the input. One n-gram that a third of all
texts have is one entry for each block. Rows hold numbers as bytes, in as few as they need: as lists of longs
they take several times the memory wherever Spark reads, sorts or sends them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common

#: Stands for the end of a text; words have XXH64 hashes.
END = 0x5EED0E0D0E0D0E0D
_ODD = np.uint64(0x9E3779B97F4A7C15)
BLOCK = "block long, doc_id array<long>, held_out array<boolean>, first array<int>, words binary, codes binary, n_tokens long"


def narrow(x: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(small, large): counts in the small type ``kind``, whose greatest value says that the next of ``large`` counts."""
    top = np.iinfo(kind).max
    return np.minimum(x, top).astype(kind), x[x >= top].astype(np.int64)


def widen(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """The counts that ``narrow`` got."""
    x = small.astype(np.int64)
    x[small == np.iinfo(small.dtype).max] = large
    return x


def as_bytes(x: np.ndarray, cut: np.ndarray):
    """An Arrow array of the bytes of each stretch of numbers from one cut to the next."""
    import pyarrow as pa

    ends = pa.array(np.asarray(cut, np.int64) * x.itemsize, pa.int32())  # raises beyond 2 GB
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(x))])


def from_bytes(column, kind: type) -> np.ndarray:
    """The numbers of all rows of an Arrow array of bytes, one after the other."""
    import pyarrow as pa

    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].view(kind)


def block_of(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, words, codes) of an Arrow array of texts: where each text's tokens begin (one more entry), the
    hash of each distinct token, and each token's place among these. The end token is the last word."""
    codes, vocabulary, words = common.words_of(texts, fold=True)
    n = np.diff(words)
    first = words + np.arange(len(words))
    out = np.full(first[-1], len(vocabulary), np.int32)
    out[np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)] = codes
    return first, np.append(common.hash_words(vocabulary), np.uint64(END)), out


def place_of(first: np.ndarray) -> np.ndarray:
    """Place of each token in its text."""
    return np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))


def ngrams(words: np.ndarray, codes: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, at, which): sorted 64-bit names of the block's distinct n-grams, the tokens that end one, and which it is."""
    if order == 1:
        names, back = np.unique(common.mix(words), return_inverse=True)
        return names, np.arange(len(codes)), back[codes]
    last = name = words[codes]
    for n in range(1, order):
        name = last + np.append(np.uint64(0), common.mix(name[:-1] * _ODD + np.uint64(n)))
    at = np.flatnonzero(place >= order - 1)
    names, which = np.unique(common.mix(name[at]), return_inverse=True)
    return names, at, which


def dealt(names: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram, in ascending order as the names are."""
    return ((names >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def traverse(counts: list[np.ndarray], place: np.ndarray, total: int, types: int, strength: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """log10 weights (of the root alone, of the automaton) of each token; ``counts[n]`` are those of the
    (n + 1)-grams that end at each token. The context of a token is the n-gram that ended at the one before."""
    root = p = (counts[0] + 0.5) / (total + 0.5 * (types + 1))
    for n, k in enumerate(strength, 1):
        context = np.zeros(len(p))
        context[1:] = counts[n - 1][:-1]
        p = np.where(place >= n, (counts[n] + k * p) / (context + k), p)
    return np.log10(root), np.log10(p)


def _blocks(source: DataFrame, block_bytes: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        for batch, lo, hi in common.chunks(batches, block_bytes):
            own = batch.take(pa.array(np.arange(lo, hi)))  # a copy: lists of slices are not sent whole
            first, words, codes = block_of(own.column("text"))
            codes = codes.astype(np.uint16) if len(words) <= 1 << 16 else codes
            lists = [one(own.column("doc_id")), one(own.column("held_out")), one(pa.array(first.astype(np.int32))), as_bytes(words, [0, len(words)]), as_bytes(codes, [0, len(codes)])]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([len(codes)])], ["doc_id", "held_out", "first", "words", "codes", "n_tokens"])

    schema = BLOCK.removeprefix("block long, ")
    found = source.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())
    return common.materialise(found.select(*[c.split()[0] for c in BLOCK.split(", ")]), "blocks", common.ROW_BY_ROW)


def _arrays(batch, row: int) -> dict[str, np.ndarray]:
    """first, words, codes and place of one block, and which of its tokens are in training texts."""
    out = {c: batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("first", "held_out")}
    words, codes = (batch.column(c)[row].as_buffer() for c in ("words", "codes"))
    out["words"] = np.frombuffer(words, np.uint64)
    out["codes"] = np.frombuffer(codes, np.uint16 if len(out["words"]) <= 1 << 16 else np.int32).astype(np.int32)
    out["place"] = place_of(out["first"].astype(np.int64))
    out["train"] = np.repeat(~out["held_out"].astype(bool), np.diff(out["first"]))
    return out


def _narrowed(counts: np.ndarray, cut: np.ndarray, kind: type) -> list:
    """Arrow arrays of the bytes of ``narrow`` for each stretch of counts from one cut to the next."""
    small, large = narrow(counts, kind)
    return [as_bytes(small, cut), as_bytes(large, np.append(0, np.cumsum(small == np.iinfo(kind).max))[cut])]


def _totals(blocks: DataFrame, order: int, shards: int) -> DataFrame:
    """(block, shard, totals, large): of the n-grams that a block has in a shard, in the order of ``ngrams``, the
    counts in all training texts, as ``narrow`` has them. Block -1 has, for each shard, the number of n-grams with
    a count (types) and their sum (tokens)."""

    def ask(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                b = _arrays(batch, row)
                names, at, which = ngrams(b["words"], b["codes"], b["place"], order)
                counts = np.bincount(which, b["train"][at], len(names)).astype(np.int64)
                shard = dealt(names, shards)
                edge = np.flatnonzero(np.diff(shard, prepend=shard[0] + 1 if len(shard) else 0))
                cut = np.append(edge, len(names))
                lists = [as_bytes(names, cut), *_narrowed(counts, cut, np.uint8)]
                block = pa.array(np.full(len(edge), batch.column("block")[row].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(shard[edge]), block, *lists], ["shard", "block", "names", "counts", "large"])

    def answer(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        sizes = pc.binary_length(table.column("names")).to_numpy() // 8
        names, counts = from_bytes(table.column("names"), np.uint64), widen(from_bytes(table.column("counts"), np.uint8), from_bytes(table.column("large"), np.int64))
        _, back = np.unique(names, return_inverse=True)
        total = np.bincount(back, counts).astype(np.int64)
        block, shard = (np.append(table.column(c).to_numpy(), x) for c, x in (("block", -1), ("shard", table.column("shard")[0].as_py())))
        totals = _narrowed(total[back], np.append(0, np.cumsum([*sizes, 0])), np.uint16)
        stats = [pa.array([*[None] * len(sizes), int(x)], pa.int64()) for x in (np.count_nonzero(total), total.sum())]
        return pa.table([block, shard, *totals, *stats], ["block", "shard", "totals", "large", "types", "tokens"])

    asked = blocks.select("block", "held_out", "first", "words", "codes").mapInArrow(ask, "shard long, block long, names binary, counts binary, large binary")
    found = asked.repartition(shards, "shard").groupBy("shard").applyInArrow(answer, "block long, shard long, totals binary, large binary, types long, tokens long")
    with common.session_settings(blocks.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch="4m"):
        return common.materialise(found, f"totals-{order}")


@common.shipped
def score_corpus(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 1, strength: tuple[float, ...] = (1000.0, 5.0), block_bytes: int = 4_000_000, shard_ngrams: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Counts come from the rows outside the held-out fold. ``strength`` has k of contexts of one word, two words
    and so on; its length is the order of the model less one. Null texts are empty (one end token); a null id
    counts as the text '' for the fold and stays null; repeated rows are counted and scored each. N-grams are
    told apart by 64-bit hashes. ``block_bytes`` and ``shard_ngrams`` change the work, never the result; a text
    longer than a block is a block of its own. Empty in, empty out.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == held_fold
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"), held.alias("held_out"))
    blocks = _blocks(source, block_bytes)
    n_blocks, n_tokens = blocks.agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    shards = common.shards(n_tokens, shard_ngrams)
    orders = range(1, len(strength) + 2)
    tables = [_totals(blocks, order, shards) for order in orders]
    types, total = tables[0].where("block = -1").agg(F.coalesce(F.sum("types"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()

    answers = None
    for order, table in zip(orders, tables, strict=True):
        table = table.where("block >= 0").select("block", "shard", "totals", "large", F.lit(order).alias("n"))
        answers = table if answers is None else answers.unionAll(table)

    def score(block, answered):
        import pyarrow as pa

        b = _arrays(block, 0)
        order, shard = answered.column("n").to_numpy(), answered.column("shard").to_numpy()
        counts = []
        for n in orders:
            names, at, which = ngrams(b["words"], b["codes"], b["place"], n)
            rows = np.flatnonzero(order == n)
            rows = rows[np.argsort(shard[rows])]
            total_of = np.zeros(len(names))
            if len(rows):
                found = answered.take(pa.array(rows))
                total_of[:] = widen(from_bytes(found.column("totals"), np.uint16), from_bytes(found.column("large"), np.int64))
            own = np.zeros(len(b["codes"]))
            own[at] = total_of[which]
            counts.append(own)
        base, weight = traverse(counts, b["place"], total, types, strength)
        n_docs = len(b["first"]) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(b["first"]))
        sums = lambda x: np.bincount(doc, x, n_docs)
        ids, held = block.column("doc_id")[0].values, block.column("held_out")[0].values
        columns = [ids, held, pa.array(np.diff(b["first"]).astype(np.int64)), pa.array(sums(counts[0] > 0).astype(np.int64)), pa.array(np.full(n_docs, total, np.int64)), pa.array(sums(base)), pa.array(sums(weight))]
        return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    parts = max(1, n_blocks)
    asking = blocks.drop("n_tokens").repartition(parts, "block").groupBy("block")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return asking.cogroup(answers.repartition(parts, "block").groupBy("block")).applyInArrow(score, schema)
