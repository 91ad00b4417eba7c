"""Where may runs of units (words or bytes) recur? What the two substring operators have in common.

Each window of ``size`` units has an anchor: the smallest hash among the runs of ``gram`` units in it, the
leftmost of equals. Equal windows have equal anchors at equal places, so a window can recur only if its
anchor does. Neighbouring windows mostly share their anchor: such windows make one stretch of units, about one
for every (size - gram) / 2 units.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common


@dataclass(frozen=True)
class Rule:
    """size: units of a window; gram: units of an anchor; words: units are words, else bytes."""

    size: int
    gram: int
    words: bool


_BASE, _INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 2**64)


def run_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name for each run of ``length`` values, a few dozen at most (much longer runs could be told apart less well)."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = common.powers(_BASE, len(values) + 1), common.powers(_INVERSE, n)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return common.mix((sums[length:] - sums[:n]) * down)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` neighbouring values, the leftmost of equals."""
    at, span = np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left, right = values[:-step], values[step:]
        later = right < left
        at = np.where(later, at[step:], at[:-step])
        values = np.where(later, right, left)
        span += step
    return at


def units_of(texts, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Values of all units of an Arrow array of texts, and where each text's units begin (one more entry)."""
    import pyarrow as pa

    if rule.words:
        codes, vocabulary, first = common.words_of(texts)
        return common.hash_words(vocabulary)[codes], first
    return common.joined(texts.cast(pa.binary()).to_pylist(), b"")


def stretches(values: np.ndarray, first: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """(doc, s, e, a, h) of each stretch: text number, units from and to within the text, where its anchor begins, and
    the anchor's hash."""
    none = np.zeros(0, np.int64)
    n_windows = len(values) - rule.size + 1
    if n_windows <= 0:
        return none, none, none, none, none.view(np.uint64)
    grams = run_hashes(values, rule.gram)
    place = leftmost_least(grams, rule.size - rule.gram + 1)
    ok = np.zeros(n_windows + 1, bool)
    mark = np.zeros(len(values) + 1, np.int32)
    long = np.diff(first) >= rule.size
    np.add.at(mark, first[:-1][long], 1)
    np.add.at(mark, first[1:][long] - rule.size + 1, -1)
    ok[:n_windows] = np.cumsum(mark)[:n_windows] > 0
    begins = np.zeros(n_windows, bool)
    begins[0] = True
    begins[1:] = place[1:] != place[:-1]
    begins[first[:-1][long]] = True  # windows never cross texts
    begins &= ok[:n_windows]
    start = np.flatnonzero(begins)
    # a stretch's windows go on to the next one that begins or is no window
    stop = np.flatnonzero(begins | ~ok[:n_windows])
    end = np.append(stop, n_windows)[np.searchsorted(stop, start, "right")] + rule.size - 1
    doc = np.searchsorted(first, start, "right") - 1
    anchor = place[start].astype(np.int64)
    return doc, start - first[doc], end - first[doc], anchor - first[doc], grams[anchor]


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, d, t, text): id, id with nulls as the smallest, hash of the text, text (null: empty), and columns to carry."""
    text = common.text_of(text_col)
    more = [F.col(c).alias(n) for c, n in (carry or {}).items()]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), common.id_key(id_col).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"), *more)


def with_ranges(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` of ``keyed`` with ``ranges``: what to remove from each (``found``: d, t, s, e), null where nothing."""
    ranges = found.groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    return docs.join(ranges, ["d", "t"], "left")


def gone_mask(n: int, ranges) -> np.ndarray:
    """Which of n units lie in the ranges."""
    edge = np.zeros(n + 1, np.int32)
    if ranges is not None and len(ranges):
        s = ranges.field("s").to_numpy()
        e = ranges.field("e").to_numpy()
        np.add.at(edge, s, 1)
        np.add.at(edge, e, -1)
    return np.cumsum(edge)[:n] > 0
