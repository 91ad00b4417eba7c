"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import random

import pytest
from pyspark.sql import functions as F

from brute import components, contamination, phrases, substrings

from isohyet.llm import backoff, common, decontamination, packing, phrases as phrase_op, quality, simhash, sitetree, sketches, suffixes, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, t string, h string, s string, e string, key string, w string, fp string, row string, bucket string, hash string, text_key string, ranges string, size string, pos string, noise string"
WORDS = [f"w{i}" for i in range(300)]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def _thue_morse(n, flip):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


#: Two words that a polynomial hash modulo a power of two can't tell apart.
PAIR = (_thue_morse(1024, 0), _thue_morse(1024, 1))
SHARED = prose(99, 60)
LONG = prose(7, 40_000)
ROWS = [
    (1, f"{prose(1, 30)} {SHARED}", "en"),
    (1, f"{prose(1, 30)} {SHARED}", "en"),  # the same row again
    (2, f"{SHARED} {prose(2, 30)} {SHARED}", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \n\t ", "fr"),
    (6, "word", "fr"),
    (7, LONG, "de"),
    (8, "x" + LONG, "de"),
    (9, "Été \U0001f600 " * 30, "zz"),
    (None, SHARED, "en"),
    (10, "same words here", None),
    (11, "same words here", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, None, None, *["x"] * 16) for i, t, lang in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    bench = [(1, SHARED), (2, "word"), (None, prose(2, 20)), (4, None), (5, ""), (1, SHARED)]
    return spark.createDataFrame([(i, t, "x", "x") for i, t in bench], "item_id long, text string, hash string, size string")


def test_written_tables_can_be_discarded(spark):
    import os

    kept = set(common._made)
    df = common.materialise(spark.range(3).toDF("x"), "test")
    path = df._isohyet_path.removeprefix("file://")
    assert os.path.isdir(path) and df.count() == 3
    common._made.clear()
    common._made.add(df._isohyet_path)
    common.discard_all(spark)
    assert not os.path.isdir(path)
    common._made.update(kept)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (200, 201)]
    got = {r.node: r.root for r in common.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 260)]}}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def by_id(rows, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in rows if r["doc_id"] is not None}


def plain():
    """Distinct documents with an id, as the plain versions take them; the null id comes first."""
    return list({(i if i is not None else -1, t) for i, t, _ in ROWS})


def test_packing(docs, none):
    got = packing.pack_documents(docs, with_ids=True).collect()
    assert sum(r.length for r in got if r.doc_id == 3) == 1 and all(len(r.ids) == r.length for r in got)
    assert len({r.sequence_id for r in got}) == len(got)
    assert sum(1 for r in got if r.doc_id == 1 and r.start == 0) == 2
    assert packing.pack_documents(none).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, longest=1000)


def test_special_strings_keep_the_ids_of_the_tokenizer(docs):
    import numpy as np
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    model, encode = Tokenizer.from_file(path), packing._encoder(path, packing.tokenizer_path(packing.DEFAULT_RANKS))
    for text in ("a <|endoftext|> b", " 's ''t don't  \n\n x", LONG, "É\U0001f600́", "", " " * 1_000_000, "\n" * 300_000 + "x", "a" * 100_000):
        assert np.frombuffer(encode(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_decontamination(docs, none, items, spark):
    rows = decontamination.contamination(docs, items).collect()
    assert len(rows) == len(ROWS)
    want = contamination(plain(), [(1, SHARED), (2, "word"), (4, None), (5, "")])
    for r in rows:
        if r.doc_id is not None and r.doc_id != 2:  # 2 is also hit by the item without an id
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id]
    two = next(r for r in rows if r.doc_id == 2)
    assert two.n_items == 1 and two.n_hit > want[2][1]
    shuffled = decontamination.contamination(docs, items, broadcast_bytes=0).collect()
    key = lambda r: (str(r.doc_id), r.n_words, r.n_hit, r.items_sha256, r.contaminated)
    assert sorted(map(key, rows)) == sorted(map(key, shuffled))
    left = decontamination.decontaminate(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 7, 8, 9, 10, 11]
    spans = {r.doc_id: r.text for r in decontamination.decontaminate(docs, items, remove="spans").collect()}
    assert spans[6] == "" and spans[1] == prose(1, 30) and spans[7] == LONG
    assert decontamination.contamination(none, items).count() == 0
    assert not any(r.contaminated for r in decontamination.contamination(docs, items.limit(0)).collect())


def test_words_of_any_characters(spark):
    from brute import WORD, fold

    texts = ["".join(map(chr, range(300))), "A\0b\x7fC ÀÉ x1_y2", "\x80\u2028z\U0001f600 q", "", "--", "a  b", "0" * 40]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(decontamination.words(F.col("t")).alias("w")).collect()
    assert [r.w for r in got] == [WORD.findall(fold(t)) for t in texts]


def test_simhash(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    want = components([x for x in plain() if x[0] != -1])
    for r in rows:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == want[r.doc_id]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 2 and 11 not in ids and 10 in ids and 4 not in ids and 8 not in ids
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def test_lightly_edited_copies_are_one_group(spark):
    """Copies with words changed, above and below a similarity of 0.8, in groups of one base and in chains."""
    from brute import shingle_sets, similar_groups

    r, rows = random.Random(2), []
    for base in range(12):
        words = prose(500 + base, 150).split()
        for copy in range(base + 1):
            own = list(words)
            for _ in range(r.randrange(0, 5)):
                own[r.randrange(len(own))] = f"x{r.random()}"
            rows.append((base * 100 + copy, " ".join(own)))
            if base % 3 == 0:
                words = own  # each edits the one before
    rows += [(9000 + i, prose(9000 + i, 60)) for i in range(40)] + [(None, rows[0][1]), (None, rows[30][1] + " more"), (None, "alone")]
    got = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id is not null").collect()}
    want = similar_groups([(d, t) for d, t in rows if d is not None])
    assert got == set(want.values()) and len(got) < len(want) - 30
    assert any(0.8 <= len(a & b) / len(a | b) < 0.9 for a in [shingle_sets(rows[70][1])] for b in [shingle_sets(t) for _, t in rows])
    assert simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id is null").count() == 1


def test_vantage_point_tree_loses_no_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 300, np.uint64)
    near = centres[rng.integers(0, 300, 3000)]
    for _ in range(4):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) * rng.integers(0, 2, 3000).astype(np.uint64)
    x = np.unique(np.concatenate([near, centres, rng.integers(0, 2**64, 2000, np.uint64)]))
    tree = simhash.Tree(x[::7], 16, 3)
    row, leaf = tree.route(x)
    pairs = {(i, j) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3).tolist() if i < j}
    where = {}
    for i, k in zip(row.tolist(), leaf.tolist()):
        where.setdefault(i, set()).add(k)
    assert all(where[i] & where[j] for i, j in pairs)
    root = simhash.forest(x, 3)
    assert all(root[i] == root[j] for i, j in pairs)
    groups = len(set(root.tolist()))
    parent = list(range(len(x)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in pairs:
        parent[find(j)] = find(i)
    assert groups == len({find(i) for i in range(len(x))})


def test_a_dense_cluster_of_fingerprints_is_one_group():
    """All pairs of flips of two of 60 bits are within four bits of each other: no vantage point splits them."""
    import time

    import numpy as np

    x = np.unique(np.array([(1 << i) ^ (1 << j) for i in range(60) for j in range(i)] + [1 << 63], np.uint64))
    began = time.perf_counter()
    root = simhash.forest(x, 4)
    assert len(np.unique(root)) == 1 and time.perf_counter() - began < 20
    assert len(np.unique(simhash.forest(x, 1))) == len(x)


def _cut(docs, rows, plain_rows, *names):
    want = {d: v for d, v in plain_rows.items() if d != -1}
    assert len(rows) == len(ROWS)
    assert by_id(rows, *names) == want


def test_phrases(docs, none):
    _cut(docs, phrase_op.remove_phrases(docs).collect(), phrases(plain()), "n_words", "n_removed", "kept_sha256")
    assert phrase_op.remove_phrases(none).count() == 0


def test_substrings(docs, none):
    _cut(docs, suffixes.remove_substrings(docs).collect(), substrings(plain()), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    carried = suffixes.remove_substrings(docs, carry=("lang", "source", "d"))
    assert {"lang", "source", "d"} <= set(carried.columns) and carried.count() == len(ROWS)
    assert suffixes.remove_substrings(none).count() == 0


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_anchors_are_split_without_loss(spark, hot):
    texts = [(i, f"{prose(i, 12)} {SHARED} {prose(1000 + i, 12)}") for i in range(25)] + [(100, f"{prose(1, 9)} {PAIR[0]} {prose(2, 11)}"), (101, f"{prose(1, 9)} {PAIR[1]} {prose(2, 11)}")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = phrase_op.remove_phrases(docs, hot=hot, shard_places=40).collect()
    assert by_id(got, "n_words", "n_removed", "kept_sha256") == phrases(texts)
    got = suffixes.remove_substrings(docs).collect()
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == substrings(texts)


def test_passages_with_many_surroundings(spark):
    """Passages of just under and over a window between random words, overlapping themselves, and at ends of texts."""
    r, texts = random.Random(8), []
    bits = [prose(40 + k, 19 + k) for k in range(4)] + ["a b " * 30, "x" * 49, "x" * 130]
    for i in range(60):
        parts = [r.choice([prose(i * 10 + k, r.randrange(1, 15)), r.choice(bits), r.choice(bits)[: r.randrange(20, 160)]]) for k in range(r.randrange(1, 6))]
        texts.append((i, " ".join(parts)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert by_id(phrase_op.remove_phrases(docs).collect(), "n_words", "n_removed", "kept_sha256") == phrases(texts)
    assert by_id(suffixes.remove_substrings(docs).collect(), "n_bytes", "n_removed", "n_spans", "kept_sha256") == substrings(texts)


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, None, "same"), (2, None, "same"), (None, "http://b/", "same"), (3, "http://c/\r\nx", None), (4, "u", ""), (5, "http://d/", "\r\n\r\nWARC/1.1 " * 9000), (None, None, "alone")]
    pages = spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, sha string, top string")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == sorted([("1", 4, "revisit", 2), ("2", 4, "response", None), ("2", 4, "response", None), ("None", 4, "revisit", 2), ("3", 0, "revisit", 4), ("4", 0, "response", None), ("5", 117000, "response", None), ("None", 5, "response", None)])
    for compression in ("gzip", "none"):
        path = f"file://{tmp_path}/{compression}"
        warc.write_pages(pages, path, compression=compression)
        read = warc.read_archives(spark, path)
        assert read.where("record_type = 'revisit'").count() == 3
        assert [bytes(r.payload) for r in read.where("page_id = 5").collect()] == [rows[6][2].encode()]
        assert warc.read_archives(spark, path, payload=False).where("payload is not null").count() == 0
    assert "record_type" in read.where("record_type = 'revisit'")._jdf.queryExecution().toString()
    assert warc.round_trip(pages.limit(0)).count() == 0
    shuffled = warc.with_revisits(pages, broadcast_rows=0).select("page_id", "revisit", "refers_to").collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, warc.with_revisits(pages).select("page_id", "revisit", "refers_to").collect()))


@pytest.mark.parametrize("packed", [True, False])
def test_warc_skips_and_ends(packed):
    """Unwanted payloads are not unpacked, other people's members are read, early ends and wrong payloads raise."""
    import gzip

    import pyarrow as pa

    class Counting:
        def __init__(self, data):
            self.file, self.read_bytes = pa.BufferReader(data), 0

        def read(self, n):
            data = self.file.read(n)
            self.read_bytes += len(data)
            return data

        def __getattr__(self, name):
            return getattr(self.file, name)

    r = random.Random(1)
    payloads = [r.randbytes(300_000) for _ in range(20)]
    made = [warc.record(i, "u", p, len(p), warc.digest(p), None, packed) for i, p in enumerate(payloads)]
    data = b"".join(made)
    every, some = lambda row: True, lambda row: row["page_id"] in (3, 17)
    assert [x["payload"] for x in warc.records(Counting(data), packed, every, "true")] == payloads
    source = Counting(data)
    assert [x["payload"] for x in warc.records(source, packed, some, "true")] == [payloads[3], payloads[17]]
    assert source.read_bytes < 0.5 * len(data)
    assert [(x["payload_bytes"], x["payload"]) for x in warc.records(Counting(data), packed, some, "digest")] == [(300_000, None)] * 2
    if packed:
        assert all(p in gzip.decompress(data) for p in payloads)
        other = b"".join(gzip.compress(gzip.decompress(m)) for m in made)
        assert [x["page_id"] for x in warc.records(Counting(other), True, some, "false")] == [3, 17]
    for cut in (len(made[0]) + 40, len(made[0]) + 200_000, len(data) - 10):
        for payload in ("true", "false"):
            if payload == "false" and packed and cut > len(made[0]) + 100:
                continue  # passed over by seeking
            with pytest.raises((EOFError, ValueError)):
                list(warc.records(Counting(data[:cut]), packed, every, payload))
    bad = warc.record(1, "u", b"one", 3, warc.digest(b"two"), None, packed)
    with pytest.raises(ValueError):
        list(warc.records(Counting(bad), packed, every, "digest"))


@pytest.mark.parametrize("foreign", [False, True])
def test_warc_rejected_pages_are_not_unpacked(foreign, monkeypatch):
    """Of small pages that pack well, headers alone are unpacked; a block of the file is read once."""
    import gzip

    import pyarrow as pa

    pages = [f"<html><body><p>{i} {'ordinary words of a page ' * 700}</p></body></html>".encode() for i in range(250)]
    made = [warc.record(i, "http://a.b/c", p, len(p), warc.digest(p), None, True) for i, p in enumerate(pages)]
    if foreign:
        made = [gzip.compress(gzip.decompress(m)) for m in made]
    streams, real = [], warc._Stream
    monkeypatch.setattr(warc, "_Stream", lambda *a: streams.append(real(*a)) or streams[-1])

    class Counting:
        def __init__(self, data):
            self.file, self.read_bytes = pa.BufferReader(data), 0

        def read(self, n):
            data = self.file.read(n)
            self.read_bytes += len(data)
            return data

        def __getattr__(self, name):
            return getattr(self.file, name)

    source, whole = Counting(b"".join(made)), sum(map(len, pages))
    assert list(warc.records(source, True, lambda row: False, "true")) == []
    assert source.read_bytes == len(b"".join(made))
    assert foreign or streams[0].unpacked < whole / 10
    found = list(warc.records(Counting(b"".join(made)), True, lambda row: row["page_id"] % 50 == 7, "true"))
    assert [(r["page_id"], r["payload"]) for r in found] == [(i, pages[i]) for i in range(7, 250, 50)]
    with pytest.raises(ValueError):
        list(warc.records(pa.BufferReader(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n"), False, lambda row: True, "true"))


def test_sketches(docs, none):
    import numpy as np

    rows = sketches.fingerprint_report(docs).collect()
    assert len(rows) == len(ROWS)
    prints = {}
    for r, text in ((r, dict((i, t) for i, t, _ in ROWS)[r.doc_id]) for r in rows):
        assert prints.setdefault(text or "", r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    a, b = sketches.sketch([LONG.encode(), ("y " + LONG).encode()])
    assert sketches.likeness(a, b) > 0.99
    half = sketches.sketch([LONG[: len(LONG) // 10].encode()])[0]
    assert sketches.containment(half, a) > 0.95
    assert np.array_equal(sketches.decode(sketches.encode(a)), a)
    one, two = sketches.sketch([PAIR[0].encode(), PAIR[1].encode()])
    assert sketches.likeness(one, two) == 0
    assert sketches.fingerprint_report(none).count() == 0


def test_merged_sketches_are_those_of_the_union():
    """Shingles of texts of few to many words: merging gives what all shingles together give."""
    import numpy as np

    for seed in range(200):
        texts = [prose(seed, 3 + seed % 9), prose(1000 + seed, 1 + seed % 40)]
        shingles = [np.concatenate([sketches.hashes([t.encode()])[0]]) for t in texts]
        a, b = sketches.sketch([t.encode() for t in texts])
        assert np.array_equal(sketches.merge(a, b), sketches.kept(np.concatenate(shingles), 8))


def test_next_document_where_many_rows_share_an_id(spark):
    import hashlib

    rows = [(None, f"n{i % 40} {prose(i % 40, 8)}") for i in range(120)] + [(7, f"s{i} {prose(i, 8)}") for i in range(90)] + [(i, prose(i, 8)) for i in range(100, 140)]
    got = sketches.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string"), rows_per_bucket=16).collect()
    assert len(got) == len(rows)
    texts = {hashlib.sha256(t.encode()).hexdigest() for _, t in rows}
    ends = {t[: len(t) // 3] for _, t in rows}
    edits = {hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest(): (t, n) for _, t in rows for n in [x for _, x in rows]}
    assert ends and all(r.edited_sha256 in edits or r.edited_sha256 in texts for r in got)
    by_id = {i: t for i, t in rows if i is not None and i >= 100}
    for r in got:  # where ids are unique the next document is certain
        if r.doc_id is not None and r.doc_id > 100:
            t, n = by_id[r.doc_id], by_id[r.doc_id - 1]
            assert r.edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest()
    # every row is the next one of exactly one other: the firsts of all edits' tails are those of all rows
    tails = sorted(r.near_next for r in got)
    assert len(tails) == len(rows)


def test_backoff(docs, none):
    rows = backoff.score_corpus(docs).collect()
    assert len(rows) == len(ROWS) and all(r.score < 0 and r.n_tokens >= 1 for r in rows)
    assert next(r for r in rows if r.doc_id == 3).n_tokens == 1
    assert backoff.score_corpus(none).count() == 0


def test_backoff_weights_sum_to_one():
    """From each state the weights of all words, known and unseen, make a distribution."""
    import numpy as np

    from brute import SPACE
    from collections import Counter

    texts = [(*SPACE.findall(prose(i % 7, 40)), None) for i in range(60)]
    count = Counter(w[i : i + n] for w in texts for n in (1, 2, 3) for i in range(len(w) - n + 1))
    words = [g[0] for g in count if len(g) == 1]
    total = sum(count[(w,)] for w in words)
    for context in ((), texts[0][:1], texts[0][:2], ("never", "seen"), (texts[0][0], "never")):
        mass = 0.0
        for w in [*words, "unseen"]:
            line = (*context, w)
            counts = [np.array([count[line[i - n : i + 1]] if i >= n else 0 for i in range(len(line))], float) for n in range(3)]
            mass += 10 ** backoff.traverse(counts, np.arange(len(line)), total, len(words), (50.0, 5.0))[1][-1]
        assert mass == pytest.approx(1, abs=1e-9)


def test_quality(docs, none, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (7, 1, 0), (9, 0, 1), (None, 1, 0), (10, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.assess(docs, labels).collect()
    assert len(rows) == len(ROWS)
    assert not any(r.keep for r in rows if r.doc_id in (3, 4, 5)) and all(r.perplexity is None for r in rows if r.doc_id in (3, 4, 5))
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.assess(none, labels).count() == 0
    key = lambda r: (str(r.doc_id), r.lang, r.n_tokens, round(r.perplexity or 0, 9), round(r.evidence, 9), r.keep)
    assert sorted(map(str, map(key, quality.assess(docs, labels, broadcast_limit=0).collect()))) == sorted(map(str, map(key, rows)))  # by shuffles
    free = quality.assess(docs, labels.limit(0)).collect()
    assert all(r.keep for r in free if r.n_tokens)


@pytest.mark.parametrize("settings", [{}, {"broadcast_limit": 400, "slices": 3}])
def test_quality_is_fitted_on_all_labelled_documents(spark, settings):
    """More documents of each kind than a sample of 2,000 would take, also where most weights aren't broadcast."""
    from brute import quality as plain

    n = 7_500
    rows = [(i, f"{prose(i % 50, 5)} w{i} w{i * 7 % n} {'scum' if i % 3 == 0 else 'calm'} w{i // 2}.", ("en", "de")[i % 2]) for i in range(n)]
    told = [(i, 1, int(i % 3 == 0)) for i in range(n) if i % 10]
    want = plain(rows, told, fit_docs=n)
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    got = quality.assess(docs, labels, **settings).collect()
    assert len(got) == n and 0 < sum(r.evidence > 0 for r in got) < n
    for r in got:
        perplexity, evidence, keep = want[r.doc_id]
        assert (r.perplexity, r.evidence, r.keep) == (pytest.approx(perplexity, rel=1e-9), pytest.approx(evidence, rel=1e-9, abs=1e-9), keep)


def test_quality_sends_no_keys_of_unknown_words(spark, monkeypatch):
    """A word that the model doesn't have has no weight, nor has a bigram with it: none of these is shuffled."""
    rows = [(i, prose(i, 40), "en") for i in range(60)] + [(60, " ".join(f"never{i}" for i in range(1000)), "en"), (61, prose(3, 20) + " never " + prose(5, 20), "en"), (62, "", "en")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(50)], "doc_id long, quality int, toxic int")
    sent, write = {}, common.fresh_ids

    def spy(df, *args):
        out = write(df, *args)
        sent.update({r.doc_id: len(r.tail) for r in out.collect()})
        return out

    monkeypatch.setattr(common, "fresh_ids", spy)
    got = {r.doc_id: r for r in quality.assess(docs, labels, broadcast_limit=10, slices=2).collect()}
    assert sorted(sent) == list(range(63)) and sent[60] <= 10 and sent[61] > 10  # 2,001 for text 60 if all were sent; the map may let a few pass
    want = {r.doc_id: r for r in quality.assess(docs, labels).collect()}  # all weights are broadcast
    for d, r in got.items():
        assert (r.n_tokens, r.keep, r.evidence) == (want[d].n_tokens, want[d].keep, pytest.approx(want[d].evidence, abs=1e-9))
        assert r.perplexity == (pytest.approx(want[d].perplexity, rel=1e-9) if r.n_tokens else None)


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_quality_finds_hashes(spark, n):
    """The map of words and the index of keys against sets, at both ends of the hashes too."""
    import numpy as np

    rng = np.random.default_rng(n)
    have = np.unique(np.concatenate([rng.integers(0, 2**64, n, dtype=np.uint64), np.array([0, 2**63, 2**64 - 1], np.uint64)[:n]]))
    asked = np.concatenate([have, have ^ np.uint64(1), rng.integers(0, 2**64, 20_000, dtype=np.uint64), np.array([0, 1, 2**63 - 1, 2**63, 2**64 - 1], np.uint64)])
    table = spark.createDataFrame([(int(k), float(i)) for i, k in enumerate(have.view(np.int64))], "w long, value double")
    passed = quality._mapped(asked, quality._word_map(table, n))
    real = np.isin(asked, have)
    assert passed[real].all() and passed[2 * len(have) : -5].mean() < 1 / 16
    keys, values, begins = quality._indexed(table)
    at = quality._places(asked, keys, begins)
    assert ((at >= 0) == real).all() and (keys[at[real]] == asked[real]).all()
    assert (have[values[at[real]].astype(int)] == asked[real]).all()


def test_kneser_ney_sums_to_one(spark):
    import math

    texts = spark.createDataFrame([(" ".join(prose(i, 25).split()),) for i in range(20)], "text string")
    model = quality.KneserNey(texts, "test")
    words = {r.w: r.p for r in model.words.collect()}
    assert sum(words.values()) + model.unknown == pytest.approx(1, abs=1e-9)
    contexts = {r.v: r.g for r in model.contexts.collect()}
    seen = {}
    for r in model.bigrams.collect():
        seen.setdefault(r.v, {})[r.w] = math.exp(r.lp2)
    for v in list(contexts)[:10]:
        total = sum(seen[v].get(w, contexts[v] * p) for w, p in words.items()) + contexts[v] * model.unknown
        assert total == pytest.approx(1, abs=1e-9)


PAGE = """<html><head><title>no</title><style>p{{}}</style></head><body><nav><a>menu</a></nav><div class="cookie-notice">accept</div>
<header><p>site</p></header><div id="main"><article><h1>Title {0}</h1>Lead &amp; more<p>one {0}<br>two  <i>three</i><p>four &lt;5&gt;
<ul><li>a {0}<li>b</ul><form><p>mail</p></form><div class="comments"><p>reader</p></div></article></div><div class="x1"><p>boiler plate</p></div>
<aside>side</aside><script>if (a < b) "</p>"</script><footer>foot</footer></body></html>"""


def test_extraction(spark):
    pages = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(12)]
    pages += [(20, "http://alone.example/", PAGE.format("x")), (21, None, None), (22, "http://h.example/", ""), (23, "u", "plain <b>text"), (24, "u", "<p>" + "long " * 200_000), (None, "u", "<p>n</p>"), (25, "u", "<div><p>open <!-- never closed")]
    df = spark.createDataFrame([(*p, "x", "x") for p in pages], "page_id long, url string, html string, host string, noise string")
    got = {r.page_id: r for r in sitetree.extract(df).collect()}
    body = "Title {0}\n\nLead & more\n\none {0} two three\n\nfour <5>\n\na {0}\n\nb"
    assert got[3].text == body.format(3)  # what all pages of the host repeat is gone
    assert got[20].text == body.format("x") + "\n\nboiler plate"  # a single page of a host shows no repetition
    assert got[21].text == "" and got[22].text == "" and got[23].text == "plain text" and got[24].n_chars == 5 * 200_000 - 1
    assert got[None].text == "n" and got[25].text == "open"
    assert sitetree.extract(df.limit(0)).count() == 0


def test_backoff_keeps_every_ngram(spark):
    """All n-grams of the training texts are states, however the texts are dealt."""
    from brute import base_scores, scores

    texts = [(i, prose(i % 40, 30 + i % 9) + (" rare%d" % (i // 3)) * (i % 2) + " " + prose(1000 + i, 12)) for i in range(150)] + [(200, None), (201, "w1"), (202, "never seen"), (203, "w1 never"), (204, "w1 w1 w1 w1"), (205, PAIR[0]), (206, PAIR[1])]
    want, base = scores(texts), base_scores(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for size, ngrams in ((7_000_000, 2_000_000), (3_000, 50)):
        got = {r.doc_id: r for r in backoff.score_corpus(df, block_bytes=size, shard_ngrams=ngrams).collect()}
        assert {i: r.score for i, r in got.items()} == {i: pytest.approx(x, rel=1e-9) for i, x in want.items()}
        assert {i: r.base_score for i, r in got.items()} == {i: pytest.approx(x[4], rel=1e-9) for i, x in base.items()}


def test_backoff_counts_of_any_size(spark):
    """Counts beyond one and two bytes come back whole, in blocks of few and of many distinct words."""
    import numpy as np

    from brute import base_scores, scores

    texts = [(i, "w1 w2 " * (40_000 if i == 0 else 130) + prose(i, 20)) for i in range(12)] + [(20, "W1 w1"), (21, " ".join(f"n{k}" for k in range(70_000)) + " n1 n2")]
    want, base = scores(texts), base_scores(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for size in (4_000_000, 1_000):
        got = {r.doc_id: r for r in backoff.score_corpus(df, block_bytes=size, shard_ngrams=20_000).collect()}
        assert {i: r.score for i, r in got.items()} == {i: pytest.approx(x, rel=1e-9) for i, x in want.items()}
        assert {i: r.base_score for i, r in got.items()} == {i: pytest.approx(x[4], rel=1e-9) for i, x in base.items()}
    for kind in (np.uint8, np.uint16):
        top = np.iinfo(kind).max
        x = np.array([0, 1, top - 1, top, top + 1, 2**40, 3])
        assert (backoff.widen(*backoff.narrow(x, kind)) == x).all() and len(backoff.narrow(x, kind)[1]) == 3


def test_backoff_rows_are_small(spark):
    """What tasks hold for a token and an n-gram: 2 bytes each besides the block's words (4 and 8 as lists of numbers)."""
    import glob
    import zlib

    texts = [(i, " ".join(f"w{zlib.crc32(b'%d %d' % (i, k)) % 500}" for k in range(400))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", "text", "doc_id % 5 = 1 as held_out").coalesce(1)
    blocks = backoff._blocks(docs, 100_000)
    held = blocks.select("words", "codes").toArrow()
    assert held.nbytes < 2.5 * 300 * 401
    import pyarrow.parquet as pq

    (file,) = glob.glob(f"{blocks._isohyet_path.removeprefix('file://')}/part-*.parquet")
    assert pq.ParquetFile(file).num_row_groups == len(held) >= 4  # a reader holds one block at a time
    totals = backoff._totals(blocks, 3, 4).where("block >= 0").toArrow()
    assert totals.nbytes < 2.5 * 300 * 399


def test_extraction_counts_equal_pages_once(spark):
    """Many copies of one page do not make the other articles of the host look repeated."""
    copy, page = '<div class="post"><p>copied</p></div>', '<h1>Heading {0}</h1><div class="post"><p>article {0}</p></div>'
    pages = [(i, f"http://h.example/{i}", copy) for i in range(100)]
    pages += [(100 + i, f"http://h.example/{100 + i}", page.format(i)) for i in range(10)]
    inside = '<body><div class="x1">boiler plate</div>{}</body>'
    pages += [(1000 + i, f"http://g.example/{i}", inside.format(html)) for i, _, html in pages]
    got = {r.page_id: r.text for r in sitetree.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for start in (0, 1000):  # in g.example the copies must not hide the repeated block either
        assert got[start + 103] == "Heading 3\n\narticle 3" and got[start + 5] == "copied"


def test_markup_is_read_in_proportion_to_its_length():
    import time

    for page in ("<a " * 300_000, "if a <b and c " * 70_000, "<a '>' " * 100_000, "<div>" * 100_000 + "x", "<b>" * 20_000 + "<p></p>" * 20_000, "<b><article>" + "<i>" * 20_000 + "</b>" * 20_000):
        began = time.perf_counter()
        nodes, _ = sitetree.parse(page)
        assert time.perf_counter() - began < 10 and len(nodes) <= 65
    assert [t for _, t, _ in sitetree.parse("if a <b and c")[1]] == ["if a <b and c"]
    assert [t for _, t, _ in sitetree.parse('<p title="a > b">x <b>y')[1]] == ["x y"]


def test_only_whole_class_names_declare_a_branch():
    for page in ('<div class="legal-guide"><p>text', '<div class="social-science review"><p>text', '<p class="form">text', '<div class="admin header-image"><p>text'):
        assert [(t, declared) for _, t, declared in sitetree.parse(page)[1]] == [("text", False)]
    for page in ('<div class="x ad"><p>text', '<ul id="comments"><li>text', "<nav><p>text", '<div role="navigation">text', '<div class="cookie_banner">text'):
        assert [(t, declared) for _, t, declared in sitetree.parse(page)[1]] == [("text", True)]
    assert [(t, d) for _, t, d in sitetree.parse("one <button>x</button> two<p>a<label><p>l</label> more")[1]] == [("one two", False), ("a", False), ("l more", False)]


def _plain_extraction(pages, prior=2.0, threshold=0.3, article_threshold=0.05):
    """Texts of (page_id, host, html) by a style tree in plain Python."""
    import math
    from collections import Counter, defaultdict

    trees = defaultdict(dict)
    parses = {i: (host, *sitetree.parse(html)) for i, host, html in pages}
    for host, nodes, blocks in parses.values():
        trees[host][repr((nodes, blocks))] = nodes
    low = defaultdict(set)
    for host, different in trees.items():
        values = defaultdict(list)
        for nodes in different.values():
            for node, v in nodes.items():
                values[node].append(v)
        raw = {}
        entropy = lambda x: 1.0 if len(x) < 2 else -sum(n / len(x) * math.log(n / len(x)) for n in Counter(x).values()) / math.log(len(x))
        for node in sorted(values, key=lambda n: -values[n][0][1]):
            v = values[node]
            below = [raw[k] for k in values if values[k][0][0] == node]
            if any(x[5] for x in v) or not below:
                own = entropy([x[4] for x in v])
                raw[node] = 1 - (1 - entropy([x[3] for x in v])) * (1 - max([own, *below])) if below else own
            else:
                raw[node] = 1 - (1 - entropy([x[3] for x in v])) * (1 - max(below))
            if (len(v) * raw[node] + prior) / (len(v) + prior) < (article_threshold if v[0][2] else threshold):
                low[host].add(node)
    out = {}
    for i, (host, _, blocks) in parses.items():
        own = [(c, t) for c, t, declared in blocks if not declared]
        out[i] = "\n\n".join([t for c, t in own if not low[host] & set(c)] or [t for _, t in own])
    return out


def test_style_tree_matches_a_plain_one(spark):
    """Hosts of many sizes with repeated, half repeated and varied branches, also inside articles."""
    r = random.Random(5)
    pages = []
    for h in range(12):
        for i in range(h * h // 2 + 1):
            parts = ['<div class="x1"><p>always the same</p><p>and this</p></div>', f'<div class="x2"><p>seldom other {r.random() < 0.1}</p></div>', f"<div id=\"body\"><h1>{prose(i, 4)}</h1>" + "".join(f"<p>{prose(r.randrange(90), 9)}</p>" for _ in range(r.randrange(1, 5))) + '<div class="x3"><p>kept up</p></div></div>', f"<article><p>{prose(i % 3, 5)}</p><section class='s'>in every article</section></article>"]
            pages.append((h * 1000 + i, f"http://h{h}.example/", "<html><body>" + "".join(parts) + "</body></html>"))
    pages += [(50_000 + i, "http://h11.example/", pages[-1][2]) for i in range(30)]
    got = {p.page_id: p.text for p in sitetree.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = _plain_extraction([(i, url, html) for i, url, html in pages])
    assert got == want
    assert "always the same" not in got[11_003] and "always the same" in got[0] and "kept up" not in got[11_003]
    joined = {p.page_id: p.text for p in sitetree.extract(spark.createDataFrame(pages, "page_id long, url string, html string"), tree_limit=0).collect()}
    assert joined == want


def test_op10_matches_a_plain_tree(spark):
    import os

    pages = spark.read.parquet(f"{os.environ.get('TEST_SF_DIR', '/root/testdata/sf0.001')}/pages.parquet").collect()
    host = lambda u: (u or "").lower().split("://")[-1].split("/")[0].split(":")[0].split("?")[0].split("#")[0]
    from isohyet.llm import queries

    got = {r.page_id: (r.text, r.n_chars) for r in queries.op10_html(spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")).collect()}
    assert got == {i: (t, len(t)) for i, t in _plain_extraction([(p.page_id, host(p.url), p.html or "") for p in pages]).items()}
