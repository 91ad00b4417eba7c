"""Phrase mining, line dedup and source divergence: against SQL, plain-Python versions and with settings that force every way."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from brute import fold

from isohyet.llm import collocations, common, divergence, lines, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, a long, rank int, block long"


@pytest.mark.parametrize("name", ["op11_collocations", "op12_lines", "op13_divergence"])
def test_query_matches_sql(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.ORACLE_SQL[name]) == []


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    common.ship(spark)
    return spark.createDataFrame([(*r, 7, "x", 7, 7, 7) for r in rows], SCHEMA)


def phrases(rows, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3, 4):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, own in f.items():
        cand = [g for g in own if len(g) > 1 and own[g] >= least]
        inside = lambda g, x: any(x[i : i + len(g)] == g for i in range(len(x) - len(g) + 1))
        found = []
        for g in cand:
            if any(len(x) > len(g) and inside(g, x) and 100 * own[x] >= share * own[g] for x in cand):
                continue
            score, k = min((2000000 * own[g] // (own[g[:k]] + own[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -own[g], " ".join(g).encode(), own[g[:k]], own[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def babble(seed, n, words="the of cat sat on mat É ß日本 x\x01 Zq".split(" ")):
    draw = random.Random(seed)
    weights = [30, 20, 5, 5, 5, 5, 3, 2, 2, 1]
    return "".join(draw.choices(words, weights)[0] + draw.choices([" ", "\t", "  ", ", ", ".\n", ": "], [20, 3, 2, 1, 1, 1])[0] for _ in range(n))


MINED = [(i, babble(i, 120), ["en", None, "de"][i % 3], "s") for i in range(30)] + [(1, babble(1, 120), None, None), (None, None, "en", "s"), (40, "", "fr", "s"), (41, " .\n, ", None, "s")]


@pytest.mark.parametrize("settings", [{}, {"least_hot": 1, "most_ranked": 4, "chunk": 900, "spill": 1}, {"least_hot": 1, "most_ranked": 60, "spill": 400, "salts": 3}, {"most_ranked": 1, "least_hot": 10**9}])
def test_phrases_match_plain_counts(spark, settings):
    found = collocations.mine(table(spark, MINED), least=6, top=40, **settings).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert {tuple(r) for r in found} == phrases(MINED, 6, 80, 40)
    assert len(found) > 60


def test_no_phrases(spark):
    assert collocations.mine(table(spark, [])).collect() == []
    assert collocations.mine(table(spark, [(1, None, None, None), (2, "one two", "en", "s")])).collect() == []


def test_a_shared_number_takes_another_seed(spark, monkeypatch):
    common.ship(spark)
    real, seeds = collocations._words, []

    def words(source, seed, chunk):
        seeds.append(seed)
        found = real(source, seed, chunk)
        return common.materialise(found.withColumn("id", collocations.F.lit(5).cast("long")), "same") if seed < 2 else found

    monkeypatch.setattr(collocations, "_words", words)
    source = table(spark, MINED).selectExpr("coalesce(lang, 'und') lang", "coalesce(text, '') text")
    assert collocations._numbered_words(source, 1000)[1] == 2 and seeds == [0, 1, 2]


def test_spilled_paths_are_sorted_and_whole():
    trie = collocations.HatTrie(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0)
    codes, vocabulary, piece = collocations.pieces_of([babble(3, 500).encode()])
    trie.add(collocations.word_ids(vocabulary, 0), codes, piece)
    batch = trie.spill("en")
    total = 0
    for run in batch.column("run").to_pylist():
        entries = np.frombuffer(run, collocations.ENTRY)
        keys = [tuple(e)[:3] for e in entries.tolist()]
        assert keys == sorted(set(keys))
        total += entries["n"].sum()
    assert total == sum(piece[:-1] == piece[1:])  # a path for each word that another follows


def kept_lines(rows, min_docs=5, min_chars=40):
    key = lambda x: fold(x.strip(" \t\n\x0b\x0c\r"))
    ids = lambda d: common.NULL_ID if d is None else d
    docs, last = Counter(), {}
    for d, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            docs[k] += 1
            last[k] = max(last.get(k, ids(d)), ids(d))
    out = []
    for d, text, *_ in rows:
        own = (text or "").split("\n")
        stay = [x for x in own if len(key(x)) < min_chars or docs[key(x)] < min_docs or last[key(x)] == ids(d)]
        out.append((d, len(own), len(own) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


LONG = "Ünïcode Ä line that is exactly long enough"
LINED = [(i, f"{LONG}\nown line {i} of this text\r\n \t{LONG.replace('line', 'LINE')} \n{'é' * 39}\n\n{'y' * 40}{i % 7}", "en", "s") for i in range(40)]
LINED += [(39, LONG, "en", "s"), (None, f"{LONG}\n", "en", "s"), (None, None, None, None), (60, "", "en", "s"), (61, "\n\n", "en", "s"), (62, "z" * 300_000 + "\n" + LONG.upper().replace("Ü", "Ü"), "en", "s")]


@pytest.mark.parametrize("settings", [{}, {"shard_keys": 2, "chunk": 500}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "shard_keys": 1, "chunk": 700, "group": 3}])
def test_lines_match_plain_version(spark, settings):
    found = sorted((tuple(r) for r in lines.drop_repeated_lines(table(spark, LINED), **settings).select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)
    assert found == kept_lines(LINED)
    assert sum(r[2] for r in found) > 80


@pytest.mark.parametrize("limit", [0, 10**6])
def test_lines_of_nothing(spark, limit):
    assert lines.drop_repeated_lines(table(spark, []), broadcast_limit=limit).collect() == []
    one = lines.drop_repeated_lines(table(spark, [(1, None, None, None)]), broadcast_limit=limit).collect()
    assert [tuple(r) for r in one] == [(1, 1, 0, "")]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    draw = np.random.default_rng(n)
    a, b = draw.integers(0, 2**64, (2, n), np.uint64)
    b[: n // 2] = 7  # half of the keys differ in one word alone
    a[n // 2 :] = 9
    table = lines.PerfectHash.from_bytes(lines.PerfectHash.build(a, b).to_bytes())
    assert sorted(table.find(a, b)) == list(range(n))
    assert table.find(*draw.integers(0, 2**64, (2, 100), np.uint64)).max(initial=-1) < max(n, 1)
    assert n < 1000 or 8 * len(table.words) < n  # under 8 bits a key


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        lines.PerfectHash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def audited(rows, min_docs, top):
    lang_docs, n = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(text))
        lang_docs[lang or ""].update(set(terms))
        n[lang or "", source or ""].update(terms)
    out = set()
    for lang, source in n:
        kept = [t for t in lang_docs[lang] if lang_docs[lang][t] >= min_docs]
        groups = {s: c for (x, s), c in n.items() if x == lang}
        p = {s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[t] for t in kept) + 5 * len(kept)) for t in kept} for s, c in groups.items()}
        whole = sum(groups.values(), Counter())
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole[t] for t in kept) + 5 * len(kept)) for t in kept}
        pairs = sorted((-sum(abs(p[source][t] - p[s][t]) for t in kept), s.encode()) for s in groups if s != source)
        own = sorted((q[t] - p[source][t], t.encode()) for t in kept if groups[source][t] and p[source][t] > q[t])[:top]
        out |= {(lang, source, part, item.decode(), -value, rank) for part, found in (("pair", pairs), ("term", own)) for rank, (value, item) in enumerate(found, 1)}
    return out


TERMS = "a bb eightlet nineletter sixteenlettersss seventeenletters éàü 日本語 x-y Über z9z".split() + ["q" * 33, "w" * 70, "w" * 700]
SOURCED = [(i, " ".join(random.Random(i).choices(TERMS, range(1, len(TERMS) + 1), k=40)), ["en", "de", None][i % 3], [None, "s1", "s2", "s3", "é"][i % 5]) for i in range(60)]
SOURCED += [(70, None, "en", "empty"), (71, "12 34", "de", ""), (72, "lone", "fr", "s1"), (73, None, "fr", "s2"), (None, "w" * 40_000 + " a", "en", "s1"), (1, SOURCED[1][1], "de", "s1")]


@pytest.mark.parametrize("settings", [{}, {"cells": 8, "tile": 2, "chunk": 300}, {"cells": 10, "tile": 1}])
def test_audit_matches_plain_version(spark, settings):
    found = divergence.audit(table(spark, SOURCED), min_docs=5, top=4, **settings).select("lang", "source", "part", "item", "value", "rank").collect()
    assert {tuple(r) for r in found} == audited(SOURCED, 5, 4) and len(found) == len({tuple(r) for r in found})
    assert divergence.audit(table(spark, [])).collect() == []


def test_shares_pass_64_bits(spark):
    row = spark.createDataFrame([(9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 7)], "n long, t long, v long")
    n, t, v = 9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 7
    assert row.select(divergence._share("n", "t", "v", 5)).first()[0] == 1 + 10**9 * (n + 5) // (t + 5 * v)


def test_radix_order_is_stable():
    draw = np.random.default_rng(1)
    columns = [draw.integers(0, 3, 500, np.uint64) << np.uint64(60), draw.integers(0, 2**64, 500, np.uint64) & np.uint64(0xFF0000FF)]
    assert divergence.radix_order(columns).tolist() == np.lexsort(columns[::-1]).tolist()
    assert divergence.radix_order([np.zeros(0, np.uint64)]).tolist() == []


def test_op12_digest_of_kept_text(spark):
    for r in queries.op12_lines(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").where("n_dropped = 0").collect():
        assert r.kept_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
