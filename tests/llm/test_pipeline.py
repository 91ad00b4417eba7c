"""Each stage of the pipeline against a plain version, on what the stage before it kept."""

import os

import numpy as np
import pytest
from brute import contamination, quality as plain_quality, similar_groups, substrings

import corpus_pipeline
from isohyet.llm import common, quality, simhash

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def chain(spark):
    """The documents, then the result of each stage, written and read again."""
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(common.materialise(stage(spark, tables[-1], SF), f"test-{k}"))
    return tables


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_keep_the_columns(chain):
    for table in chain[1:-1]:
        assert table.dtypes == chain[0].dtypes


def test_quality_stage(spark, chain):
    kept = {d for d, _ in texts(chain[1])}
    told = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    scored = plain_quality([(r.doc_id, r.text, r.lang) for r in chain[0].collect()], told)
    assert kept == {d for d, (_, _, keep) in scored.items() if keep}
    labels = {d: (q, x) for d, q, x in told}
    clean = [d for d, v in labels.items() if v == (1, 0)]
    assert len([d for d in clean if d in kept]) >= 0.75 * len(clean)  # 87 labels say little


def test_quality_finds_abuse_and_junk(spark):
    """Held-out accuracy at the next scale: documents that no label tells about."""
    sf = os.environ.get("TEST_QUALITY_DIR", "/root/testdata/sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    told = {r.doc_id for r in labels.collect()}
    keep = {r.doc_id: r.keep for r in quality.assess(docs, labels).collect()}
    abuse = {"idiot", "moron", "worthless", "pathetic", "clown", "trash", "stupid", "loser", "scum", "disgusting"}
    free = [(d, t) for d, t in texts(docs) if d not in told]
    toxic = [d for d, t in free if abuse & set(t.lower().split())]
    junk = [d for d, t in free if t.count("###") + t.count("!!") > 20]
    plain = [d for d, t in free if d not in toxic and t.count("###") + t.count("!!") + t.count(" | ") == 0]
    assert len(toxic) > 10 and sum(not keep[d] for d in toxic) >= 0.9 * len(toxic)
    assert len(junk) > 10 and not any(keep[d] for d in junk)
    assert sum(keep[d] for d in plain) >= 0.93 * len(plain)


def test_near_duplicate_stage(chain):
    want = set(similar_groups(texts(chain[1])).values())
    assert {d for d, _ in texts(chain[2])} == want


def test_substring_stage(chain):
    want = substrings(texts(chain[2]))
    got = {r.doc_id: r for r in chain[3].collect()}
    assert set(got) == set(want)
    for d, (n, gone, _, _) in want.items():
        assert len(got[d].text.encode()) <= n - gone and got[d].n_chars == len(got[d].text)
        assert n - gone - len(got[d].text.encode()) <= 8  # only parts of characters are lost besides


def test_decontamination_stage(spark, chain):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = contamination(texts(chain[3]), items)
    assert {d for d, _ in texts(chain[4])} == {d for d, v in want.items() if not v[4]}


def test_packing_stage_and_run(spark, chain):
    got = chain[5].collect()
    assert {r.doc_id for r in got} == {d for d, _ in texts(chain[4])}
    assert all(len(r.ids) == r.length for r in got)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, got))


def _cluster_shapes(shape):
    import random

    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(10**6)}"
    if shape == "sliding windows":  # each is like its neighbours alone
        line = [word() for _ in range(900)]
        return [" ".join(line[k * 24 : k * 24 + 300]) for k in range(25)]
    if shape == "template":  # half of the text in common, few alike
        common_part = [word() for _ in range(150)]
        texts = [" ".join(common_part + [word() for _ in range(150)]) for _ in range(60)]
        return texts + [t.rsplit(" ", 20)[0] for t in texts[::7]]
    if shape == "long templates":  # 0.76 alike, or more where own words are few
        heads = [[word() for _ in range(260)] for _ in range(2)]
        heads.append(heads[0][:250] + [word() for _ in range(10)])
        return [" ".join(heads[k % 3] + [word() for _ in range(25 + 3 * (k % 10))]) for k in range(60)]
    texts = []
    for _ in range(12):  # twenty texts of 300 words around one, each with a block of its own: pairs are just about alike
        base = [word() for _ in range(300)]
        for k in range(20):
            own = list(base)
            at = 14 * k
            own[at : at + 18] = [word() for _ in range(18)]
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("shape", ["sliding windows", "template", "long templates", "twelve clusters of twenty"])
def test_no_link_of_a_cluster_is_lost(spark, shape):
    words = _cluster_shapes(shape)
    common.ship(spark)
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    groups = similar_groups(list(enumerate(words)))
    assert len(set(groups.values())) < len(words)
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert {i: found.get(i, i) for i in groups} == groups
    if "template" in shape:  # heavy buckets, several turns
        found = {r.doc_id: r.component_id for r in simhash.similar_groups(docs, bound=2, few=0, rounds=1).collect()}
        assert {i: found.get(i, i) for i in groups} == groups


def _random_sets(count, seed=3):
    """Sets of one template with own elements, some of them just about 0.8 alike; sizes from 40 to 120."""
    rng = np.random.default_rng(seed)
    template = rng.integers(-(2**31), 2**31, 60)
    sets = []
    for _ in range(count):
        own = rng.integers(-(2**31), 2**31, rng.integers(4, 24))
        sets.append(np.unique(np.concatenate([template[rng.random(60) < 0.97], own])).astype(np.int32))
    return sets


def _groups(n, links):
    root = list(range(n))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[max(up(a), up(b))] = min(up(a), up(b))
    return [up(i) for i in range(n)]


def _alike(x, y):
    shared = len(set(x.tolist()) & set(y.tolist()))
    return shared >= 0.8 * (len(x) + len(y) - shared)


def test_parities_never_differ_more_than_sets():
    sets = _random_sets(40)
    rows = simhash._parities(sets)
    for x, p in zip(sets, rows, strict=True):
        for y, q in zip(sets, rows, strict=True):
            assert np.bitwise_count(p ^ q).sum() <= len(set(x.tolist()) ^ set(y.tolist()))


@pytest.mark.parametrize("rows, elements", [(2048, 10**6), (7, 10**6), (10**6, 300)])
def test_blocks_of_heavy_buckets_lose_no_link(spark, rows, elements):
    """One bucket with all prefixes of all sets under their own shingles, cut into blocks of any size: the groups are those of all pairs."""
    common.ship(spark)
    sets = _random_sets(60)
    table = spark.createDataFrame([(k, k, s.tolist()) for k, s in enumerate(sets)], "root long, name long, shingles array<int>")
    members = simhash._prefixes(table, 0.8)
    links = [tuple(r) for r in simhash._heavy_links(members, table, 0.8, rows=rows, elements=elements).collect()]
    pairs = [(a, b) for a in range(60) for b in range(a) if _alike(sets[a], sets[b])]
    assert pairs and all(a < b and _alike(sets[a], sets[b]) for a, b in links)
    assert _groups(60, links) == _groups(60, pairs)


def test_substring_stage_carries_every_column(spark):
    """Columns that the operator makes itself, or that documents don't have, keep their names, kinds and values."""
    passage = "a passage of more than fifty bytes that two documents have in common "
    rows = [(1, passage + "one", "en", 5, {"a": 1}, None), (2, "two " + passage, None, 6, None, [1.5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_bytes int, kept_sha256 map<string,int>, n_spans array<double>")
    cut = corpus_pipeline.repeated_substrings(spark, docs, SF)
    assert cut.dtypes == docs.dtypes
    assert [tuple(r)[2:] for r in cut.orderBy("doc_id").collect()] == [r[2:] for r in rows]
    assert len(cut.where("doc_id = 2").first().text) < len(rows[1][1])


def test_stages_leave_texts_where_they_are(spark, chain, monkeypatch):
    """What is rejected is broadcast where it is little, and near duplicates are looked for with one table of shingles, not two."""
    labels, real, seen, before = spark.read.parquet(f"{SF}/labels.parquet"), simhash.similar_links, [], set(common._made)

    def watch(sets, **settings):
        seen.extend(x for x in common._made - before if "shingle-sets" in x)
        return real(sets, **settings)

    monkeypatch.setattr(simhash, "similar_links", watch)
    with common.session_settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for kept in (quality.keep_good(chain[0], labels), simhash.drop_near_duplicates(chain[1])):
            assert "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
    assert not seen
