"""The registered queries against plain-Python versions, on the smallest tables."""

import os

import pytest
from brute import base_scores, components, contamination, phrases, quality, scores, substrings

from isohyet.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_op1_every_id_lies_in_one_piece(spark, docs):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from isohyet.llm.packing import tokenizer_path

    model = Tokenizer.from_file(tokenizer_path())
    found = {}
    for r in rows(spark, "op1_packing"):
        found.setdefault(r["doc_id"], []).append(r)
    sequences = [r["sequence_id"] for own in found.values() for r in own]
    assert len(set(sequences)) == len(sequences)
    for d, text in docs:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(found[d], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["offset"]) == (at, len(ids), 0)
            assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_op2_matches_brute_force(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in rows(spark, "op2_decontamination")} == contamination(docs, items)


def test_op3_matches_brute_force(spark, docs):
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op3_simhash")} == components(docs)


def test_op4_matches_brute_force(spark, docs):
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows(spark, "op4_phrases")}
    assert found == phrases(docs)


def test_op5_matches_brute_force(spark, docs):
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(spark, "op5_suffixes")}
    assert found == substrings(docs)


def test_op6_round_trip(spark):
    import base64
    import hashlib

    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    top = {}
    for p in pages:
        top[p.html or ""] = max(top.get(p.html or "", -1), p.page_id)
    want = {}
    for p in pages:
        data, first = (p.html or "").encode(), top[p.html or ""]
        own = ("response", None) if first == p.page_id else ("revisit", first)
        want[p.page_id] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *own)
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows(spark, "op6_warc")} == want


def test_op8_edits_and_likeness(spark, docs):
    import hashlib

    from isohyet.llm.sketches import decode, encode, likeness, sketch

    order = sorted(docs, reverse=True)
    found = {r["doc_id"]: r for r in rows(spark, "op8_fingerprints")}
    assert len(found) == len(docs)
    for k, (d, text) in enumerate(order):
        nxt, text = order[(k + 1) % len(order)][1] or "", text or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + nxt[:cut]
        r = found[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        one, two, three = (sketch([t.encode()])[0] for t in (text, edited, nxt))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (encode(one), encode(two))
        assert r["near_edited"] == pytest.approx(likeness(decode(r["fingerprint"]), two))
        assert r["near_next"] == pytest.approx(likeness(one, three))


def test_op9_matches_brute_force(spark, docs):
    want, model = base_scores(docs), scores(docs)
    for r in rows(spark, "op9_lm_scoring"):
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model[r["doc_id"]], rel=1e-9)


def test_op7_matches_brute_force(spark):
    tables = [spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "labels")]
    want = quality([(r.doc_id, r.text, r.lang) for r in tables[0]], [(r.doc_id, r.quality, r.toxic) for r in tables[1]])
    found = rows(spark, "op7_quality")
    assert len(found) == len(want)
    for r in found:
        perplexity, evidence, keep = want[r["doc_id"]]
        assert r["perplexity"] == (perplexity if perplexity is None else pytest.approx(perplexity, rel=1e-9))
        assert r["evidence"] == pytest.approx(evidence, rel=1e-9, abs=1e-9) and r["keep"] == keep
    assert 0 < sum(r["keep"] for r in found) < len(found)
