"""Registered queries over whole small tables, against their SQL or plain Python."""

import math
import zlib
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from sparkloom.llm import queries, tokens

HOME = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{HOME}/documents.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_as_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{HOME}/{t}.parquet')")
    got = entry.queries()[name](spark, HOME)
    rows = con.execute(queries.ORACLE[name])
    columns = [x[0] for x in rows.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(str, rows.fetchall())) == Counter(str(tuple(r)) for r in got.select(*columns).collect())


def fold(row, folds):
    return zlib.crc32(str(row["doc_id"]).encode()) % folds


def test_language_and_toxicity_queries(spark, documents):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{HOME}/labels.parquet").to_pylist()}
    by_id = {r["doc_id"]: r for r in documents}
    langs = [r for r in entry.queries()["op2_language_id"](spark, HOME).collect()]
    assert Counter(r.doc_id for r in langs) == Counter(r["doc_id"] for r in documents)
    assert all(r.held_out == (fold(by_id[r.doc_id], 5) == 0) and 0 <= r.score <= 1 for r in langs)
    known = [(r.lang_pred, by_id[r.doc_id]["lang"]) for r in langs if r.held_out and by_id[r.doc_id]["lang"] and r.lang_pred != "und"]
    assert sum(a == b for a, b in known) >= 0.95 * len(known)
    toxic = entry.queries()["op4_toxicity"](spark, HOME).collect()
    assert Counter(r.doc_id for r in toxic) == Counter(r["doc_id"] for r in documents)
    assert all(r.held_out == (fold(by_id[r.doc_id], 5) == 0) and r.predicted == (r.score >= 0.5) for r in toxic)
    seen = [(r.predicted, labels[r.doc_id]) for r in toxic if labels.get(r.doc_id) in (0, 1)]
    assert sum(a == b for a, b in seen) >= 0.9 * len(seen)


def test_mixing_query(spark, documents):
    got = entry.queries()["op5_mix_sources"](spark, HOME).collect()
    again = entry.queries()["op5_mix_sources"](spark, HOME).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    source = {r["doc_id"]: r["source"] for r in documents}
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        assert r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r["size"])
    assert all(abs(taken[s] - t) <= largest[s] for s, t in target.items())
    total = sum(len((r["text"] or "").encode().split()) for r in documents)
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6 * total


def test_token_shards_query(spark, documents):
    got = entry.queries()["op3_token_shards"](spark, HOME).collect()
    with open(tokens.VOCABULARY, "rb") as f:
        tokenizer = tokens.Tokenizer(f.read())
    want = Counter()
    for r in documents:
        own = tokenizer.encode(r["text"])
        want.update((r["doc_id"], part, zlib.crc32(own[at : at + 1024])) for part, at in enumerate(range(0, len(own), 1024)))
    assert Counter((r.doc_id, r.part, r.tokens_crc32) for r in got) == want
    assert sorted(r.slot for r in got) == list(range(len(got)))


def test_lm_score_query(spark, documents):
    """Scores of all documents, by one trie over the counts that the training documents have."""
    from sparkloom.llm import ppm

    from .test_ops import plain_ppm

    texts = {r["doc_id"]: ppm.normalised((r["text"] or "").encode()) for r in documents}
    train = [texts[r["doc_id"]] for r in documents if fold(r, 7) != 2]
    want = plain_ppm(train, list(texts.values()))
    got = {r.doc_id: r for r in entry.queries()["op6_lm_score"](spark, HOME).collect()}
    assert all(math.isclose(got[i].score, x, rel_tol=1e-4) for i, x in zip(texts, want, strict=True))
    assert all(got[r["doc_id"]].held_out == (fold(r, 7) == 2) for r in documents)
