"""Operators against brute force, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import chat, common, decontam, exactdup, langid, mixing, neardup, ppm, sharding, tokens, toxicity

KIND = "doc_id long, text string, lang string, source string, n_chars long, _text string, size int, _id string, kept string, score double"
rng = np.random.default_rng(5)
WORDS = ["w%d" % i for i in range(300)]


def say(n):
    return " ".join(rng.choice(WORDS, n))


def near(text, edits):
    words = text.split()
    for i in rng.integers(0, len(words), edits):
        words[i] = str(rng.choice(WORDS))
    return " ".join(words)


ITEM = say(14)
BASE = say(120)
LONG = say(30_000)
TEXTS = [
    None, "", " \t\n", "one", "One", "one", "...", BASE, BASE, BASE.replace(" ", "  "), near(BASE, 2), near(BASE, 4), near(BASE, 9), near(BASE, 25),
    "before " + ITEM.upper() + " after", ITEM, " ".join(ITEM.split()[2:13]), " ".join(ITEM.split()[:9]), say(60), LONG, LONG, near(LONG, 100), "été çà ñ", "A\tB\r\nC", "A B C", "a b c",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 7 == 0 else "ab"[i % 2], None if i % 5 == 0 else f"s{i % 3}", 0, "x", 1, "y", "z", 0.5) for i, t in enumerate(TEXTS)]
    rows += [rows[7], (None, "no id", "a", "s1", 0, "x", 1, "y", "z", 0.5), (None, BASE, "b", "s1", 0, "x", 1, "y", "z", 0.5)]
    return common.materialise(spark, spark.createDataFrame(rows, KIND).repartition(3), "fixture")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_exact_dedup(spark, docs):
    import re

    groups = {}
    for i, t in rows_of(docs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    got = exactdup.exact_dedup(docs).collect()
    assert len(got) == docs.count()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in got) == len(groups)
    assert exactdup.exact_dedup(docs.limit(0)).count() == 0


def test_exact_dedup_hot(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot  text").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = exactdup.exact_dedup(rows)
    hot = got.filter("group_size > 1").agg(F.count("*"), F.min("group_size"), F.max("keep_id"), F.count_if("kept")).first()
    assert tuple(hot) == (1000, 1000, 0, 1)


def brute_shards(sizes, shards):
    low, high = max(sizes), sum(sizes)

    def need(c):
        n, room = 1, c
        for s in sizes:
            if s > room:
                n, room = n + 1, c
            room -= s
        return n

    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if need(mid) <= shards else (mid + 1, high)
    return low


def test_sharding(spark, docs):
    got = sharding.minimax_shards(spark, docs, 4).collect()
    rows = rows_of(docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    order = sorted(groups.items(), key=lambda g: (min((i for i in g[1] if i is not None), default=-1), hashlib.sha256(g[0].encode()).hexdigest()))
    best = brute_shards([(len(t.encode()) + 1) * len(ids) for t, ids in order], 4)
    load = Counter()
    for r in got:
        load[r.shard] += r["size"]
    assert max(load.values()) == best
    for s in load:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.minimax_shards(spark, docs.limit(0), 4).count() == 0
    assert {r.shard for r in sharding.minimax_shards(spark, docs.limit(1), 8).collect()} == {0}


def test_sharding_refines_its_sketch(spark):
    """A sketch of few sums finds what all sums give."""
    sizes = rng.integers(0, 400, 600).tolist() + [3000]
    rows = [(i, f"{i:04d}" + "x" * n) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shards in (1, 3, 7):
        got = {r.doc_id: r.shard for r in sharding.minimax_shards(spark, docs, shards, sketch=20).collect()}
        assert got == {r.doc_id: r.shard for r in sharding.minimax_shards(spark, docs, shards).collect()}
        load = Counter()
        for i, t in rows:
            load[got[i]] += len(t) + 1
        assert max(load.values()) == brute_shards([len(t) + 1 for _, t in rows], shards) and sorted(got.values()) == [got[i] for i in range(len(rows))]


def test_mixing(spark, docs):
    got = mixing.mix(spark, docs)
    again = mixing.mix(spark, docs.repartition(5))
    key = lambda r: (str(r.doc_id), r["size"], str(r.source), r.taken)
    rows = got.collect()
    assert sorted(map(key, rows)) == sorted(map(key, again.collect()))
    size = Counter()
    for r in docs.collect():
        size[r.source] += len((r.text or "").encode().split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
            free.remove(s)
    target |= share
    for r in rows:
        assert abs(r.target - target[r.source]) < 1e-6 and r.source_size == size[r.source] and r.taken in (0, r["size"], 2 * r["size"])
    for s in names:
        assert abs(sum(r.taken for r in rows if r.source == s) - target[s]) <= max(r["size"] for r in rows if r.source == s)
    assert mixing.mix(spark, docs.limit(0)).count() == 0


def test_pivot_keeps_words_and_expectation():
    seen = []
    for k in range(4000):
        a, b = mixing.pivot(7, 0.4, 3, 0.5, mixing._uniform(k))
        assert abs(7 * a + 3 * b - (2.8 + 1.5)) < 1e-9 and (a in (0, 1) or b in (0, 1)) and 0 <= a <= 1 and 0 <= b <= 1
        seen.append(a)
    assert abs(np.mean(seen) - 0.4) < 0.02


def words(t):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_decontamination(spark, docs):
    items = [(1, ITEM), (2, "one"), (3, None), (4, "..."), (10, BASE), (1, ITEM), (5, "w1 w2 w3"), (None, "été ça")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if i is None else str(i))
    want = Counter()
    for i, t in rows_of(docs):
        w, hit, found = words(t), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if own := windows.get(tuple(w[k : k + n])) if k + n <= len(w) else None:
                    hit |= set(range(k, k + n))
                    found |= own
        want[i, len(w), len(hit), ",".join(sorted(found))] += 1
    for block in (decontam.BLOCK_WINDOWS, 9):
        got = decontam.decontaminate(spark, docs, bench, block_windows=block)
        assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in got.collect()) == want
    assert {r.n_hit for r in decontam.decontaminate(spark, docs, bench.limit(0)).collect()} == {0}
    assert decontam.decontaminate(spark, docs.limit(0), bench).count() == 0


def test_decontamination_of_many_windows():
    """An index of 300,000 windows stays small, and a passage that every item has gives all of them."""
    import pickle

    passage = b" ".join(b"p%d" % i for i in range(12))
    items = [(str(i), decontam.words(b" ".join(b"w%d" % x for x in rng.integers(0, 5000, 3000)) + b" " + passage)) for i in range(100)]
    index = decontam.Index(items, 10, 5)
    index.order({k: np.ones(len(x), np.int64) for k, x in index.keys.items()})
    assert len(pickle.dumps(index)) < 40 * 300_000
    n, mask, found = index.hits(b"before " + passage + b" after " + b" ".join(items[7][1][50:61]) + b" end")
    assert (n, mask.sum()) == (26, 23) and found == sorted(map(str, range(100)))


def test_near_dedup(spark, docs):
    rows = rows_of(docs)
    for width in (2, 5):
        sets = []
        for _, t in rows:
            w = (t or "").encode().lower().split()
            k = min(width, len(w))
            sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
        label = list(range(len(rows)))
        for a in range(len(rows)):
            for b in range(a):
                n = len(sets[a] & sets[b])
                if n and 100 * n >= 80 * len(sets[a] | sets[b]):
                    label = [label[b] if x == label[a] else x for x in label]
        ids = lambda a: min((rows[b][0] for b in range(len(rows)) if label[b] == label[a] and rows[b][0] is not None), default=None)  # noqa: B023, E731
        want = Counter((rows[a][0], len(sets[a]), ids(a) if sets[a] else rows[a][0]) for a in range(len(rows)))
        got = neardup.near_dedup(spark, docs, width, 80).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert neardup.near_dedup(spark, docs.limit(0)).count() == 0


def near_rows(spark, sets, monkeypatch, blocks, whole):
    """Class ids of documents of the given words, against brute force, with small blocks."""
    monkeypatch.setattr(neardup, "BLOCK_SETS", blocks)
    monkeypatch.setattr(neardup, "WHOLE", whole)
    rows = [(i, " ".join(map(str, s))) for i, s in enumerate(sets)]
    got = {r.doc_id: r.component_id for r in neardup.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()}
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a]), set(sets[b])
            if 100 * len(x & y) >= 80 * len(x | y):
                label = [min(label[a], label[b]) if z in (label[a], label[b]) else z for z in label]
    assert got == dict(enumerate(label))


def test_near_dedup_of_large_clusters(spark, monkeypatch):
    """Clusters of more blocks than are compared all with all: a group of near copies with some apart, and a chain."""
    base = list(range(40))
    copies = [[x + 1000 * (k + 1) * (x in rng.choice(40, int(rng.integers(0, 9)), replace=False)) for x in base] for k in range(70)]
    chain = [[5000 + i for i in range(4 * k, 4 * k + 40)] for k in range(40)]
    near_rows(spark, copies + chain, monkeypatch, 4, 2)


def test_near_dedup_broadcasts_few_classes(spark, monkeypatch):
    """Without groups of a thousandth of all rows nothing is broadcast in the last joins, and ids can be joined by a shuffle."""
    seen = []
    plain = common.hot_join
    monkeypatch.setattr(neardup, "hot_join", lambda big, small, key, rows, total: (seen.append((key, total, small.filter(F.col(rows) >= max(1, total // common.HOT_KEYS)).count())), plain(big, small, key, rows, total))[1])
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    rows = spark.range(5002).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d e f g "), F.when(F.col("id") < 5000, F.concat_ws(" ", *[F.xxhash64("id", F.lit(i)).cast("string") for i in range(12)])).otherwise("h i j k l m n o p q r s")).alias("text"))
    got = neardup.near_dedup(spark, rows, 2, 80)
    assert [(r.component_id, r["count"]) for r in got.groupBy("component_id").count().filter("count > 1").collect()] == [(5000, 2)]
    assert {key: hot for key, total, hot in seen if key in ("component", "_set")} == {"component": 0, "_set": 0}
    assert {total for key, total, _ in seen if key == "component"} == {5001}


def test_near_dedup_blocks():
    """Links over blocks connect what brute force connects."""
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(40)]
    link = neardup.linked(sets[:20], sets[20:], 50)
    for i in range(20):
        for j in range(20):
            n = len(np.intersect1d(sets[i], sets[20 + j]))
            assert link[i, j] == (100 * n >= 50 * (len(sets[i]) + len(sets[20 + j]) - n))


def test_sketch_estimates_similarity():
    a = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    b = np.r_[a[:300], rng.integers(0, 1 << 62, 100).astype(np.uint64)]
    small = [a[:1], a[:3]]
    s = neardup.sketches([np.unique(a), np.unique(b), *small, a[:0]])
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.1
    assert (s[:4] != neardup._EMPTY).all() and (s[4] == neardup._EMPTY).all()


def test_lm_scores(spark, docs):
    rows = rows_of(docs)
    train = docs.filter("doc_id % 2 = 0")
    count, texts = Counter(), 0
    for i, t in rows:
        if i is not None and i % 2 == 0:
            count.update((t or "").encode().lower().split())
            texts += 1
    n, v = sum(count.values()) + texts, len(count) + 1
    want = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        want.append((str(i), len(w) + 1, sum(count[x] > 0 for x in w) + 1, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((texts + 1) / (n + v + 1)), 6)))
    got = ppm.lm_scores(spark, docs, train, head=20).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == sorted(want)
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    none = ppm.lm_scores(spark, docs.filter("doc_id = 3"), docs.limit(0)).first()
    assert (none.n_known, none.base_score) == (0, 0.0) and abs(none.score + 4 * math.log10(256)) < 1e-4
    assert ppm.lm_scores(spark, docs.limit(0), train).count() == 0


def plain_trie(texts):
    """Counts of all contexts and symbols after them, and the model over them in one process."""
    keys, counts = ppm.grams(texts)
    table = Counter()
    for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
        run = k.to_bytes(ppm.ORDER + 1)
        for o in range(ppm.ORDER + 1):
            table[run[ppm.ORDER - o : -1], run[-1]] += c
    return table, ppm.Trie(np.array([ppm.context_key(c) for c, _ in table]), np.array([s for _, s in table]), np.array(list(table.values())))


def plain_ppm(train, texts):
    trie = plain_trie(train)[1]
    return [float(trie.score([t])[0]) for t in texts]


def test_trie_is_a_distribution_and_scores_as_by_hand():
    texts = [t.encode().lower().split() for t in ("abra cadabra", "abra", "banana band", "")]
    table, trie = plain_trie(texts)
    chance = 10.0 ** trie.code.astype(float)
    assert np.allclose(chance[:, :-1].sum(axis=1) + chance[:, -1] * (257 - trie.width), 1, atol=1e-4)

    def by_hand(stream):
        total, past = 0.0, bytes([ppm.END]) * ppm.ORDER
        for s in stream:
            out, p = set(), 1.0
            for o in range(ppm.ORDER, -1, -1):
                own = {x: n for (c, x), n in table.items() if c == past[len(past) - o :] and x not in out}
                if s in own:
                    p *= (own[s] - 0.5) / sum(own.values())
                    break
                if own:
                    p *= len(own) / 2 / sum(own.values())
                    out |= set(own)
            else:
                p /= 256 - len(out)
            total += math.log10(p)
            past = (past + bytes([s]))[-ppm.ORDER :]
        return total

    new = [t.split() for t in (b"abra band", b"zoo", b"", b"banana " * 200)]
    want = [by_hand(b" ".join(t) + bytes([ppm.END])) for t in new]
    assert np.allclose(trie.score(new), want, rtol=1e-4)


def test_lm_scores_use_every_context(spark):
    own = np.random.default_rng(6)
    alphabet = list("abcdefghijklmnopqrstuvwxyz0123456789ABé字")
    texts = ["".join(own.choice(alphabet, 8)) + " " + "".join(own.choice(alphabet[:6], 40)) for _ in range(2500)] + ["", "zz  zz"]
    train = texts[:2000]
    asked = [*texts[1900:2100], *texts[-2:], None, "\x01\x02 ~~~ never", "abc " * 300]
    table, trie = plain_trie([ppm.normalised(t.encode()) for t in train])
    assert len({c for c, _ in table}) > 49_152
    want = trie.score([ppm.normalised(t and t.encode()) for t in asked])
    model = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "doc_id long, text string")
    new = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    few = {r.doc_id: r.score for r in ppm.lm_scores(spark, new, model, frequent_runs=100).collect()}
    assert np.allclose([few[i] for i in range(len(asked))], want, rtol=1e-5)
    all_held = {r.doc_id: r.score for r in ppm.lm_scores(spark, new, model).collect()}
    assert np.allclose([all_held[i] for i in range(len(asked))], want, rtol=1e-5)


def test_token_round_trip(spark, docs, tmp_path):
    path = str(tmp_path / "out")
    manifest = tokens.write_shards(spark, docs, path, length=16, shard_bytes=2000, key=3)
    got = tokens.read_shards(spark, path, with_tokens=True).collect()
    assert sorted(r.slot for r in got) == list(range(manifest["sequences"]))
    assert all(divmod(r.slot, manifest["records"]) == (r.shard, r.byte_offset // manifest["stride"]) for r in got) and len({r.shard for r in got}) > 3
    # The permutation of the sequences' numbers gives the slots.
    made = tokens.Feistel(manifest["sequences"], 3).slots(np.arange(manifest["sequences"])).tolist()
    assert sorted(made) == sorted(r.slot for r in got)
    number = {slot: i for i, slot in enumerate(made)}
    runs = sorted((number[r.slot], str(r.doc_id), r.part) for r in got)
    assert all(b[2] == 0 or (a[1], a[2] + 1) == b[1:] for a, b in zip(runs, runs[1:], strict=False))
    for first in (0, 7, manifest["records"], manifest["sequences"] - 1, manifest["sequences"]):
        want = [(r.slot, r.doc_id, r.part, r.tokens) for r in sorted(got, key=lambda r: r.slot) if r.slot >= first]
        assert [(s, i, k, t.tolist()) for s, i, k, t in tokens.resume(spark, path, first, 3)] == want
    texts = Counter((i, t or "") for i, t in rows_of(docs))
    for (i, t), n in texts.items():
        if n == 1 and i is not None:
            own = [x for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.part) for x in r.tokens]
            assert tokens.decode(own) == t
    assert sum(r.doc_id is None and r.part == 0 for r in got) == 2
    assert [r.slot for r in got] != [r.slot for r in sorted(got, key=lambda r: (str(r.doc_id), r.part))]
    later = tokens.read_shards(spark, path, first_slot=100)
    assert later.agg(F.min("slot")).first()[0] == 100
    tokens.write_shards(spark, docs.limit(0), str(tmp_path / "none"))
    assert tokens.read_shards(spark, str(tmp_path / "none")).count() == 0


def test_tokens_are_those_of_the_whole_pattern():
    with open(tokens.VOCABULARY, "rb") as f:
        tokenizer = tokens.tokenizer(f.read())
    parts = [" ", " ", "\n", "\t ", "\x1c", "\x1f ", "\x85", "\u2003", "\u3000", "a", "word", "it's", "12", "é", "字", "!?", "'ll", "\ufeff", "\u200b"]
    texts = ["", " ", "a ", *("".join(rng.choice(parts, rng.integers(1, 12))) for _ in range(4000))]
    assert sum(tokens.NEIGHBOURS.search(t) is None for t in texts) > 500
    for t in texts:
        assert np.frombuffer(tokenizer.encode(t), np.uint16).tolist() == [*tokenizer.encoding.encode_ordinary(t), tokenizer.end]


def test_ids_must_be_integers(spark):
    named = spark.createDataFrame([("a", "x y", "s")], "doc_id string, text string, source string")
    for op in (lambda: tokens.token_output(spark, named), lambda: mixing.mix(spark, named)):
        with pytest.raises(ValueError, match="doc_id must be an integer"):
            op()


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        assert sorted(tokens.Feistel(n, 9).slots(np.arange(n)).tolist()) == list(range(n))
    assert tokens.Feistel(1000, 1).slots(np.arange(1000)).tolist() != tokens.Feistel(1000, 2).slots(np.arange(1000)).tolist()


def test_language_id(spark, docs):
    vocab = {"x": ["der", "und", "nicht", "schon"], "y": ["que", "los", "hacia", "nunca"]}
    rows = [(i, " ".join(rng.choice(vocab["xy"[i % 2]], 8)), "xy"[i % 2]) for i in range(60)] + [(90, None, "x"), (91, "que", None)]
    model = langid.fit(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    ask = [("a", "und DER nicht"), ("b", "nunca los"), ("c", None), ("d", "12 ... 5"), ("e", "schonn"), ("f", "haciaque"), ("g", "字"), ("h", "")]
    got = {r.k: r for r in langid.identify(spark, spark.createDataFrame(ask, "k string, text string"), model, keep=("k",)).collect()}
    assert [got[k].lang_pred for k in "abcdefh"] == ["x", "y", "und", "und", "x", "y", "und"]
    assert got["g"].lang_pred in ("x", "y") and all(0 <= r.score <= 1 for r in got.values())
    bare = langid.fit(spark, docs.limit(0))
    assert {r.lang_pred for r in langid.identify(spark, docs, bare).collect()} == {"und"}
    assert langid.identify(spark, docs.limit(0), model).count() == 0


def test_language_id_counts_ngrams_of_whole_words(spark):
    rows = [(i, "a" * 70 + ("bc" if i % 2 else "de") * 20, "xy"[i % 2]) for i in range(4)]
    model = langid.fit(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [x for x, _ in model.predict(["bcbcbc", "dedede"])] == ["y", "x"]
    long = "".join(map(chr, np.random.default_rng(8).integers(0x4E00, 0x9000, 150_000)))
    batch = pa.RecordBatch.from_pydict({"lang": ["z"], "word": [long], "n": [2]})
    got = list(langid._grams([batch]))
    assert len(got) > 1 and max(b.num_rows for b in got) <= 350_000
    assert sum(sum(b.column(2).to_pylist()) for b in got) == 2 * sum(len(long) + (2 if n > 1 else 0) - n + 1 for n in range(1, 5))


def test_language_id_keeps_all_words_and_ngrams(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters[:4] for b in letters for c in letters for d in letters]
    rows = [(1, " ".join(words), "x"), (2, " ".join(w + "é" for w in words), "y"), (3, "aaaa aaaa", "y")]
    model = langid.fit(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    grams = [Counter(), Counter()]
    for at, ws in ((0, words), (1, [w + "é" for w in words] + ["aaaa", "aaaa"])):
        for w in ws:
            for n in range(1, 5):
                t = f" {w} " if n > 1 else w
                grams[at].update(t[i : i + n] for i in range(len(t) - n + 1))
    known = dict(zip(model.grams.tolist(), model.gram_rows.tolist(), strict=True))
    assert set(model.words) == {*words, *(w + "é" for w in words)} and set(known) == {*grams[0], *grams[1]}
    v, total = len(model.words), np.array([len(words), len(words) + 2])
    want = np.log((np.array([1, 2]) + 0.5) / (total + 0.5 * v))
    assert np.allclose(model.scores[model.words["aaaa"]], want - want.max())
    for n in range(1, 5):
        own = {g: np.array([grams[0][g], grams[1][g]]) for g in known if len(g) == n}
        logs = np.log((np.array(list(own.values())) + 0.5) / (np.sum(list(own.values()), axis=0) + 0.5 * len(own)))
        assert np.allclose([model.gram_scores[known[g]] for g in own], logs - logs.max(axis=1, keepdims=True))


def test_language_id_as_a_plain_backoff_scorer(spark):
    """Every prediction, against loops over words and n-grams; more words than are looked up at once."""
    letters = {"x": "abcde", "y": "cdefg", "z": "defgh"}
    word = lambda a: "".join(rng.choice(list(letters[a]), rng.integers(1, 7)))
    rows = [(i, " ".join(word("xyz"[i % 3]) for _ in range(40)), "xyz"[i % 3]) for i in range(30)]
    model = langid.fit(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts, grams = {a: Counter() for a in "xyz"}, {(a, n): Counter() for a in "xyz" for n in range(1, 5)}
    for _, t, a in rows:
        for w in t.split():
            counts[a][w] += 1
            for n in range(1, 5):
                p = f" {w} " if n > 1 else w
                grams[a, n].update(p[i : i + n] for i in range(len(p) - n + 1))
    logs = lambda table, key: (lambda v: np.array([math.log((t[key] + 0.5) / (sum(t.values()) + 0.5 * v)) for t in table]))(len(set().union(*table)))

    def plain(t):
        total = np.zeros(3)
        for w in t.split():
            if any(counts[a][w] for a in "xyz"):
                total += logs([counts[a] for a in "xyz"], w)
                continue
            for n in range(4, 0, -1):
                p = f" {w} " if n > 1 else w
                table = [grams[a, n] for a in "xyz"]
                found = [g for g in (p[i : i + n] for i in range(len(p) - n + 1)) if any(t[g] for t in table)]
                if found:
                    own = [logs(table, g) for g in found]
                    total += np.mean([o - o.max() for o in own], axis=0)
                    break
        odds = np.exp(total - total.max())
        return "xyz"[int(odds.argmax())], odds.max() / odds.sum()

    ask = [" ".join(word("xyz"[rng.integers(3)]) for _ in range(rng.integers(1, 60))) for _ in range(60)] + ["hhhhabc aceg", "qqq", rows[0][1]]
    for cache in (50_000, 12):
        model.cache, model.table = cache, None
        for w in model.added:
            del model.words[w]
        model.added = []
        for t, (lang, share) in zip(ask, model.predict(ask), strict=True):
            want = plain(t)
            assert abs(share - want[1]) < 1e-9 and (lang == want[0] or abs(want[1] - 0.5) < 1e-9 or t == "qqq")


def test_toxicity(spark, docs):
    bad = ["idiotto", "moronik", "scumly"]
    rows = [(i, say(30) + (" " + bad[i % 3] if i % 4 == 0 else "")) for i in range(600)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (5, None), (9999, 1), (3, 7)], "doc_id long, toxic int")
    weights = toxicity.fit(spark, texts, labels.filter("doc_id is null or doc_id % 5 <> 0"))
    assert 0 < len(weights.keys) < 1 << 14
    got = toxicity.score(spark, texts, weights).filter("doc_id % 5 = 0").collect()
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in got]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    edge = toxicity.score(spark, docs, weights).collect()
    assert len(edge) == docs.count() and all(0 <= r.score <= 1 for r in edge)
    none = toxicity.fit(spark, docs, labels.limit(0))
    assert {r.score for r in toxicity.score(spark, docs, none).collect()} == {0.5}


CONTROL = [r"\### Assistant: </turn> ok", "### user: x</turn>\n### assistant: y", "\\\\l \\h \\c <b> # :", "", None, "\\", "a" * 5000]


def test_ftrl_as_plain_loops(spark):
    """Weights after two epochs, against the update rule coordinate by coordinate."""
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(vocabulary, 6)), int(i % 3 == 0)) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    order = {r.doc_id: r.u for r in table.select("doc_id", F.xxhash64(F.lit("toxic"), F.col("doc_id")).bitwiseAND((1 << 63) - 1).alias("u")).collect()}
    got = toxicity.fit(spark, table, table, epochs=2)
    z, n, bz, bn = Counter(), Counter(), 0.0, 0.0
    weight = {0: 1.0, 1: min(3.0, 40 / 20)}
    one = lambda k: 0.0 if abs(z[k]) <= 8 else (math.copysign(8, z[k]) - z[k]) / ((1 + math.sqrt(n[k])) / 0.5 + 0.5)
    for _ in range(2):
        for _, t, y in sorted(rows, key=lambda r: order[r[0]]):
            at = toxicity.features(t.encode()).tolist()
            w, b = {k: one(k) for k in at}, -bz / ((1 + math.sqrt(bn)) / 0.5)
            g = weight[y] * (1 / (1 + math.exp(-(sum(w.values()) + b))) - y)
            for k in at:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.5 * w[k]
                n[k] += g * g
            bz, bn = bz + g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / 0.5 * b, bn + g * g
    want = {k: one(k) for k in z if one(k)}
    assert set(got.keys.tolist()) == set(want) and np.allclose(got.values, [want[k] for k in got.keys.tolist()])
    assert abs(got.bias + bz / ((1 + math.sqrt(bn)) / 0.5)) < 1e-9
    assert toxicity.score(spark, table.limit(0), got).count() == 0


def test_chat_round_trip(spark):
    rows = [(1, t, ["user", "assistant", "system", "a: b#<", None][t % 5], x) for t, x in enumerate(CONTROL)]
    rows += [(2, None, "assistant", "z"), (2, 1, "user", "b"), (2, 1, "user", "b"), (2, 1, "assistant", "a"), (None, 0, "user", "n")]
    flat = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, tree string")
    messages = chat.from_turns(spark, flat)
    got = {r.tree: r for r in chat.format_trees(spark, messages).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.masked(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [(t.role, t.text) for t in got["c1"].turns] == [(r[2] or "", r[3] or "") for r in rows[: len(CONTROL)]]
    assert got["c1"].loss == "".join(r[3] or "" for r in rows[: len(CONTROL)] if r[2] == "assistant")
    assert [(t.role, t.text) for t in got["c2"].turns] == [("assistant", "z"), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert len(got["null"].turns) == 1
    assert chat.format_trees(spark, messages.limit(0)).count() == 0


def test_long_conversation(spark):
    """20,000 turns: nothing is held for all messages of all paths."""
    n = 20_000
    flat = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("<t"), F.col("id").cast("string")).alias("text"))
    got = chat.format_trees(spark, chat.from_turns(spark, flat)).select(F.size(chat.parse(F.col("formatted"))).alias("n"), F.md5(chat.masked(F.col("formatted"), F.col("loss_spans"))).alias("loss"), F.size("path").alias("p")).collect()
    assert [tuple(r) for r in got] == [(n, hashlib.md5("".join(f"<t{i}" for i in range(1, n, 2)).encode()).hexdigest(), n)]


def test_all_paths_of_a_tree(spark):
    """Every root-to-leaf path, against recursion; a root with many replies."""
    parents = {0: None} | {i: int(rng.integers(0, i)) if i % 3 else 0 for i in range(1, 60)}
    score = {i: float(rng.integers(-3, 9)) for i in parents}
    rows = spark.createDataFrame([("t", i, p, "user", "x", score[i]) for i, p in parents.items()], "tree string, msg int, parent int, role string, text string, score double")

    def up(i):
        return [] if i is None else [*up(parents[i]), i]

    paths = [up(i) for i in parents if i not in parents.values()]
    want = sorted(paths, key=lambda x: (-sum(score[i] for i in x), -len(x), x[-1]))
    got = chat.format_trees(spark, rows, best=None).orderBy("branch").collect()
    assert [r.path for r in got] == want and [r.score for r in got] == [sum(score[i] for i in x) for x in want]


def test_chat_trees(spark):
    edges = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 5.0), (4, 2, 9.0), (5, 3, 1.0), (6, 77, 1.0), (8, 9, 1.0), (9, 8, 1.0), (10, 9, 3.0)]
    rows = spark.createDataFrame([("t", m, p, "user", f"m{m}", s) for m, p, s in edges], "tree string, msg int, parent int, role string, text string, score double")
    got = chat.format_trees(spark, rows, best=9).orderBy("branch").collect()
    assert [(r.path, r.score) for r in got] == [([1, 2, 4], 10.0), ([1, 3, 5], 6.0), ([6], 1.0)]
    chain = spark.range(100).select(F.lit("c").alias("tree"), F.col("id").cast("int").alias("msg"), F.when(F.col("id") > 0, F.col("id") - 1).cast("int").alias("parent"), F.lit("user").alias("role"), F.lit("x").alias("text"), F.lit(None).cast("double").alias("score"))
    assert chat.format_trees(spark, chain).first().path == list(range(100))


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), *[(10 + i, 11 + i) for i in range(30)]]
    got = {r.node: r.label for r in common.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} | {i: 10 for i in range(10, 41)}
