"""Near-duplicate classes against brute force, and the whole pipeline."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from stayscope.llm import probminhash, quality
from stayscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_jaccard(a, b):
    return len(a & b) / max(1, len(a | b))


def brute_probability(a, b):
    both = set(a) & set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b)) for d in both)


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    got = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return got if got or not words else collections.Counter([tuple(words)])


def classes_of(texts):
    """Components of all pairs that are similar, by comparing every pair that shares a shingle."""
    sets = [counts(t) for t in texts]
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in {(i, j) for own in holders.values() for i in own for j in own if i < j}:
        if max(brute_jaccard(set(sets[i]), set(sets[j])), brute_probability(sets[i], sets[j])) >= 0.8:
            root[max(find(i), find(j))] = min(find(i), find(j))
    for i, t in enumerate(texts):  # equal texts, without words too
        j = texts.index(t)
        root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_probability_jaccard_and_its_sketch():
    rng = np.random.default_rng(0)
    keys = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64))
    for _ in range(5):
        wa = rng.integers(1, 9, 60)
        wb = np.where(rng.random(60) < 0.4, rng.integers(1, 9, 60), wa)
        a, b = (keys[:50], wa[:50]), (keys[8:], wb[8:])
        exact = brute_probability(dict(zip(*map(list, a), strict=True)), dict(zip(*map(list, b), strict=True)))
        assert np.isclose(probminhash.probability_jaccard(a, b), exact)
        signatures = probminhash.sketch([a, b], 4096)
        assert abs((signatures[0] == signatures[1]).mean() - exact) < 0.04
    ones = np.ones(50, np.int64)
    assert np.isclose(probminhash.probability_jaccard((keys[:50], ones), (keys[10:], ones)), 40 / 60)


def test_shingles_of_whole_texts():
    texts = ["a b c d e f", "a b c", "", "  a\tb\x0bc d e f ", "a b c d e f a b c d e f"]
    got = probminhash.shingles(pa.array(texts, pa.large_string()))
    assert [len(s) for s, _ in got] == [len(counts(t)) for t in texts]
    assert [sorted(c.tolist()) for _, c in got] == [sorted(counts(t).values()) for t in texts]
    assert got[0][0].tolist() == got[3][0].tolist()


def made_texts(rng):
    """Families of copies with growing changes, repeats, short and odd texts."""
    texts = ["", "one", "one", "two words", " two  words "]
    for _ in range(6):
        base = [f"w{rng.integers(500)}" for _ in range(rng.integers(20, 150))]
        for change in (0, 1, 2, 4, 8):
            own = list(base)
            for _ in range(change):
                own[rng.integers(len(own))] = f"x{rng.integers(10**6)}"
            texts.append(" ".join(own))
        texts.append(" ".join(base + base[:40] * 3))
        texts.append(" ".join(base + base[:40] * 3 + ["tail"]))
    return texts


@pytest.mark.parametrize(("texts_of_block", "shingles_of_block"), [(4, 65_536), (256, 300), (256, 65_536)])
def test_classes_match_brute_force(spark, monkeypatch, texts_of_block, shingles_of_block):
    monkeypatch.setattr(probminhash, "BLOCK", texts_of_block)
    monkeypatch.setattr(probminhash, "BLOCK_SHINGLES", shingles_of_block)
    texts = made_texts(np.random.default_rng(8))
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)] + [(900, None, "x", 0), (901, None, "x", 0), (3, texts[3], "x", 0), (None, texts[3], "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, class_id int")
    got = probminhash.near_duplicate_classes(docs).collect()
    assert len(got) == len(rows)
    want = dict(enumerate(classes_of(texts))) | {900: 900, 901: 901, None: 3}
    assert {r.doc_id: r.class_id for r in got} == want
    kept = probminhash.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({v for v in want.values()} - {3})
    assert sum(r.doc_id is None for r in kept.collect()) == 1
    assert probminhash.near_duplicate_classes(docs.limit(0)).count() == 0


def test_weighted_sets_are_compared_only_where_they_can_be_alike(monkeypatch):
    """Links of a block are those of all pairs, without working out every pair."""
    rng = np.random.default_rng(5)
    base, members = rng.integers(0, 2**63, 200).astype(np.uint64), []
    for i in range(60):
        own = np.unique(np.where(rng.random(200) < (0.05 if i % 3 else 0.5), rng.integers(0, 2**63, 200).astype(np.uint64), base))
        counts = rng.integers(1, 3, len(own)) if i % 4 else np.ones(len(own), np.int64)
        members.append({
            "side": int(i >= 40), "node": bytes([i]), "label": bytes([i % 7]), "hashes": own.astype("<u8").tobytes(),
            "counts": counts.astype("<u4").tobytes() if counts.max() > 1 else b"",
        })
    sets = {m["node"]: probminhash._set(m["hashes"], m["counts"]) for m in members}
    want = {
        (a["node"], b["label"]) for a in members[40:] for b in members[:40]
        if a["label"] != b["label"] and probminhash.similarity(sets[a["node"]], sets[b["node"]]) >= probminhash.SIMILAR
    }
    calls, similarity = [], probminhash.similarity
    monkeypatch.setattr(probminhash, "similarity", lambda a, b: calls.append(1) or similarity(a, b))
    for asked in (members[40:], members[40:42]):
        found = probminhash._links_of_block(members[:40] + asked, probminhash.SIMILAR)
        nodes = {m["node"] for m in asked}
        assert {(a, lb) if a in nodes else (b, la) for a, b, la, lb, _ in found} == {w for w in want if w[0] in nodes}
        assert len(found) == len({w for w in want if w[0] in nodes}) > 0
    assert len(calls) < 300  # of 880 pairs


def test_chains_are_followed_through_full_buckets(spark):
    """Each text is like the next one only; a large group has members far apart."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[6 * i:6 * i + 120]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicate_classes(docs).collect()}
    assert got == dict(enumerate(classes_of(texts))) and set(got.values()) == {0}


def test_a_near_copy_without_a_key_keeps_its_link(spark):
    words = [f"w{i}" for i in range(200)]
    copy = [*words[:100], "other", *words[101:]]
    docs = spark.createDataFrame([(1, " ".join(words)), (None, " ".join(copy)), (None, "far away")], "doc_id long, text string")
    got = probminhash.near_duplicate_classes(docs).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_texts) for r in got) == [(0, 0, 1), (0, 1, 2), (1, 1, 2)]


def test_long_texts_and_rows_alike_in_key_and_text(spark):
    words = [f"w{i % 9_000}x{i // 9_000}" for i in range(20_000)]
    long, copy = " ".join(words), " ".join([*words[:-3], "new", "last", "words"])
    rows = [(1, long, "b", {"k": 2}), (1, long, "a", {"k": 3}), (1, long, "a", {"k": 1}), (2, copy, "z", None), (3, None, "n", None), (3, None, "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, node map<string, int>")
    kept = [(r.doc_id, r.label, r.node) for r in probminhash.one_per_class(docs).collect()]
    assert sorted(kept, key=repr) == [(1, "a", {"k": 1}), (3, "n", None), (3, "n", None)]
    plain = probminhash.one_per_class(docs.drop("node")).collect()
    assert sorted((r.doc_id, r.label) for r in plain) == [(1, "a"), (3, "n"), (3, "n")]


def test_corpus_classes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = {r.doc_id: r.class_id for r in QUERIES["op4_probminhash_classes"](spark, SF).collect()}
    want = classes_of([r.text for r in rows])
    assert got == {r.doc_id: rows[w].doc_id for r, w in zip(rows, want, strict=True)}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    good, clean, single, mixed, pieces = kept[1:]
    for table in (good, clean, single, mixed):
        assert table.columns == docs.columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(a >= b for a, b in zip(ids, ids[1:], strict=False)) and ids[4] == ids[5]
    judged = {r.doc_id for r in quality.quality_table(docs).collect() if r.kept}
    assert ids[1] == judged
    rows = clean.orderBy("doc_id").collect()
    classes = classes_of([r.text for r in rows])
    assert ids[3] == {rows[c].doc_id for c in set(classes)}
    assert pieces.filter("not same_text").isEmpty()
    assert corpus_pipeline.run(spark, SF).count() == len(ids[5])


@pytest.mark.parametrize("at", range(5))
def test_stages_take_empty_tables(spark, at):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[at][1](spark, docs, SF).count() == 0
