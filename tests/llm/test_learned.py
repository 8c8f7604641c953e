"""Toxicity, mixture and the prefix forest against plain computations."""

import warnings
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayscope.llm import bytebpe, forest, mixture, toxicity
from stayscope.llm.wordwise import as_texts

SF = "/root/testdata/sf0.01"


def test_sentences_lie_where_they_say():
    texts = ["One two. Three four!\nfive", "", "no end", "\n\nx\n", "a  b.  c", "w " * 200]
    s = toxicity.sentences_of(as_texts(pa.array(texts)))
    at = 0
    for t, n in zip(texts, s.text_sentences.tolist(), strict=True):
        spans = list(zip(s.begin[at:at + n].tolist(), s.end[at:at + n].tolist(), strict=True))
        assert n >= 1 and "".join(t[a:b] for a, b in spans) == t
        at += n
    assert [t for t in ("One two. ", "Three four!", "five")] == [texts[0][a:b].strip("\n") for a, b in zip(s.begin[:4], s.end[:4], strict=True) if texts[0][a:b].strip()]


def test_noisy_or_is_learned_from_document_labels():
    rng = np.random.default_rng(5)
    common = [f"w{i}" for i in range(40)]
    texts, labels = [], []
    for k in range(300):
        sentences = [" ".join(rng.choice(common, 6)) + "." for _ in range(rng.integers(2, 9))]
        if k % 2:
            at = rng.integers(len(sentences))
            sentences[at] = sentences[at][:-1] + " vileword."
        texts.append(" ".join(sentences))
        labels.append(k % 2)
    s = toxicity.sentences_of(as_texts(pa.array(texts)))
    own = [toxicity.features_of(t) for t in s.tokens]
    flat = np.array([f for c in s.codes for f in own[c]])
    n = np.array([len(own[c]) for c in s.codes])
    per = np.add.reduceat(n, np.cumsum(s.sentence_tokens) - s.sentence_tokens)
    model = toxicity.fit(flat, per, s.text_sentences, np.array(labels))
    score, found, p = toxicity.Scorer(model).score(as_texts(pa.array(texts)))
    assert ((score >= 0.5) == np.array(labels)).all()
    owner = np.repeat(np.arange(300), found.text_sentences)
    for i in np.flatnonzero(p >= 0.5):
        assert "vileword" in texts[owner[i]][found.begin[i]:found.end[i]]
    doc = 1 - np.array([np.prod(1 - p[owner == k]) for k in range(300)])
    assert np.allclose(doc, score)


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_table(docs, labels)
    rows = got.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    met = got.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in met]) > 0.9
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in rows)
    # labels of held-out rows are never read
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r.doc_id, r.score) for r in toxicity.toxicity_table(docs, flipped).collect()} == {(r.doc_id, r.score) for r in rows}


def test_toxicity_without_teachers_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "x", 1), (2, "", 1), (2, "", 1), (3, "y " * 50_000, 1)], "doc_id long, text string, score int")
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity_table(docs, empty).collect()
    assert [r.score for r in got] == [0.0] * 5
    assert toxicity.toxicity_table(docs.limit(0), empty).count() == 0
    assert toxicity.drop_toxic(docs, empty).count() == 5


def test_sample_takes_one_row_of_a_key_and_bounds_the_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda features, per_sentence, per_text, labels: seen.append(labels.tolist()))
    docs = spark.createDataFrame([(i % 40, f"some words {i % 40} " * 50) for i in range(400)] + [(41, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)] + [(3, 1)] * 30, "doc_id long, toxic int")
    for most in (64_000_000, 3_000):
        toxicity.train(docs, labels, bytes_per_label=most)
    taught = 42 - sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in (*range(40), 41)) - 1
    assert len(seen[0]) == taught and 0 < len(seen[1]) < len(seen[0])


def test_rake_meets_the_marginals():
    rng = np.random.default_rng(2)
    members = [np.repeat(np.arange(3), 4), np.tile(np.arange(4), 3)]
    weights = rng.random(12) + 0.1
    targets = [np.array([0.5, 0.3, 0.2]), np.array([0.1, 0.2, 0.3, 0.4])]
    got = weights * mixture.rake(weights, members, targets)
    for own, target in zip(members, targets, strict=True):
        assert np.allclose(np.bincount(own, got) / got.sum(), target, atol=1e-9)
    # odds ratios stay those of the weights
    table, before = got.reshape(3, 4), weights.reshape(3, 4)
    assert np.isclose(table[0, 0] * table[1, 1] / table[0, 1] / table[1, 0], before[0, 0] * before[1, 1] / before[0, 1] / before[1, 0])
    assert mixture.rake(np.zeros(2), [np.array([0, 1])], [np.array([0.5, 0.5])]).tolist() == [1, 1]


def test_mixture_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("tokens", F.lit("clash"))
    vocabulary = bytebpe.vocabulary_path()
    got = mixture.mixture_table(docs, vocabulary).toPandas()
    assert len(got) == 1000 and got.probability.between(0, 1).all()
    assert np.isclose((got.tokens * got.probability).sum(), mixture.KEPT_SHARE * got.tokens.sum())
    free = got[(got.probability < 1) & (got.weight > 0)]
    assert np.ptp(free.probability / free.weight) < 1e-9  # one multiplier for all that are not kept whole
    encoder = bytebpe.byte_encoder(vocabulary)
    texts = {r.doc_id: r.text for r in docs.limit(50).collect()}
    assert all(got.tokens[got.doc_id == k].item() == len(encoder.whole(t)) + 1 for k, t in texts.items())
    for c in ("source", "lang", "topic"):
        now = got.groupby(c).tokens.sum() / got.tokens.sum()
        want = now**mixture.TEMPER / (now**mixture.TEMPER).sum()
        raked = (got.tokens * got.weight).groupby(got[c]).sum()
        assert np.allclose(raked / raked.sum(), want, atol=1e-6)
    again = mixture.mix_documents(docs, vocabulary)
    assert again.columns == docs.columns
    assert {r.doc_id for r in again.collect()} == set(got.doc_id[got.kept])
    given = mixture.mixture_table(docs, vocabulary, {"lang": {"de": 0.5, "en": 0.5}}).toPandas()
    share = (given.tokens * given.weight).groupby(given.lang).sum()
    assert np.isclose(share["de"], share["en"]) and share["fr"] == 0 and not given.kept[given.lang == "fr"].any()


def test_expected_tokens_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for targets in (None, {"source": {f"src{i}": (10 + i) / 390 for i in range(20)}}):
        table = mixture.mixture_table(docs, bytebpe.vocabulary_path(), targets, exact=True)
        got = table.toPandas()
        assert got.probability.between(0, 1).all()
        kept = (got.tokens * got.probability).sum()
        assert 0.01 * got.tokens.sum() < kept <= (mixture.KEPT_SHARE + 1e-6) * got.tokens.sum()
        for c in ("source", "lang", "topic"):
            now = got.groupby(c).tokens.sum() / got.tokens.sum()
            want = now**mixture.TEMPER / (now**mixture.TEMPER).sum()
            if targets and c in targets:
                want = now.index.to_series().map(targets[c]).fillna(0)
            share = (got.tokens * got.probability).groupby(got[c]).sum() / kept
            assert np.allclose(share, want, atol=1e-6)
        shares = mixture.mixture_shares(table, targets).toPandas()
        assert len(shares) == sum(got[c].nunique() for c in ("source", "lang", "topic"))
        assert np.allclose(shares.target, shares.expected, atol=1e-6)


def test_bound_lowers_the_share_only_where_needed():
    weights = np.array([40.0, 10.0, 40.0, 10.0])
    members = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    for target, kept in (([0.7, 0.3], 0.5), ([0.2, 0.8], 0.25)):
        factor = mixture.rake(weights, members, [np.array([0.5, 0.5]), np.array(target)])
        p = mixture.exact_probabilities(weights, members, factor, [np.array([0.5, 0.5]), np.array(target)])
        assert np.isclose((p * weights).sum() / 100, kept, rtol=1e-3) and p.max() <= 1
        assert np.allclose(np.bincount(members[1], p * weights) / (p * weights).sum(), target, atol=1e-6)


@pytest.mark.parametrize("cells", [0, 200_000])
def test_every_source_has_its_own_target(spark, monkeypatch, cells):
    """300 sources, two of them wanted; as a table of cells and on the driver."""
    monkeypatch.setattr(mixture, "CELLS", cells)
    monkeypatch.setattr(mixture, "SENT_CELLS", min(cells, 10))
    rows = [(k, "a b c d", f"s{k % 300}" if k % 7 else None, "en" if k % 2 else None) for k in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixture.mixture_table(docs, bytebpe.vocabulary_path(), {"source": {"s299": 0.5, "s0": 0.5}}, exact=True).toPandas()
    assert len(got) == 1_500 and set(got[got.probability > 0].source) == {"s299", "s0"}
    drawn = (got.tokens * got.probability).groupby(got.source).sum()
    assert np.isclose(drawn["s299"], drawn["s0"], rtol=1e-3) and drawn.sum() > 0
    lang = (got.tokens * got.probability).groupby(got.lang.fillna("none")).sum() / drawn.sum()
    now = got.groupby(got.lang.fillna("none")).tokens.sum()
    assert np.allclose(lang, now**mixture.TEMPER / (now**mixture.TEMPER).sum(), atol=2e-3)


@pytest.mark.parametrize("exact, targets", [
    (False, None), (False, {"source": {"a": 0.7, "c": 0.3}}), (True, None), (True, {"lang": {}}),
    (True, {"source": {"a": 1.0}, "topic": {1: 1.0}, "lang": {"en": 1.0}}),
])
def test_the_table_of_cells_is_raked_as_on_the_driver(spark, monkeypatch, exact, targets):
    """With and without the bound, scarce values, closed cells and targets that cannot be met."""
    for name, few in (("ROUNDS", 4), ("BOUND_ROUNDS", 3), ("SHARE_STEPS", 1), ("BOUND_TOLERANCE", 1e-2)):
        monkeypatch.setattr(mixture, name, few)
    cells = [("a", "en", 0, 900), ("a", "de", 1, 50), ("b", None, 0, 300), ("b", "en", 1, 30), ("c", "de", 0, 70), ("c", "en", 1, 10), ("d", "en", 0, 40)]
    rows = spark.createDataFrame(
        [(*c[:3], c[3], i) for i, c in enumerate(cells)], "source string, lang string, _topic int, _tokens long, _hash long",
    )
    got = []
    for most in (200_000, 0):
        monkeypatch.setattr(mixture, "CELLS", most)
        with warnings.catch_warnings(record=True) as told:
            warnings.simplefilter("always")
            out = mixture.mix_probabilities(rows, targets, exact=exact).orderBy("_hash").collect()
        told = [str(w.message) for w in told if "misses a target" in str(w.message)]
        got.append(([r._probability for r in out], [r._weight for r in out], told))
    here, there = got
    assert np.allclose(there[0], here[0], rtol=1e-9, atol=1e-12) and np.allclose(there[1], here[1], rtol=1e-9, atol=1e-12)
    assert there[2] == here[2]


def test_missed_targets_are_told():
    with pytest.warns(UserWarning, match="misses a target"):
        mixture.probabilities_here([("a", "x", 0, 10), ("b", "y", 0, 10)], {"source": {"a": 1.0}, "lang": {"y": 1.0}}, True)


def test_vectors_and_counts_are_those_of_whole_texts(monkeypatch):
    texts = ["", " ", "a  b", "One two\nTHREE one", "a \n b", "é漢 😀 x" * 3, "word " * 5_000]
    encoder = bytebpe.byte_encoder(bytebpe.vocabulary_path())
    for kept in (500_000, 3):
        monkeypatch.setattr(mixture, "KEPT_WORDS", kept)
        for _ in range(2):
            vectors, tokens = mixture.vectors_and_tokens(as_texts(pa.array(texts)), bytebpe.vocabulary_path())
            assert np.allclose(vectors, mixture.word_vectors(as_texts(pa.array(texts))))
            assert tokens.tolist() == [len(encoder.whole(t)) for t in texts]


def test_new_words_alone_are_encoded(monkeypatch):
    """A word met before costs nothing, with other marks behind it neither; texts are read without a copy."""
    vocabulary, seen = bytebpe.vocabulary_path(), []
    encoder = bytebpe.byte_encoder(vocabulary)
    table = mixture.WordTable(lambda words: seen.extend(words) or encoder.count_words(words))
    monkeypatch.setattr(mixture, "word_table", lambda _: table)
    for texts in (["a one, two", None, " one. two!"], ["x one; 's. é)  3.", "two.", ""], [], ["q one?! two"]):
        cut = as_texts(pa.array(["skipped", *texts], pa.string()).slice(1))
        vectors, tokens = mixture.vectors_and_tokens(cut, vocabulary)
        assert tokens.tolist() == [len(encoder.whole(t or "")) for t in texts]
        assert np.allclose(vectors, mixture.word_vectors(cut))
    assert seen.count(" one") == 1 and " one," not in seen and " one." not in seen


def test_words_are_cut_between_letters_marks_and_a_line_end(monkeypatch):
    """Parts alone are encoded, with the counts of whole texts; words with anything else are encoded whole."""
    vocabulary, seen = bytebpe.vocabulary_path(), []
    encoder = bytebpe.byte_encoder(vocabulary)
    table = mixture.WordTable(lambda words: seen.extend(words) or encoder.count_words(words))
    monkeypatch.setattr(mixture, "word_table", lambda _: table)
    odd = ["a one.\nTwo, b", "q Été!\nÉté one.", "x×y z÷. \n\nq\n", "\nq a\n .b. , don't 1.2 a\tb\n", "Σας. İx, ªb. ßÞ\x00 ", "e\u0301. <|endoftext|>.", "w" * 90 + ". É" * 60]
    rng = np.random.default_rng(3)
    signs = list("abÉé×ßΣİ漢1'") + [" ", " ", " a", "\n", ".", ",", ".\n", "\t", "\u00a0", "\x1c"]
    texts = odd + ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(2_000)]
    cut = as_texts(pa.array(texts))
    vectors, tokens = mixture.vectors_and_tokens(cut, vocabulary)
    assert tokens.tolist() == [len(encoder.whole(t)) for t in texts]
    assert np.array_equal(vectors, mixture.word_vectors(cut))
    assert seen.count(" one") == 1 and seen.count("Two") == 1 and not [w for w in seen if "one.\n" in w or "!\n" in w]
    measured = mixture.measured_texts(pa.array(texts), vocabulary)
    assert measured.field(0).to_pylist() == [v.tobytes() for v in mixture.stored_vectors(vectors)]
    assert len(mixture.measured_texts(pa.array([], pa.string()), vocabulary)) == 0


def test_mixture_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "a b", "s", "en"), (3, "", "s", None), (4, "c d", "t", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixture.mixture_table(docs, bytebpe.vocabulary_path()).collect()
    assert len(got) == 5 and all(r.probability is not None for r in got)
    assert mixture.mixture_table(docs.limit(0), bytebpe.vocabulary_path()).count() == 0
    # empty cells may leave no exact answer; the weights stay finite and usable
    even = mixture.mixture_table(docs, bytebpe.vocabulary_path(), {"lang": {}}).toPandas()
    assert np.isfinite(even.weight).all() and even.probability.between(0, 1).all()


def test_candidates_come_by_longest_prefix():
    rng = np.random.default_rng(4)
    strings = rng.integers(0, 2**forest.BITS, (forest.TREES, 300)).astype(np.uint32)
    places = np.argsort(strings, axis=1).astype(np.uint32)
    ordered = np.take_along_axis(strings, places.astype(np.int64), 1)
    query = strings[:, 17]
    shared = np.array([[forest.BITS - int(a ^ b).bit_length() for a, b in zip(row, [q] * 300, strict=True)] for row, q in zip(strings.tolist(), query.tolist(), strict=True)])
    for wanted in (1, 100, 400, 10**9):
        got = forest.candidates(query, ordered, places, wanted, 2)
        level = next((x for x in range(forest.BITS, -1, -1) if (shared >= x).sum() >= wanted and (shared >= x).any(0).sum() >= 2), 0)
        assert (got[(shared > level).any(0)]).all() and not got[~(shared >= level).any(0)].any()


def plain_candidates(query, strings, places, wanted, least):
    """Tree by tree and level by level, every match counted."""
    mask, total, before = np.zeros(places.shape[1], bool), 0, np.zeros(len(places), int)
    for level in range(forest.BITS, -1, -1):
        shared = strings >> (forest.BITS - level) == (query >> (forest.BITS - level))[:, None]
        matched = shared.sum(1)
        for t in np.flatnonzero(matched > before):
            if total >= wanted and level < forest.BITS:
                break
            mask[places[t, shared[t]]] = True
            total += matched[t] - before[t]
        if total >= wanted:
            if mask.sum() >= least:
                break
            total = 0
        before = matched
    return mask


@pytest.mark.parametrize("n", [1, 4, 6, 30, 250])
def test_best_of_a_shard_as_scored_one_by_one(n, monkeypatch):
    monkeypatch.setattr(forest, "AT_ONCE", 7)
    rng = np.random.default_rng(n)
    rows = rng.standard_normal((n, 8))
    rows[rng.random(n) < 0.4] = rows[0]
    rows[rng.random(n) < 0.2] *= -1
    some = forest.scaled(np.concatenate([rows[:20], rng.standard_normal((20, 8))]))
    rows, ids = forest.scaled(rows), rng.permutation(n) * 3
    own = np.append(ids[:20], 1_000 + np.arange(20))
    strings, hashed = (forest.hash_strings(v, forest.planes(8)) for v in (rows, some))
    places = np.argsort(strings, axis=1, kind="stable").astype(np.uint32)
    ordered = np.take_along_axis(strings, places.astype(np.int64), 1)
    lengths = np.sqrt((rows * rows).sum(1))
    expected = []
    for i, q in enumerate(some):
        for wanted, least in ((1, 2), (0.9 * n, 6), (0.9 * n, n), (10**9, 2)):
            mask = plain_candidates(hashed[:, i], ordered, places, wanted, least)
            assert (forest.candidates(hashed[:, i], ordered, places, wanted, least) == mask).all()
        found = np.flatnonzero(plain_candidates(hashed[:, i], ordered, places, forest.ENOUGH * n, 6) & (ids != own[i]))
        score = (rows[found] * q).sum(1) / (lengths[found] * np.sqrt((q * q).sum()))
        expected += [(own[i], ids[found[j]], score[j]) for j in np.lexsort((ids[found], -score))[:5]]
    got = forest.best_of_shard(own, some, hashed, ids, rows, ordered, places, 5)
    assert list(zip(*(c.tolist() for c in got), strict=True)) == expected


def test_pairs_of_shard_and_block_stay_in_their_tasks(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 40)
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 6)))], "vec_id long, embedding array<double>")
    results = []
    for block, tasks in ((10, 10_000), (10, 20), (1_000, 10_000)):
        monkeypatch.setattr(forest, "BLOCK_ROWS", block)
        monkeypatch.setattr(forest, "SEARCH_TASKS", tasks)
        got = forest.nearest(table, table.filter("vec_id % 4 = 0"))
        # the size of all pairs is not known when the plan is made, so none may be broadcast
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        results.append(sorted(map(tuple, got.collect())))
    assert len(results[0]) == 500 and results[0] == results[1] == results[2]


def brute(ids, vectors, query, k=5):
    i = ids.index(query)
    v = np.array(vectors, float)
    score = (v * v[i]).sum(1) / np.sqrt((v * v).sum(1)) / np.sqrt((v[i] * v[i]).sum())
    order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-score[j], ids[j]))[:k]
    return [ids[j] for j in order]


def test_forest_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 150)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 4)
    table = spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("score", F.lit("clash"))
    got = forest.nearest(table, table.filter("vec_id % 20 = 0")).collect()
    rows = table.collect()
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q, own in found.items():
        assert sorted(own) == [1, 2, 3, 4, 5]
        scores = [own[k] for k in range(1, 6)]
        assert scores == sorted(scores, key=lambda s: (-s[1], s[0]))
        hits += len({v for v, _ in scores} & set(brute(ids, vectors, q)))
    assert len(found) == 25 and hits / 125 >= 0.9


def test_forest_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (3, [1.0, 0.0]), (7, [1.0, 0.0]), (100, [0.0, 0.0]), (150, None), (200, [float("nan"), 1.0]),
            (250, [float("inf"), 1.0]), (300, [None, 1.0]), (None, [1.0, 1.0]), (350, [1.0]), (3, [1.0, 0.0]), (400, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = forest.nearest(table, table.filter("vec_id % 50 = 0")).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {0: [3, 7, 50], 50: [0, 3, 7]}
    assert forest.nearest(table.limit(0), table.limit(0)).count() == 0
    one = table.filter("vec_id = 50")
    assert forest.nearest(one, one).count() == 0


def test_forest_vectors_of_extreme_size(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e199]), (2, [1e-200, 1e-200]), (3, [5e-324, 0.0]), (4, [-1e300, 1e300])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = forest.nearest(table, table.filter("vec_id = 0")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3, 1, 2, 4]
    assert np.allclose([r.score for r in got], [1, 1 / np.sqrt(1.01), np.sqrt(0.5), -np.sqrt(0.5)])


@pytest.mark.parametrize("n", [0, 1, 3])
def test_topics_of_few_rows(n):
    vectors = mixture.word_vectors(as_texts(pa.array(["a b", "c d", ""][:n], pa.string())))
    assert len(mixture.fit_topics(vectors)) == max(1, n)


def test_topics_are_fitted_on_all_rows(spark, monkeypatch):
    monkeypatch.setattr(mixture, "START_KEYS", 50)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    stored = mixture.cut_lineage(mixture.with_vectors_and_tokens(docs, bytebpe.vocabulary_path()))
    got = mixture.train_topics(stored)
    vectors = mixture.word_vectors(as_texts(pa.array([r.text for r in docs.select("text").collect()], pa.string())))
    whole = mixture.stored_vectors(vectors)
    keys = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(50).orderBy("doc_id")
    ids = [r.doc_id for r in keys.collect()]
    by_id = {r.doc_id: r.text for r in docs.filter(F.col("doc_id").isin(ids)).collect()}
    pool = mixture.stored_vectors(mixture.word_vectors(as_texts(pa.array([by_id[i] for i in ids], pa.string()))))
    plain = mixture.find_centres(mixture.spread(pool, 8), lambda c: mixture.centre_sums(whole, c))
    assert np.allclose(got, plain, atol=1e-9)
    # centres of the pool alone are others
    assert not np.allclose(got, mixture.find_centres(mixture.spread(pool, 8), lambda c: mixture.centre_sums(pool, c)), atol=1e-3)


def test_rows_pass_the_toxicity_filter_as_they_are(spark, monkeypatch):
    """Rows keep their columns, whatever the names; the text alone goes to Python, and its slices change no verdict."""
    texts = [None, "", *(f"good morning number {i}. All is well" for i in range(30)), *(f"number {i} says: you vile scum!" for i in range(30))]
    docs = spark.createDataFrame([(i, t, 0.9, {"k": i}) for i, t in enumerate(texts)], "doc_id long, text string, _score double, row map<string, int>")
    labels = spark.createDataFrame([(i, int("vile" in (t or ""))) for i, t in enumerate(texts)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    want = [(i, t, {"k": i}) for i, t in enumerate(texts) if "vile" not in (t or "")]
    assert sorted((r.doc_id, r.text, r.row) for r in kept.collect()) == want
    monkeypatch.setattr(toxicity, "VERDICT_BYTES", 1)
    assert sorted((r.doc_id, r.text, r.row) for r in toxicity.drop_toxic(docs, labels).collect()) == want
