"""Quality rules, Hilbert shards and host reputation against plain Python."""

import collections
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stayscope.llm import hilbert, hosts, oracles, quality
from stayscope.llm.queries import QUERIES
from stayscope.session import cut_lineage

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " \t\n", "one", "a b c", "a b c a b c", "x\x0by\x0cz", "line\nline\n \nline", "### $$ a|b <c>", "É É É É É É",
    "same words again same words again same", "a b c d " * 3000, "nbsp words\u2028here",
]


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_base(spark):
    corpus = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts = ODD + corpus
    rows = [(i if i else None, t, 1, 2) for i, t in enumerate(texts)] + [(5, texts[5], 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _m int, _words int")
    got = quality.quality_table(docs).collect()
    assert len(got) == len(rows)
    texts = {k: t for k, t, *_ in rows}
    for r in got:
        n_words, *rest = counted(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, *rest), r.doc_id
        assert r.base_failed == (n_words < 50 or 100 * rest[-1] > 50 * n_words)
        assert r.kept == (r.broken_rules == "") and (not r.base_failed or not r.kept)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in got)
    assert quality.quality_table(docs.limit(0)).count() == 0


def test_stop_words_are_asked_for_in_listed_languages_only(spark):
    text = "Это чистый русский текст о погоде. " * 3 + " ".join(f"слово{i}" for i in range(60))
    rows = [(i, text, lang) for i, lang in enumerate(["ru", None, "en", "xx", "de"])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r.doc_id: r.broken_rules for r in quality.quality_table(docs).collect()}
    assert got == {0: "", 1: "", 2: "stop_words", 3: "", 4: "stop_words"}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {0, 1, 3}
    assert quality.keep_good(docs.drop("lang")).count() == 5


def test_quality_keeps_good_labels_and_drops_bad(spark):
    got = quality.quality_table(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    met = cut_lineage(got).join(labels, "doc_id")
    assert met.filter("quality = 0 and kept").count() == 0
    assert met.filter("quality = 1 and not base_failed and not kept").count() == 0


def plain_curve(levels, bits):
    """Hilbert index by the published loop, written over plain lists."""
    x, n = list(levels), len(levels)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out * 2 + (v >> b & 1)
    return out


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (3, 3), (2, 1)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 2**bits
    points = spark.range(side**dims).select(F.array(*[
        (F.floor(F.col("id") / side**d) % side).cast("int") for d in range(dims)
    ]).alias("x"))
    got = sorted((r.h, tuple(r.x)) for r in points.select("x", hilbert.hilbert_index(F.col("x"), dims, bits).alias("h")).collect())
    assert [h for h, _ in got] == list(range(side**dims))
    assert all(h == plain_curve(x, bits) for h, x in got)
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for (_, x), (_, y) in zip(got, got[1:], strict=False))


def test_shards_are_even_runs_of_the_curve(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("shard", F.lit("clash"))
    hot = spark.createDataFrame([(5, "twice", "en", "s")] * 700 + [(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    rows = docs.select("doc_id", "text", "lang", "source", "shard").unionAll(hot.withColumn("shard", F.lit("clash")))
    got = hilbert.shard_documents(rows).collect()
    n = 1703
    assert len(got) == n
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(by[s]) for s in range(40)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == n
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in order)
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in got:
        raw = (texts[r.doc_id] if r.doc_id != 5 else (texts[5] if r.source != "s" else "twice") or "") or ""
        if r.doc_id != 5:
            assert (r.size, r.text_crc32) == (len(raw.encode()) + 16, zlib.crc32(raw.encode()))
    sources = sum(len({r.source for r in own}) for own in by.values()) / 40
    assert sources < len({r.source for r in got}) * 2 / 3  # a reader of one source can skip files
    assert hilbert.shard_documents(rows.limit(0)).count() == 0
    assert {r.shard for r in hilbert.shard_documents(rows.filter("doc_id = 7")).collect()} == {0}


def test_host_path_and_rules(spark):
    cases = [
        (None, "", "", None), ("no scheme", "", "", None), ("http://", "", "", None),
        ("HTTP://WWW.Example.COM/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/"),
        ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/"),
        ("http://a.example.com/de/", "a.example.com", "/de/", "com/"), ("http://notexample.com", "notexample.com", "", None),
        ("http://x.net/fr/1", "x.net", "/fr/1", "net/fr/"), ("http://x.net/en/", "x.net", "/en/", None),
        ("a://b://c.net/es/", "b:", "//c.net/es/", None), ("http://Ünï.net/es/", "Ünï.net", "/es/", "net/es/"),
    ]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)] + [(1, "http://x.net/fr/1", "x")], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = sorted(hosts.judge_urls(pages, none).collect(), key=lambda r: (r.page_id, r.host))
    assert len(got) == len(cases) + 1
    says = {rule: verdict for verdict, rule in hosts.RULES}
    for r in got:
        if (r.page_id, r.host) != (1, "x.net"):
            _, host, path, rule = cases[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == says.get(r.rule, "allow")
    assert hosts.judge_urls(pages.limit(0), none).count() == 0


def test_reputation_shrinks_to_domain_and_suffix(spark):
    rows, bad = [], []
    for host, n, k in [("a.bad.org", 60, 58), ("b.bad.org", 2, 2), ("c.bad.org", 0, 0), ("a.good.org", 80, 1), ("b.good.org", 2, 2),
                       ("x.co.uk", 30, 1), ("y.shop.co.uk", 1, 1), ("10.0.0.1", 1, 0)]:
        for i in range(max(n, 1)):
            rows.append((len(rows), f"http://{host}/{i}"))
            if i < n:
                bad.append((len(rows) - 1, i < k))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([*bad, (None, True), (10**6, True), bad[0]], "page_id long, bad boolean")
    got = {r.host: r for r in hosts.host_reputation(pages, outcomes).collect()}
    assert got["b.bad.org"].mean > got["b.good.org"].mean  # the same outcomes, other siblings
    assert got["c.bad.org"].mean > 0.4 and got["c.bad.org"].n == 0
    assert got["a.bad.org"].low > 0.5 > got["a.good.org"].mean
    assert all(0 < r.mean < 1 and r.low < r.mean for r in got.values())
    verdicts = {r.host: r.verdict for r in hosts.judge_urls(pages, outcomes).collect()}
    assert verdicts["a.bad.org"] == "block" and verdicts["a.good.org"] == "allow"


@pytest.mark.parametrize("name", ["op9_quality_rules", "op10_host_reputation"])
def test_sql_twins(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet') x")
    ours = QUERIES[name](spark, SF).toPandas()
    theirs = con.sql(oracles.ORACLES[name]).df()[ours.columns]
    rows = [sorted(map(repr, f.astype(object).where(f.notna(), None).itertuples(index=False, name=None))) for f in (ours, theirs)]
    assert rows[0] == rows[1]


def test_native_plans_hold_no_python(spark, capsys):
    for name in ("op5_hilbert_shards", "op9_quality_rules", "op10_host_reputation"):
        QUERIES[name](spark, SF).explain()
        plan = capsys.readouterr().out
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan), name
