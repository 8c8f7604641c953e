"""Fill-in-middle against plain string work, on ordinary and odd rows."""

import hashlib
import random
import re

import pytest

from stayscope.llm import infill


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(key, text, rate=100, first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"7:{'' if key is None else key}")
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, len(units), "plain", None, None, text
    if h[3] % 100 < first:
        return key, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def digested(row, text):
    return (*row[:5], sha(row[5]), sha(text or ""))


ODD = [
    "", None, "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "\r\nx\u2028y\x0bz\x85w\n", "has <P> in it\nx", "<S>", "x\n<M>\ny", "<P", "S>\n<",
    "ends with <\nthen P>\n<S\nM>", "é 漢字 😀\nü\n", "word " * 30_000 + "\n" + "tail " * 20_000, "z" * 100_000, "same", "same",
]


def test_odd_texts_and_repeated_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no key\nat all"), (None, None), (5, "a\nb"), (5, "a\nb"), (-3, "below\nzero")]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, form string, n int")
    got = sorted((tuple(r) for r in infill.infill_table(docs.repartition(3)).collect()), key=repr)
    assert got == sorted((digested(plain_row(*r), r[1]) for r in rows), key=repr)
    texts = sorted((tuple(r) for r in infill.infill_texts(docs).collect()), key=repr)
    assert texts == sorted(((r[0], r[2], r[5]) for r in (plain_row(*r) for r in rows)), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: tuple(r) for r in infill.infill_table(docs).collect()}
    assert got == {r.doc_id: digested(plain_row(r.doc_id, r.text), r.text) for r in docs.collect()}


def test_rates_and_keys_that_are_texts(spark):
    docs = spark.createDataFrame([(f"k{i}", f"l{i}\nm\nn{i}") for i in range(60)], "doc_id string, text string")
    got = {tuple(r) for r in infill.infill_table(docs, rate=40, suffix_first=80).collect()}
    assert got == {digested(plain_row(r.doc_id, r.text, 40, 80), r.text) for r in docs.collect()}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert infill.infill_table(docs).collect() == []
    assert infill.infill_table(docs).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_one_row_repeated_on_a_third_of_the_table_spreads_over_its_readers(spark):
    docs = spark.range(0, 600, 1, 6).selectExpr("if(id % 3 = 0, 7L, id + 1000) AS doc_id", "'hot\\ntext' AS text")
    pieces = infill.output_pieces(docs)
    assert pieces.filter("doc_id = 7").select("part", "key").distinct().count() == 6
    assert infill.infill_table(docs).filter("doc_id = 7").count() == 200


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_marks_are_found_however_the_output_is_cut(form):
    parts = {"prefix": b"a<P<", "suffix": b"<S", "middle": b"M>\n<"}
    whole = b"".join(infill.MARKS[n] + parts[n] for n in infill.FORMS[form])
    random.seed(3)
    for _ in range(200):
        cuts = sorted(random.sample(range(len(whole) + 1), 4))
        reader, got = infill.MarkReader(form), {}
        for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True):
            for name, chunk in reader.feed(whole[a:b]):
                got[name] = got.get(name, b"") + chunk
        for name, chunk in reader.end():
            got[name] = got.get(name, b"") + chunk
        assert got == parts


def test_pieces_are_whole_lines_up_to_the_bound():
    part = b"\n".join(b"x" * n for n in (3, 4, 50, 2, 0, 9)) + b"\n"
    pieces = list(infill.cut(part, 12))
    assert b"".join(pieces) == part and max(map(len, pieces)) <= 12
    assert pieces[0] == b"xxx\nxxxx\n" and list(infill.cut(b"", 12)) == [b""]


def test_restoration_needs_no_second_exchange(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = infill.infill_table(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
