"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in the weights of its words; a document's is
the noisy-or of its sentences, 1 - prod(1 - p). Both are fitted at once from
document labels, so the sentence scores then tell which sentences offend.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayscope.llm.wordwise import as_texts, ragged, run_sums, slices

#: Documents of each label that the model is fitted on: those with the least hash of the key.
SAMPLE_PER_LABEL = 2_000

#: Bytes of text of all of them together, per label.
BYTES_PER_LABEL = 64_000_000

#: Hashed features, and the prefixes of a word that are features beside the word.
FEATURES = 1 << 18
PREFIXES = (4, 5, 6)

STEPS, RATE, SPARSITY, START = 150, 0.15, 3e-4, -9.0

#: Distinct words whose weight a Python worker keeps.
KEPT_WORDS = 1_000_000

#: Bytes of text that are scored at once where the verdict alone is asked for, or cut into features.
VERDICT_BYTES = 1_500_000

#: Tokens after which a sentence without an end is cut.
LONGEST = 60

SENTENCE_ENDS = (".", "!", "?")
EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_/\\`~^=+…«»„“”¡¿\t\r"


def features_of(token: str) -> list[int]:
    """Hashed features of a blank-separated token: its lower-case word and prefixes."""
    word = token.lower().strip(EDGES)
    if not word:
        return []
    parts = {f"={word}", *(word[:k] for k in PREFIXES if len(word) >= k)}
    return [zlib.crc32(p.encode()) % FEATURES for p in parts]


@dataclass
class Sentences:
    """Tokens of a batch: codes into ``tokens``, and where sentences and texts lie."""

    tokens: list[str]
    codes: np.ndarray
    sentence_tokens: np.ndarray  # tokens of every sentence
    text_sentences: np.ndarray  # sentences of every text
    begin: np.ndarray  # first character of every sentence in its text
    end: np.ndarray


def sentences_of(texts: pa.Array) -> Sentences:
    """Cut whole texts at line ends, after tokens that end in . ! or ?, and else
    after ``LONGEST`` tokens.

    Every text has one sentence at least, if only an empty one.
    """
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
    per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    tokens = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    closes = np.array([t == "\n" or t.endswith(SENTENCE_ENDS) for t in tokens], bool)
    # a line end stands without the blanks that were put around it
    widths = np.array([0 if t == "\n" else len(t) + 1 for t in tokens], np.int64)
    if not len(codes):
        none = np.zeros(0, np.int64)
        return Sentences(tokens, codes, none, none, none, none)
    ends = closes[codes]
    ends[np.cumsum(per_text) - 1] = True
    last = np.flatnonzero(ends)
    opens = np.concatenate(([0], last[:-1] + 1))
    place = np.arange(len(codes)) - np.repeat(opens, last - opens + 1)
    last = np.flatnonzero(ends | (place % LONGEST == LONGEST - 1))
    first = np.concatenate(([0], last[:-1] + 1))
    text_of = np.repeat(np.arange(len(per_text)), per_text)
    width = widths[codes]
    before = np.cumsum(width) - width
    text_start = before[np.cumsum(per_text) - per_text]
    owner = text_of[first]
    begin = before[first] - text_start[owner]
    end = begin + run_sums(width, last - first + 1)
    return Sentences(tokens, codes, last - first + 1, np.bincount(owner, minlength=len(per_text)), begin, end)


@dataclass
class Model:
    """Weights of the features that are not zero, and the bias."""

    weights: dict[int, float]
    bias: float


def fit(features: np.ndarray, per_sentence: np.ndarray, per_text: np.ndarray, labels: np.ndarray) -> Model:
    """Noisy-or likelihood by Adam over all texts at once, small weights cut to zero.

    ``features`` lists the features of all sentences one after the other. With one
    label only, or none, the model scores every text 0 (or 1 if all are 1).
    """
    if not len(labels) or labels.min() == labels.max():
        return Model({}, 30.0 if len(labels) and labels.min() == 1 else -np.inf)
    used, index = np.unique(features, return_inverse=True)
    sentence_of = np.repeat(np.arange(len(per_sentence)), per_sentence)
    text_of = np.repeat(np.arange(len(per_text)), per_text)
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    w, b = np.zeros(len(used)), START
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = b + np.bincount(sentence_of, w[index], len(per_sentence))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(text_of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(per_text)))
        pull = np.where(labels == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * share
        slope = p * pull[text_of]
        g, gb = np.bincount(index, slope[sentence_of], len(used)), slope.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        scale = np.sqrt(v / c2) + 1e-6
        w -= RATE * (m / c1) / scale
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * SPARSITY / scale, 0)
        b -= RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
    kept = np.flatnonzero(w)
    return Model(dict(zip(used[kept].tolist(), w[kept].tolist(), strict=True)), float(b))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(
    docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL, bytes_per_label: int = BYTES_PER_LABEL,
) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    Per label, the ``sample_per_label`` keys with the least hash are taken, as long as their
    whole texts together stay below ``bytes_per_label``; their features are made by Spark and fitted
    on the driver. Several labels of a key count as toxic if one is, and of several texts of a key
    the least counts; null labels and keys teach nothing.
    """
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("label")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter(F.col("label") == 1).orderBy(*order).limit(sample_per_label).unionAll(
        known.filter(F.col("label") == 0).orderBy(*order).limit(sample_per_label)
    )

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0, VERDICT_BYTES)):
            s = sentences_of(as_texts(batch.column(0)))
            own = [features_of(t) for t in s.tokens]
            n = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.fromiter((f for o in own for f in o), np.int32, int(n.sum()))
            per_sentence = run_sums(n[s.codes], s.sentence_tokens)
            features = flat[ragged((np.cumsum(n) - n)[s.codes], n[s.codes])]
            upto = np.cumsum(run_sums(per_sentence, s.text_sentences))
            ends = np.cumsum(s.text_sentences)
            rows = []
            for i in range(batch.num_rows):
                a, e = (ends[i - 1] if i else 0), ends[i]
                f, g = (upto[i - 1] if i else 0), upto[i]
                rows.append((per_sentence[a:e].astype("<i4").tobytes(), features[f:g].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                names=["label", "sentences", "features"],
            )

    # at most twice the sample size of keys, so this side is small by the parameter
    single = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    inside = Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    bounded = single.withColumn("upto", F.sum(size).over(inside)).filter(F.col("upto") <= bytes_per_label)
    rows = bounded.select("text", F.col("label").cast("int").alias("label")).mapInArrow(extract, "label int, sentences binary, features binary").collect()
    return fit(
        np.concatenate([np.frombuffer(r.features, np.int32) for r in rows] or [np.zeros(0, np.int32)]),
        np.concatenate([np.frombuffer(r.sentences, "<i4") for r in rows] or [np.zeros(0, np.int32)]),
        np.array([len(r.sentences) // 4 for r in rows], np.int64), np.array([r.label for r in rows], np.int64),
    )


class Scorer:
    """Weights of tokens, kept between the batches of a task."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def weights(self, tokens: list[str]) -> np.ndarray:
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known, weight = self.known, self.model.weights
        for t in tokens:
            if t not in known:
                known[t] = sum(weight.get(f, 0.0) for f in features_of(t))
        return np.fromiter((known[t] for t in tokens), np.float64, len(tokens))

    def score(self, texts: pa.Array) -> tuple[np.ndarray, Sentences, np.ndarray]:
        """Document scores, the sentences, and the sentence scores."""
        s = sentences_of(texts)
        z = self.model.bias + run_sums(self.weights(s.tokens)[s.codes], s.sentence_tokens)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.isneginf(self.model.bias):
            p = np.zeros(len(z))
        none = run_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), s.text_sentences)
        return np.clip(-np.expm1(none), 0, 1), s, p


SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``_score`` and ``_offending`` to every row, its columns passed on.

    ``_offending`` lists the sentences with a score of 0.5 or more as character
    spans. A null text is empty: one sentence without words.
    """
    names = [*docs.columns, "_score", "_offending"]
    at = names.index(text)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in (part for whole in batches for part in slices(whole, at)):
            total, s, p = scorer.score(as_texts(batch.column(at)))
            bad = np.flatnonzero(p >= 0.5)
            owner = np.repeat(np.arange(len(total)), s.text_sentences)[bad]
            spans = pa.StructArray.from_arrays(
                [pa.array(s.begin[bad], pa.int32()), pa.array(s.end[bad], pa.int32()), pa.array(p[bad])], fields=list(SPANS.value_type),
            )
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(total))))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total), pa.ListArray.from_arrays(offsets, spans)], names=names,
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(score, f"{fields}, _score double, _offending array<struct<begin:int,end:int,score:double>>")


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on ``labels`` and score every row: ``doc_id``, ``held_out``, ``score``,
    ``predicted`` and ``offending``. A null key is held out. Other columns are not read."""
    model = train(docs, labels)
    scored = score_texts(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"), F.col("_offending").alias("offending"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that score below 0.5, with the columns they came with, whatever their names."""
    model = train(docs, labels)

    # the text alone passes through Python, and nothing but its score comes back
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            parts = slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0, VERDICT_BYTES)
            totals = [scorer.score(as_texts(part.column(0)))[0] for part in parts]
            yield pa.array(np.concatenate(totals) if totals else np.zeros(0), pa.float64())

    return docs.filter(score(F.col("text")) < 0.5)
