"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word is the mean of the embeddings of its hashed features (the word itself
and its first 4, 5 and 6 characters, which inflected forms share). Filters
of widths 1, 2 and 3 run over the whole text, each keeps its greatest
response, and a logistic layer turns these into a score. The network is
trained in numpy on the driver, on a bounded sample (:data:`SAMPLE_TOXIC` and
:data:`SAMPLE_CLEAN` labelled rows of at most :data:`SAMPLE_BYTES` bytes, lowest
hash first): one embedding component starts as the features' association with
the label, as random embeddings under max pooling hardly ever see the few
telling words of a long text. All usable labelled rows that are not trained on
(a fifth by hash, set aside, and whatever the bounds leave out) are then
scored in Spark, whole, and counted by language, label and score on a fixed
grid; these counts set the scale, so that 0.7 is where the score separates best
over all languages, and one threshold for each language with labelled rows,
drawn towards the common one by :data:`LEAST_TOXIC` toxic rows' weight. Where a
fifth would hold too few rows of a label, none is set aside, and each sampled row
counts with the score that a model fitted without it gives.

A score is a function of the text alone; the language only picks the
threshold of the verdict. One map over the rows writes each one's logit (:func:`classify`); what sets
scale and thresholds is counted from that by joining ids, languages and logits with the labels, and
the score is an expression of the logit. So no text is shuffled or read by the network twice. As a filter is
linear in its words, each word's responses are computed once and looked up,
in a table of bounded size, so a text costs a few additions per word.

Results for odd input: null and empty texts have the score of a text whose words are
all unknown; texts of any length are read whole; a language is its code's first part (``en`` of ``en-GB``), two or
three letters, which bounds their number; what has no such form, a null language, or one without
labelled rows, has the threshold 0.7; labels that are null, or whose row has no document, are not
used; without toxic or without clean labels every score is 0; repeated rows
score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import carried, release_tables, returning_memory

BUCKETS = 1 << 15
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5, 6)
EPOCHS = 5
BATCH = 64
THRESHOLD = 0.7
#: Bounds of the training sample.
SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 3000
SAMPLE_BYTES = 32_768
#: Toxic rows (with clean ones in proportion) that all languages together count for in
#: the threshold of each; with fewer than FOLDS times as many rows of a label, none is set aside.
LEAST_TOXIC = 15
FOLDS = 5
#: The grid of logits: steps for each unit, and the greatest logit it tells apart.
GRID = 50
GRID_END = 30
#: Words whose responses a worker keeps, and texts scored at a time.
TABLE_SIZE = 150_000
STEP = 100
#: Bytes of text cut into words at a time, or one text, if it is longer.
STEP_BYTES = 1 << 20
#: Rows handed back at a time, as they may carry their texts.
ROWS_BACK = 1000

_MARKS = string.punctuation + "«»“”‘’„…¿¡–—"


def features(word: bytes) -> list[int]:
    """Hash buckets of a word's features: itself and its prefixes (a shorter word is its own prefix)."""
    w = word.decode("utf-8", "replace").lower().strip(_MARKS)
    return [crc32(b"=" + w.encode()) % BUCKETS, *[crc32(w[:n].encode()) % BUCKETS for n in PREFIXES]]


@dataclass
class Model:
    """Embeddings, filters (per width: offset x DIM x FILTERS), biases, output layer."""

    emb: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    scale: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def vectors(self, words: list[bytes]) -> np.ndarray:
        return self.emb[np.array([features(w) for w in words])].mean(axis=1)

    def score(self, logit: np.ndarray) -> np.ndarray:
        z = np.clip(self.scale * logit + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z))


def pooled(responses: np.ndarray) -> np.ndarray:
    """Greatest response of every filter over a text, from the responses of
    its words (n x all offsets of all widths); windows may overhang the end."""
    out, col = [], 0
    n = max(1, len(responses))
    full = np.zeros((n + max(WIDTHS) - 1, responses.shape[1]), responses.dtype)
    full[: len(responses)] = responses
    for width in WIDTHS:
        total = full[:n, col: col + FILTERS]
        for j in range(1, width):
            total = total + full[j: j + n, col + j * FILTERS: col + (j + 1) * FILTERS]
        out.append(total.max(axis=0))
        col += width * FILTERS
    return np.concatenate(out)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.flat = np.concatenate([w for f in model.filters for w in f], axis=1).astype(np.float32)
        self.rows: dict[bytes, int] = {}
        self.table = np.zeros((1024, self.flat.shape[1]), np.float32)

    def learn(self, words: set[bytes]) -> None:
        """Makes sure that the words are in the table."""
        if len(self.rows) > TABLE_SIZE:
            self.rows, self.table = {}, np.zeros((1024, self.flat.shape[1]), np.float32)
        new = [w for w in words if w not in self.rows]
        if new:
            at = len(self.rows)
            while at + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[at: at + len(new)] = self.model.vectors(new) @ self.flat
            self.rows.update(zip(new, range(at, at + len(new))))

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        split = [(t or b"").split() for t in texts]
        self.learn(set().union(*split))
        get, table = self.rows.__getitem__, self.table
        h = np.stack([pooled(table[np.fromiter(map(get, w), np.int64, len(w))]) for w in split])
        h = np.maximum(h + self.model.bias, 0)
        return (h @ self.model.out[:-1] + self.model.out[-1]).astype(float)


# ---------------------------------------------------------------------------
# Training
# ---------------------------------------------------------------------------


def _association(buckets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of each feature bucket: log odds of occurring in toxic against clean
    texts, over its standard error, limited to -2 .. 2. ``buckets``: those of each text."""
    seen = np.zeros((2, BUCKETS))
    for b, y in zip(buckets, labels):
        seen[int(y), np.unique(b)] += 1
    n = [max(1, (labels == y).sum()) for y in (0, 1)]
    a, b = seen[1] + 0.5, seen[0] + 0.5
    odds = np.log(a / (n[1] + 1)) - np.log(b / (n[0] + 1))
    z = odds / np.sqrt(1 / a + 1 / b)
    return np.where(seen.sum(axis=0) > 0, np.clip(z / 3, -2, 2), 0)


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    rng = np.random.default_rng(seed)
    vocab: dict[bytes, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in t.split()], np.int64) for t in texts]
    grid = np.array([features(w) for w in vocab], np.int64).reshape(len(vocab), 1 + len(PREFIXES))
    emb = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    emb[:, 0] = _association([grid[np.unique(d)] for d in docs], labels)
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w, f in zip(WIDTHS, filters):
        for k in range(FILTERS):
            f[k % w, 0, k] = 1.0
    model = Model(emb, filters, np.full(FILTERS * len(WIDTHS), -0.3, np.float32),
                  np.append(np.full(FILTERS * len(WIDTHS), 0.3), -1.5).astype(np.float32))
    dense = [*filters, model.bias, model.out]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    squares = np.full((BUCKETS, DIM), 1e-3, np.float32)
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            picked = order[at: at + BATCH]
            grads = [np.zeros_like(p) for p in dense]
            emb_rows, emb_grads = [], []
            for i in picked:
                _backward(model, docs[i], grid, labels[i], grads, emb_rows, emb_grads)
            steps += 1
            for p, g, (m, v) in zip(dense, grads, moment):
                g /= len(picked)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.005 * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.99 ** steps)) + 1e-8)
            if emb_rows:
                rows, inverse = np.unique(np.concatenate(emb_rows), return_inverse=True)
                g = np.zeros((len(rows), DIM), np.float32)
                np.add.at(g, inverse, np.concatenate(emb_grads) / len(picked))
                squares[rows] += g * g
                emb[rows] -= 0.05 * g / np.sqrt(squares[rows])
    return model


def _backward(model, doc, grid, label, grads, emb_rows, emb_grads) -> None:
    """Adds one text's gradients; only the windows that won a maximum have any."""
    n = max(1, len(doc))
    x = np.zeros((n + max(WIDTHS) - 1, DIM), np.float32)
    if len(doc):
        words, inverse = np.unique(doc, return_inverse=True)
        x[: len(doc)] = model.emb[grid[words]].mean(axis=1)[inverse]
    won, best = [], []
    for width, f in zip(WIDTHS, model.filters):
        r = sum(x[j: j + n] @ f[j] for j in range(width))
        top = r.argmax(axis=0)
        won.append(top)
        best.append(r[top, np.arange(FILTERS)])
    raw = np.concatenate(best) + model.bias
    h = np.maximum(raw, 0)
    logit = h @ model.out[:-1] + model.out[-1]
    err = 1 / (1 + math.exp(-max(-30, min(30, float(logit))))) - label
    grads[-1][:-1] += err * h
    grads[-1][-1] += err
    d_raw = err * model.out[:-1] * (raw > 0)
    grads[-2] += d_raw
    for k, (width, f) in enumerate(zip(WIDTHS, model.filters)):
        d = d_raw[k * FILTERS: (k + 1) * FILTERS]
        for j in range(width):
            pos = won[k] + j
            grads[k][j] += (x[pos] * d[:, None]).T
            inside = (pos < len(doc)) & (d != 0)
            if inside.any():
                words = doc[pos[inside]]
                back = d[inside, None] * f[j][:, inside].T
                emb_rows.append(grid[words].ravel())
                emb_grads.append(np.repeat(back / grid.shape[1], grid.shape[1], axis=0))


def best_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Middle of the gap at which calling everything above toxic has the best weighted F1."""
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], labels[order], weights[order]
    hit, called = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hit / (called + (w * y).sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # no cut between equal scores
    i = int(f1.argmax())
    return float((s[i] + (s[i + 1] if i + 1 < len(s) else s[i] - 1)) / 2)


def cell(logits: np.ndarray) -> np.ndarray:
    """Number of each logit's cell on the grid."""
    return np.rint(np.clip(logits, -GRID_END, GRID_END) * GRID).astype(np.int64)


def out_of_fold(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """Logits of all texts, each from a model that did not learn from it."""
    fold, z = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for y in (0, 1):
        own = np.flatnonzero(labels == y)
        fold[own] = np.arange(len(own)) % FOLDS
    for k in range(FOLDS):
        held, fitted = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(held) and len(fitted):
            z[held] = Scorer(train([texts[i] for i in fitted], labels[fitted])).logits([texts[i] for i in held])
    return z


def calibrate(model: Model, cells: list[tuple[str | None, int, int, float]], toxic_rows: float) -> None:
    """Sets shift and thresholds from weights by (language, label, cell of the
    grid). ``toxic_rows``: number of rows that the toxic weight stands for."""
    z = np.array([c[2] for c in cells]) / GRID
    y, w = np.array([c[1] for c in cells]), np.array([c[3] for c in cells], float)
    model.shift = math.log(THRESHOLD / (1 - THRESHOLD)) - model.scale * best_cut(z, y, w)
    of = np.array([c[0] or "" for c in cells])
    shared = w * (LEAST_TOXIC / toxic_rows)
    for lang in sorted(set(of) - {""}):
        own = of == lang
        cut = best_cut(np.concatenate([z, z[own]]), np.concatenate([y, y[own]]), np.concatenate([shared, w[own]]))
        model.thresholds[str(lang)] = min(0.95, max(0.3, float(model.score(np.array(cut)))))


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return crc % 3 == 1


def language(lang: Column) -> Column:
    """The language's code (two or three letters, lower-case), null if it has none."""
    code = F.regexp_extract(lang.cast("string"), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(code != "", F.lower(code))


def usable_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``toxic`` of the labels that may be learned from, one an id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


@dataclass
class Trained:
    """A model without scale, and what it was trained on: ids, languages, texts and labels of the sample."""

    model: Model
    ids: list
    langs: list[str | None]
    texts: list[bytes]
    labels: np.ndarray
    few: bool


def train_on_sample(docs: DataFrame, known: DataFrame, text: str = "text", lang: str = "lang") -> Trained | None:
    """The driver gets at most SAMPLE_TOXIC + SAMPLE_CLEAN texts of at most SAMPLE_BYTES bytes."""
    counts = dict(known.groupBy("toxic").count().collect())
    if not counts.get(0) or not counts.get(1):
        return None
    few = min(counts.values()) < FOLDS * LEAST_TOXIC
    learned = known if few else known.where(F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) != FOLDS - 1)
    lowest = lambda y, n: learned.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    wanted = lowest(1, SAMPLE_TOXIC).unionByName(lowest(0, SAMPLE_CLEAN))
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows: a proven size bound
    body = F.col(f"`{text}`").cast("string").cast("binary")
    sample = docs.select("doc_id", language(F.col(f"`{lang}`")).alias("lang"), body.alias("t"))
    sample = sample.where(F.coalesce(F.octet_length("t"), F.lit(0)) <= SAMPLE_BYTES)
    rows = sample.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    y = np.array([r["toxic"] for r in rows], np.int64)
    if not len(y) or y.min() == y.max():
        return None
    texts = [bytes(r["t"] or b"") for r in rows]
    return Trained(train(texts, y), [r["doc_id"] for r in rows], [r["lang"] for r in rows], texts, y, few)


def steps(sizes: list[int | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts to be scored together: at most STEP of them, of STEP_BYTES bytes in all, but one at least."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and (i - at == STEP or total + (size or 0) > STEP_BYTES):
            yield at, i
            at, total = i, 0
        total += size or 0
    if sizes:
        yield at, len(sizes)


def logits(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default all) with ``_id``, ``_lang``, ``_longer`` (than SAMPLE_BYTES) and ``_logit``."""
    keep = carried(docs, MADE, columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters
    body = F.col(f"`{text}`").cast("string")
    made = [(F.col("doc_id") if "doc_id" in docs.columns else F.lit(None).cast("long")).alias("_id"),
            language(F.col(f"`{lang}`")).alias("_lang"), (F.coalesce(F.octet_length(body), F.lit(0)) > SAMPLE_BYTES).alias("_longer")]
    # the text goes to Python once: as the column passed on, or else as one that stays there
    passed = text in keep and isinstance(docs.schema[text].dataType, T.StringType)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], *made, *([] if passed else [body.alias("_text")]))
    fields = [f for f in source.schema.fields if f.name != "_text"]
    at_text = keep.index(text) if passed else len(fields)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "_logit double"])

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        scorer = Scorer(shared.value)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_BACK):
                batch = whole.slice(first, ROWS_BACK)
                texts = batch.column(at_text).cast(pa.binary())
                z = [scorer.logits(texts[at:end].to_pylist()) for at, end in steps(pc.binary_length(texts).to_pylist())]
                found = pa.array(np.concatenate(z), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], found], names=[*[f.name for f in fields], "_logit"])

    return source.mapInArrow(run, schema)


def label_counts(scored: DataFrame, known: DataFrame) -> DataFrame:
    """Rows ``n`` of ``scored`` (of :func:`logits`) with a label in ``known`` by ``lang``, ``toxic``, whether
    ``longer`` than SAMPLE_BYTES, and ``cell`` of their logit. Ids and numbers are shuffled, no texts."""
    at = F.rint(F.least(F.greatest("_logit", F.lit(-float(GRID_END))), F.lit(float(GRID_END))) * GRID).cast("int")
    rows = scored.select(F.col("_id").alias("doc_id"), F.col("_lang").alias("lang"), F.col("_longer").alias("longer"), at.alias("cell"))
    labelled = rows.join(known, "doc_id").select("lang", F.col("toxic").cast("int").alias("toxic"), "longer", "cell")
    return labelled.groupBy("lang", "toxic", "longer", "cell").agg(F.count(F.lit(1)).alias("n"))


def calibrate_on(trained: Trained, scored: DataFrame, known: DataFrame) -> None:
    """Sets scale and thresholds of the trained model. The driver gets counts by language code, label, whether longer, and cell of the grid."""
    model, y = trained.model, trained.labels
    spark = scored.sparkSession
    ids = spark.createDataFrame([(i,) for i in trained.ids], known.select("doc_id").schema)
    counted = label_counts(scored, known.join(F.broadcast(ids), "doc_id", "left_anti")).collect()
    rest = {}  # by label, rows not trained on that are not longer than the sample's
    for r in counted:
        if not r["longer"]:
            rest[r["toxic"]] = rest.get(r["toxic"], 0) + r["n"]
    cells = [(r["lang"], r["toxic"], r["cell"], r["n"], r["longer"]) for r in counted]
    if trained.few or {c[1] for c in cells} != {0, 1}:
        z = cell(out_of_fold(trained.texts, y))
        cells += [(lang, int(k), int(c), 1, False) for lang, k, c in zip(trained.langs, y, z)]
        weight = {0: 1.0, 1: 1.0}
    else:  # rows set aside or beyond the sample stand for those trained on, too
        weight = {k: 1 + float((y == k).sum()) / n for k, n in rest.items()}
    calibrate(model, [(a, k, c, n if longer else n * weight[k]) for a, k, c, n, longer in cells], sum(c[3] for c in cells if c[1] == 1))


def verdicts(scored: DataFrame, model: Model | None) -> DataFrame:
    """From the result of :func:`logits`: its columns with ``score``, ``threshold`` and ``rejected``."""
    kept = [F.col(f"`{c}`") for c in carried(scored, MADE)]
    if model is None:
        return scored.select(*kept, F.lit(0.0).alias("score"), F.lit(THRESHOLD).alias("threshold"), F.lit(False).alias("rejected"))
    z = F.least(F.greatest(F.lit(model.scale) * F.col("_logit") + F.lit(model.shift), F.lit(-30.0)), F.lit(30.0))
    threshold = F.lit(THRESHOLD)
    if model.thresholds:  # one entry for each language code with labels
        cuts = F.create_map(*[F.lit(x) for pair in model.thresholds.items() for x in pair])
        threshold = F.coalesce(F.try_element_at(cuts, F.col("_lang")), threshold)
    out = scored.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("threshold", threshold)
    return out.select(*kept, "score", "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"))


MADE = ("score", "threshold", "rejected")


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default all; it needs ``doc_id``) with ``score``, ``threshold`` (of the row's language) and ``rejected``,
    by a model of the labelled rows that are not held out. Input columns of these names are replaced.
    Actions: takes the sample, writes the rows with their logits, counts the labelled ones."""
    known = usable_labels(labels)
    trained = train_on_sample(docs, known, text, lang)
    if trained is None:
        return verdicts(docs.select(*[F.col(f"`{c}`") for c in carried(docs, MADE, columns)]), None)
    scored = materialize(logits(docs, trained.model, text, lang, columns), "toxicity-logits")
    calibrate_on(trained, scored, known)
    return verdicts(scored, trained.model)


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model alone, to score other rows with; the actions are those of :func:`classify`, and no text is written."""
    known = usable_labels(labels)
    trained = train_on_sample(docs, known)
    if trained is None:
        return None
    calibrate_on(trained, materialize(logits(docs, trained.model, columns=[]), "toxicity-logits"), known)
    return trained.model


def score_texts(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``score``, ``threshold`` (of the row's language) and
    ``rejected`` (the score reaches it) by a fitted model; input columns of these names are replaced."""
    return verdicts(docs if model is None else logits(docs, model, text, lang), model)
