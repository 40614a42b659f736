"""Quality classifier by co-training of a text view and a metadata view.

The text view is the set of a text's words, word beginnings and symbol runs; the
metadata view is provenance and layout: language, source, length, and shares of
character classes, repeated words and line breaks.  Each view has a logistic
classifier (the text view over tokens that differ between the classes).  Over
``ROUNDS`` rounds all documents without a label are scored by both views, and each
view labels the ``PER_ROUND`` texts of either class that it is surest of for the
other view, unless that view leans to the opposite.  Each view is calibrated on
labelled rows that it did not train on (Platt scaling); a view is sure by its
calibrated probability, so one that cannot see a fault (metadata tell little of
toxic texts) is never sure of the good class.  The combination of the two
calibrated views, fitted on the same rows, scores all documents.

A document is good if its quality label is 1 and it is not labelled toxic.

The labelled rows are a bounded sample: at most ``LABELLED`` in the order of a hash
of doc_id, chosen by their keys; their whole texts are read in parallel, and their
features meet in one task, which returns the model.  The pool is the whole corpus:
one pass writes for every document the few hundred bytes that the rounds need (the
tokens among the ``UNIVERSE`` that may tell the classes apart, and the layout), and a
round is a scan of that table, in which every task keeps its surest texts.  Copies
of a text count once.  Scoring reads all documents' whole texts.

Defined cases: a text without words scores 0 and is rejected; without labels of
both classes every text with words scores 1; null lang and source are values of
their own (names meet in ``BUCKETS`` hashed columns a kind, so none is left out);
labels that repeat a doc_id count as its worst, and every row of that doc_id has
it; rows without doc_id have no label; equally sure texts go by the hash of the
text; texts of any length train and are scored, few bytes at a time as Python
objects; repeated rows score alike; empty tables give no rows; extra columns are
not read.
"""

from __future__ import annotations

import operator
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import checkpoint, slices

LABELLED = 4000
ROUNDS, PER_ROUND, SURE = 3, 150, 0.95
TOKENS, LEAST_Z, LEAST_DF = 1500, 3.5, 4
#: A token's odds must differ by this factor's logarithm, so that words which merely come with length stay out.
LEAST_LIFT = 1.2
#: Tokens that may be chosen in a later round: those with a z value and lift of so much among the labelled rows.
UNIVERSE, WIDE_Z, WIDE_LIFT = 8192, 2.0, 0.7
#: Bytes of the word beginnings that are tokens as well.
PREFIXES = (4, 5)
#: Labels up to this many are broadcast (12 bytes each); beyond, the join is shuffled.
BROADCAST_LABELS = 1_000_000
#: What a row that the other view labelled weighs beside a labelled one.
TOLD_WEIGHT = 0.1
ACCEPT = 0.5
BUCKETS = 64
_SYMBOLS = re.compile(rb"[!-/:-@\[-`{-~]{2,}|[|#*%$&~^=+<>]")
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c < 0x80 and not chr(c).isalnum() else c for c in range(256))
#: Character classes: other, lower, upper, digit, space, line break, punctuation of prose, symbol.
_CLASS = np.zeros(256, np.uint8)
for _c in range(128):
    _x = chr(_c)
    _CLASS[_c] = 1 if _x.islower() else 2 if _x.isupper() else 3 if _x.isdigit() else 5 if _x == "\n" else 4 if _x.isspace() else 6 if _x in ".,;:'\"-()?" else 7
CLASSES = 8
BLOCK = 1 << 22


Views = tuple[np.ndarray, np.ndarray]


def tokens(text: bytes) -> tuple[set[bytes], list[bytes]]:
    """The distinct words, their first letters and symbol runs; the words in order."""
    words = text.translate(_WORDS).split()
    held = set(words)
    for size in PREFIXES:
        held.update([w[:size] + b"*" for w in held if len(w) > size and w[-1] != 0x2A])
    held.update(_SYMBOLS.findall(text))
    return held, words


def layout(text: bytes, words: list[bytes]) -> list[float]:
    n = max(1, len(text))
    shares = np.zeros(CLASSES)
    for at in range(0, len(text), BLOCK):
        shares += np.bincount(_CLASS[np.frombuffer(text[at : at + BLOCK], np.uint8)], minlength=CLASSES)
    again = sum(map(operator.eq, words, words[1:]))
    many = max(1, len(words))
    return [np.log1p(len(text)), *(shares / n), again / many, len(set(words)) / many, np.log1p(len(words)), n / many]


def metadata(text: bytes, words: list[bytes], lang: str | None, source: str | None) -> np.ndarray:
    """The columns of the metadata view: layout, its roots, and a hashed column for the language and the source."""
    made = np.array(layout(text, words))
    names = np.zeros(2 * BUCKETS)
    for k, name in enumerate((lang, source)):
        names[k * BUCKETS + xxhash.xxh3_64_intdigest((name or "").encode()) % BUCKETS] = 1.0
    return np.concatenate([made, np.sqrt(np.abs(made)), names]).astype(np.float32)


@dataclass
class Logistic:
    """A linear classifier over standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, standard: bool = True, steps: int = 300, weight: np.ndarray | None = None) -> Logistic:
    """By accelerated gradient steps on the mean loss (of weighted rows) with an L2 term; without ``standard`` the columns are 0 or 1."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    mean = x.mean(0) if standard else np.zeros(x.shape[1])
    scale = np.where(x.std(0) > 1e-9, x.std(0), 1.0) if standard else np.ones(x.shape[1])
    z = np.clip((x - mean) / scale, -6, 6) if standard else x
    share = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
    n = max(1e-9, share.sum())
    weights, bias = np.zeros(x.shape[1]), float(np.log((share @ y + 1) / (n - share @ y + 1)))
    v, vb, t = weights.copy(), bias, 1.0
    top = 1.0
    if z.size:
        probe = np.ones(z.shape[1])
        for _ in range(12):
            probe = z.T @ (share * (z @ probe))
            probe /= max(np.linalg.norm(probe), 1e-12)
        top = float(share @ (z @ probe) ** 2) / n
    rate = 1.0 / (0.25 * (top + 1.0) + l2 / n)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v + vb, -30, 30)))
        off = share * (p - y)
        new, new_bias = v - rate * (z.T @ off / n + l2 / n * v), vb - rate * float(off.sum() / n)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - weights), new_bias + (t - 1) / t_next * (new_bias - bias)
        weights, bias, t = new, new_bias, t_next
    return Logistic(mean, scale, weights, bias)


@dataclass
class Row:
    """A text's features: places of its tokens in the universe, and its metadata columns."""

    held: np.ndarray
    meta: np.ndarray


@dataclass
class Model:
    """Both views with their calibration, and the combination; fitted is False without both classes."""

    fitted: bool = False
    words: dict[bytes, int] = field(default_factory=dict)
    chosen: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    text: Logistic | None = None
    meta: Logistic | None = None
    text_scale: tuple[float, float] = (1.0, 0.0)
    meta_scale: tuple[float, float] = (1.0, 0.0)
    both: Logistic | None = None

    def row(self, text: bytes, lang: str | None, source: str | None) -> tuple[Row, bool]:
        """Features of a text, and whether it has words."""
        held, words = tokens(text)
        places = [self.words[t] for t in held if t in self.words]
        return Row(np.array(places, np.uint16), metadata(text, words, lang, source)), bool(words)

    def logits(self, rows: list[Row]) -> Views:
        """Of the text view and of the metadata view, not calibrated."""
        weights = np.zeros(len(self.words) + 1)
        weights[self.chosen] = self.text.weights
        said = np.array([weights[r.held].sum() for r in rows]) + self.text.bias
        return said, self.meta.logit(np.stack([r.meta for r in rows]).astype(float))

    def score(self, logits: Views) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the text view, the metadata view, and both."""
        a, b = (scale[0] * x + scale[1] for scale, x in zip((self.text_scale, self.meta_scale), logits, strict=True))
        return sigmoid(a), sigmoid(b), sigmoid(self.both.logit(np.stack([np.clip(a, -12, 12), np.clip(b, -12, 12)], 1)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def contrast(good: np.ndarray, every: np.ndarray, n1: int, n0: int) -> Views:
    """A two-sample z value and log odds ratio of each token, of the rows that hold it."""
    share = every / (n1 + n0)
    z = np.abs(good / n1 - (every - good) / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    return z, np.abs(np.log((good + 0.5) / (every - good + 0.5) * n0 / n1))


def split(labels: np.ndarray) -> Views:
    """Rows that train and rows that calibrate (every third), or all for both if either would lack a class."""
    at = np.arange(len(labels))
    learn, hold = at[at % 3 != 0], at[at % 3 == 0]
    return (learn, hold) if len(set(labels[hold])) > 1 and len(set(labels[learn])) > 1 else (at, at)


def universe(held: list[set[bytes]], labels: np.ndarray) -> dict[bytes, int]:
    """The tokens that may tell the classes apart, numbered."""
    if len(set(labels)) < 2:
        return {}
    learn, _ = split(labels)
    every, good = Counter(), Counter()
    for i in learn:
        every.update(held[i])
        if labels[i]:
            good.update(held[i])
    names = sorted(t for t, n in every.items() if n >= LEAST_DF)
    n1 = int(labels[learn].sum())
    z, lift = contrast(np.array([good[t] for t in names], float), np.array([every[t] for t in names], float), n1, len(learn) - n1)
    fit = np.flatnonzero((z >= WIDE_Z) & (lift >= WIDE_LIFT))
    return {names[k]: n for n, k in enumerate(sorted(fit[np.argsort(-z[fit], kind="stable")][:UNIVERSE]))}


def fit(words: dict[bytes, int], rows: list[Row], labels: np.ndarray, told: dict[str, list[tuple[Row, int]]]) -> Model:
    """A model of labelled rows and of the rows that each view was told by the other."""
    model = Model(True, words)
    learn, hold = split(labels)
    known = [(rows[i], int(labels[i])) for i in learn]
    given = known + told["text"]
    y = np.array([label for _, label in given], float)
    dense = np.zeros((len(given), len(words) + 1), np.uint8)
    for k, (row, _) in enumerate(given):
        dense[k, row.held] = 1
    # Tokens that the labelled rows choose stay; the told rows may add to them.
    strength = np.zeros(len(words) + 1)
    for n in {len(known), len(given)}:
        n1, n0 = max(1, int(y[:n].sum())), max(1, int((1 - y[:n]).sum()))
        every = dense[:n].sum(0, dtype=np.int64).astype(float)
        z, lift = contrast(dense[:n][y[:n] == 1].sum(0, dtype=np.int64).astype(float), every, n1, n0)
        strength = np.maximum(strength, np.where((every >= LEAST_DF) & (z >= LEAST_Z) & (lift >= LEAST_LIFT), z, 0))
    good = np.flatnonzero(strength)
    model.chosen = np.sort(good[np.argsort(-strength[good], kind="stable")][:TOKENS])
    weight = lambda rows: np.r_[np.ones(len(known)), np.full(len(rows), TOLD_WEIGHT)]
    model.text = fit_logistic(dense[:, model.chosen], y, l2=0.1, standard=False, steps=800, weight=weight(told["text"]))
    given = known + told["meta"]
    model.meta = fit_logistic(np.stack([row.meta for row, _ in given]), np.array([label for _, label in given], float), weight=weight(told["meta"]))
    y = labels[hold].astype(float)
    logits = model.logits([rows[i] for i in hold])
    for name, x in zip(("text", "meta"), logits, strict=True):
        platt = fit_logistic(x[:, None], y, l2=0.1)
        setattr(model, f"{name}_scale", (float(platt.weights[0] / platt.scale[0]), float(platt.bias - platt.weights[0] * platt.mean[0] / platt.scale[0])))
    a, b = (scale[0] * x + scale[1] for scale, x in zip((model.text_scale, model.meta_scale), logits, strict=True))
    model.both = fit_logistic(np.stack([np.clip(a, -12, 12), np.clip(b, -12, 12)], 1), y, l2=0.1)
    return model


# The labelled sample -----------------------------------------------------------------------------


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        held, made = [], []
        for text, lang, source in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True):
            found, words = tokens(text or b"")
            held.append(sorted(found))
            made.append(metadata(text or b"", words, lang, source).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(held, pa.list_(pa.binary())), pa.array(made, pa.binary())], ["key", "label", "held", "meta"])


def marked(labels: DataFrame) -> DataFrame:
    """doc_id and label (1 good, 0 not) of labelled documents."""
    worst = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_q"), F.max(F.coalesce("toxic", F.lit(0))).alias("_t"))
    return worst.select(F.col("doc_id").cast("long").alias("doc_id"), ((F.col("_q") == 1) & (F.col("_t") == 0)).cast("int").alias("label"))


def training_rows(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """Features and label of the sample; its keys are chosen first, so that only its texts are moved."""
    known = marked(labels)
    rank = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30))
    share = F.lit(int(min(1.0, (1.1 * labelled + 50) / max(1, known.count())) * (1 << 30)))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source").withColumn("key", F.xxhash64("doc_id", "text"))
    near = keyed.select("doc_id", "key").filter(rank <= share).join(known.filter(rank <= share), "doc_id").withColumn("_rank", rank)
    chosen = near.dropDuplicates(["key"]).orderBy("_rank", "doc_id", "key").limit(labelled).select("key", "label")
    return keyed.filter(rank <= share).join(F.broadcast(chosen), "key").select("key", "label", "text", "lang", "source").mapInArrow(_sampled, "key long, label int, held array<binary>, meta binary")


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[list[set[bytes]], list[np.ndarray], np.ndarray]:
    """Token sets, metadata and labels, in the order of keys, repeated rows once, so that every third row is a fair sample of either class."""
    rows = {}
    for batch in batches:
        for key, label, held, meta in zip(*[batch.column(n).to_pylist() for n in ("key", "label", "held", "meta")], strict=True):
            rows[key] = (set(held), np.frombuffer(meta, np.float32), label)
    ordered = [rows[k] for k in sorted(rows)]
    return [x[0] for x in ordered], [x[1] for x in ordered], np.array([x[2] for x in ordered], int)


def _in_task(sample: DataFrame, work) -> object:
    """What work makes of all sampled rows, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(work(*_read(batches)))], pa.binary())], ["made"])

    return pickle.loads(sample.repartition(1).mapInArrow(run, "made binary").first()["made"])


def _fitted(words: dict[bytes, int], told: dict[str, list[tuple[Row, int]]]):
    def work(held: list[set[bytes]], meta: list[np.ndarray], labels: np.ndarray) -> Model:
        if len(set(labels)) < 2:
            return Model()
        rows = [Row(np.array([words[t] for t in h if t in words], np.uint16), m) for h, m in zip(held, meta, strict=True)]
        return fit(words, rows, labels, told)

    return work


# The pool ------------------------------------------------------------------------------------------


def pool_rows(docs: DataFrame, labels: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """node (a hash of the text), held and meta of every distinct text with words of which no row has a label."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(words=shared.value)
        for batch in slices(batches):
            held, made, full = [], [], []
            for text, lang, source in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True):
                row, has = model.row(text or b"", lang, source)
                held.append(row.held.tobytes())
                made.append(row.meta.tobytes())
                full.append(has)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(held, pa.binary()), pa.array(made, pa.binary())], ["doc_id", "node", "held", "meta"]).filter(pa.array(full, pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("node"), "text", "lang", "source").mapInArrow(work, "doc_id long, node long, held binary, meta binary")
    known = marked(labels)
    # Said beforehand, so that a plan changed at run time does not make the features twice.
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    free = rows.join(known, "doc_id", "left")
    one = free.groupBy("node").agg(F.max("label").alias("label"), F.min(F.struct("held", "meta")).alias("row"))
    return checkpoint(one.filter("label is null").select("node", "row.held", "row.meta"))


def surest(model: Model, told: dict[str, set[int]], per_round: int = PER_ROUND):
    """Of every task the texts that a view is surest of, for the other view: for (that view), label, strength, node, held, meta."""
    names = ("view", "label", "strength", "node", "held", "meta")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[str, int], list[tuple]] = {(v, y): [] for v in told for y in (0, 1)}
        for batch in slices(batches, 1 << 12):
            node, held, meta = (batch.column(n).to_pylist() for n in ("node", "held", "meta"))
            rows = [Row(np.frombuffer(h, np.uint16), np.frombuffer(m, np.float32)) for h, m in zip(held, meta, strict=True)]
            if not rows:
                continue
            by = dict(zip(("text", "meta"), model.score(model.logits(rows))[:2], strict=True))
            for view, other in (("text", "meta"), ("meta", "text")):
                for label in (0, 1):
                    strength, against = (by[view], by[other] < 0.5) if label else (1 - by[view], by[other] > 0.5)
                    fresh = [(-float(strength[k]), node[k], held[k], meta[k]) for k in np.flatnonzero((strength >= SURE) & ~against) if node[k] not in told[other]]
                    best[other, label] = sorted(best[other, label] + fresh)[:per_round]
        found = [(view, label, *row) for (view, label), rows in best.items() for row in rows]
        kinds = (pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)], list(names))

    return work


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    sample = checkpoint(training_rows(docs, labels, labelled))
    if sample.isEmpty():
        return Model()
    words = _in_task(sample, lambda held, meta, y: universe(held, y))
    told: dict[str, list[tuple[Row, int]]] = {"text": [], "meta": []}
    nodes: dict[str, set[int]] = {"text": set(), "meta": set()}
    model = _in_task(sample, _fitted(words, told))
    if not model.fitted or not rounds:
        return model
    pool = pool_rows(docs, labels, words)
    for _ in range(rounds):
        found = checkpoint(pool.mapInArrow(surest(model, nodes), "view string, label int, strength double, node long, held binary, meta binary"))
        for view in told:
            for label in (0, 1):
                for r in found.filter((F.col("view") == view) & (F.col("label") == label)).orderBy("strength", "node", "held", "meta").limit(PER_ROUND).collect():
                    if r["node"] not in nodes[view]:
                        nodes[view].add(r["node"])
                        told[view].append((Row(np.frombuffer(r["held"], np.uint16), np.frombuffer(r["meta"], np.float32)), label))
        model = _in_task(sample, _fitted(words, told))
    return model


# All documents ---------------------------------------------------------------------------------------


def score_texts(model: Model, texts: list[bytes], langs: list[str | None], sources: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not model.fitted or not texts:
        full = np.array([bool(text.translate(_WORDS).split()) for text in texts], float)
        return full, full, full
    made = [model.row(*x) for x in zip(texts, langs, sources, strict=True)]
    full = np.array([has for _, has in made], float)
    return tuple(p * full for p in model.score(model.logits([row for row, _ in made])))


def score_documents(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """The named columns (doc_id) of docs with p_text, p_meta, score and keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = columns or ["doc_id"]
    read = list(dict.fromkeys([*out, "text", "lang", "source"]))
    kinds = dict(docs.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            a, b, both = score_texts(shared.value, texts, batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in out], pa.array(a), pa.array(b), pa.array(both), pa.array(both >= ACCEPT)], [*out, "p_text", "p_meta", "score", "keep"])

    schema = ", ".join([*[f"`{n}` {kinds[n]}" for n in out], "p_text double, p_meta double, score double, keep boolean"])
    return docs.select(*read).mapInArrow(work, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs, labels))
