"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of length 0 to ``ORDER`` with symbol
counts.  A context's escape probability is q / (n + q) (n symbols seen, q of them
distinct); symbols that a context has seen are excluded below it, so the
probabilities of every context sum to one and the code lengths are exact.  The
counts are frozen after training: the length of a byte depends only on the
context before it, so a tree unfolds into a table of bits by (longest known
context, byte), and scoring a text is a walk of look-ups over all of its bytes, one
per language.  The prediction is the language of the shortest code; the score is
its posterior probability under equal priors.

Training takes a bounded sample: per language at most ``SAMPLE_ROWS`` rows, in
the order of a hash of doc_id, until ``SAMPLE_BYTES`` bytes are reached; a text
longer than ``PIECE`` characters gives a piece of that length from a place chosen
by a hash.  A language's tree has at most ``STATES`` contexts, the most frequent
ones, whatever the number of languages: 6 MB or so a language in every task, and
scoring takes time in proportion to the languages.  They are the labels of a
classifier; lang is not meant to hold free text.  Scoring reads whole texts in
blocks, so memory does not grow with their length.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as
is every text where no language was learned; rows with null lang don't train;
ties of code lengths go to the first language by name; a null doc_id is not held
out; repeated rows and extra columns change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm.common import slices

ORDER = 4
SAMPLE_ROWS = 400
SAMPLE_BYTES = 1_200_000
PIECE = 1 << 16
STATES = 14_000
BLOCK = 1 << 18
EDGE, OTHER = 0, 1


@dataclass
class Tree:
    """Of one language: child by (state, byte before it), of the states that have longer contexts; bits by (state, symbol).

    start: the state that the two bytes before lead to, by (last, last but one); deep: the first state of two bytes.
    """

    child: np.ndarray
    bits: np.ndarray
    start: np.ndarray
    deep: int


@dataclass
class Model:
    """symbols: symbol of each byte; a tree per language."""

    languages: list[str]
    symbols: np.ndarray
    size: int
    order: int
    trees: list[Tree]


def _codes(data: np.ndarray, length: int, size: int) -> np.ndarray:
    """Codes of all runs of a length without an edge, the last symbol lowest."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code, clean = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(length):
        part = data[j : j + n]
        code = code * size + part
        clean &= part != EDGE
    return code[clean]


def _contexts(counted: list[tuple[np.ndarray, np.ndarray]], order: int, size: int, states: int) -> list[np.ndarray]:
    """Codes of the contexts that a tree holds, by length from 1: the most frequent ones, each with all its endings."""
    found = []
    for k in range(1, order + 1):
        code, many = counted[k]
        held, place = np.unique(code // size, return_inverse=True)
        found.append((held, np.bincount(place, weights=many, minlength=len(held))))
    every = np.sort(np.concatenate([np.zeros(0), *[n for _, n in found]]))[::-1]
    floor = max(2.0, every[states] + 1 if len(every) > states else 2.0)
    levels, below = [], np.zeros(1, np.int64)
    for k, (held, many) in enumerate(found):
        kept = held[many >= floor]
        kept = kept[np.isin(kept % size**k, below)] if k else kept
        levels.append(kept)
        below = kept
    return levels


def _tree(data: np.ndarray, order: int, size: int, states: int) -> Tree:
    counted = [np.unique(_codes(data, k + 1, size), return_counts=True) for k in range(order + 1)]
    levels = _contexts(counted, order, size, states)
    # State 0 is the empty context; the states of order k follow those of lower orders.
    first = np.cumsum([1, *[len(x) for x in levels]])
    child = np.repeat(np.arange(first[order - 1] if order else 1, dtype=np.int32)[:, None], size, axis=1)
    above = []
    for k, kept in enumerate(levels):
        parent = np.zeros(len(kept), np.int64) if k == 0 else first[k - 1] + np.searchsorted(levels[k - 1], kept % size**k)
        child[parent, kept // size**k] = first[k] + np.arange(len(kept))
        above.append(parent)
    prob = np.zeros((int(first[-1]), size))
    for k in range(order + 1):
        held = np.zeros(1, np.int64) if k == 0 else levels[k - 1]
        if not len(held):
            continue
        code, many = counted[k]
        context = code // size
        at = np.minimum(np.searchsorted(held, context), len(held) - 1)
        ok = held[at] == context
        count = np.zeros((len(held), size))
        count[at[ok], (code % size)[ok]] = many[ok]
        lower = prob[above[k - 1]] if k else np.where(np.arange(size) == EDGE, 0.0, 1.0 / (size - 1))[None, :]
        n, q = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
        rest = np.where(count > 0, 0.0, lower)
        mass = rest.sum(1, keepdims=True)
        whole = np.maximum(n + np.where(mass > 1e-12, q, 0), 1)
        escape = np.where(n > 0, q / whole, 1.0)
        begin = 0 if k == 0 else first[k - 1]
        prob[begin : begin + len(held)] = np.where(count > 0, count / whole, escape * rest / np.maximum(mass, 1e-12))
    bits = -np.log2(np.maximum(prob, 1e-30))
    bits[:, EDGE] = 0
    one = np.repeat(child[0][:, None], size, axis=1)
    deep = int(first[min(order, 1)])
    start = np.where(one > 0, child[np.minimum(one, len(child) - 1), np.arange(size)[None, :]], 0) if order > 1 else one
    return Tree(child.reshape(-1), bits.astype(np.float32).reshape(-1), start.astype(np.int32).reshape(-1), deep)


def train(texts: dict[str, list[bytes]], order: int = ORDER, states: int = STATES) -> Model:
    languages = sorted(texts)
    seen = np.zeros(256, bool)
    for parts in texts.values():
        for x in parts:
            seen[np.unique(np.frombuffer(x, np.uint8))] = True
    symbols = np.full(256, OTHER, np.int32)
    symbols[seen] = np.arange(2, 2 + seen.sum())
    size = int(seen.sum()) + 2
    while size ** (order + 1) >= 1 << 62:
        order -= 1
    trees = []
    for lang in languages:
        data = np.concatenate([np.zeros(1, np.int64), *[np.append(symbols[np.frombuffer(x, np.uint8)], EDGE) for x in texts[lang]]])
        trees.append(_tree(data, order, size, states))
    return Model(languages, symbols, size, order, trees)


def _costs(model: Model, laid: np.ndarray) -> Iterator[np.ndarray]:
    """Bits of each symbol from the order-th on under each language, from the contexts before it."""
    order, size = model.order, model.size
    n, said = len(laid) - order, laid[order:]
    if order < 2:
        pair = laid[: len(laid) - 1][-n:] * size if order else np.zeros(n, np.int32)
    else:
        pair = laid[order - 1 : -1] * size + laid[order - 2 : -2]
    for tree in model.trees:
        state = tree.start[pair]
        alive = np.flatnonzero(state >= tree.deep)
        for back in range(3, order + 1):
            now = state[alive]
            following = tree.child[now * size + laid[order - back + alive]]
            moved = following != now
            alive = alive[moved]
            state[alive] = following[moved]
        state *= size
        state += said
        yield tree.bits[state]


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language: a row per text."""
    total = np.zeros((len(texts), len(model.languages)))
    edge = np.zeros(model.order, np.int32)

    def score(laid: list[np.ndarray], of: np.ndarray) -> None:
        whole = np.concatenate([edge, *laid])
        low, high = of[0], of[-1] + 1
        for number, cost in enumerate(_costs(model, whole)):
            total[low:high, number] += np.bincount(of - low, weights=cost, minlength=high - low)

    waiting: list[np.ndarray] = []
    first = held = 0
    for k, text in enumerate([*texts, None]):
        if waiting and (text is None or held + len(text) > BLOCK):
            score(waiting, np.repeat(np.arange(first, k), [len(x) for x in waiting]))
            waiting, held = [], 0
        if text is None:
            break
        if len(text) > BLOCK:
            for at in range(0, len(text), BLOCK):
                left = model.symbols[np.frombuffer(text[max(0, at - model.order) : at], np.uint8)]
                piece = model.symbols[np.frombuffer(text[at : at + BLOCK], np.uint8)]
                for number, cost in enumerate(_costs(model, np.concatenate([edge[len(left) :], left, piece]))):
                    total[k, number] += cost.sum(dtype=np.float64)
            continue
        if not waiting:
            first = k
        waiting.append(np.append(model.symbols[np.frombuffer(text, np.uint8)], np.int32(EDGE)))
        held += len(text) + 1
    return total


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES, piece: int = PIECE) -> dict[str, list[bytes]]:
    """Texts (or pieces of long ones) per language, of rows that are not held out; bounded by rows and size per language."""
    able = docs.filter(~held_out() & F.col("lang").isNotNull() & (F.col("text") != ""))
    shares = {r["lang"]: min(1.0, 2.0 * rows / r["n"] + 16.0 / r["n"]) for r in able.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return {}
    limit = docs.sparkSession.createDataFrame([(k, int(v * (1 << 30))) for k, v in shares.items()], "_lang string, _limit long")
    rank = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    begin = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.greatest(F.char_length("text") - piece, F.lit(0)) + 1).cast("int") + 1
    near = able.select("doc_id", "lang", F.substring(F.col("text"), begin, F.lit(piece)).alias("text"), rank.alias("_rank")).join(F.broadcast(limit), F.col("lang") == F.col("_lang")).filter("_rank < _limit")
    order = Window.partitionBy("lang").orderBy("_rank", "doc_id", "text")
    long = F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    chosen = near.withColumn("_n", F.row_number().over(order)).withColumn("_before", F.coalesce(long, F.lit(0))).filter((F.col("_n") <= rows) & (F.col("_before") < size))
    found: dict[str, list[bytes]] = {lang: [] for lang in shares}
    for r in chosen.select("lang", "text", "_n").orderBy("lang", "_n").collect():
        found[r["lang"]].append(r["text"].encode())
    return {k: v for k, v in found.items() if v}


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte of every row; reads text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512, BLOCK):
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            known = np.array(batch.column("lettered").to_pylist(), bool) & bool(shared.value.languages)
            bits = code_lengths(shared.value, [t if k else b"" for t, k in zip(texts, known, strict=True)])
            names, scores, rates = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            if bits.shape[1]:
                best = bits.argmin(1)
                least = bits.min(1)
                scores = np.where(known, 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1), 0.0)
                names = [shared.value.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
                rates = least / np.maximum([len(t) for t in texts], 1)
            made = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores), pa.array(rates)]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select("doc_id", "text", held_out().alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")


def identify_languages(docs: DataFrame) -> DataFrame:
    return identify(docs, train(training_sample(docs)))
