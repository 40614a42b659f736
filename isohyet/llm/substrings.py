"""Substring dedup by seed and extend: words of long repeats go, first instances stay.

A window is ``WINDOW`` consecutive words.  Seeds are winnowed anchors: of the
``WINDOW - SEED + 1`` runs of ``SEED`` words in each window the one with the
least hash, so equal windows always have equal seeds.  The join works by
messages between parts of the documents (a few MB of text each, dealt by a hash
of doc_id, text and the input's partition, so that rows of one doc_id, or without
any, and copies of one row spread over parts) and the hash space:

1. each part sends its distinct seeds; seeds known to two parts are reported back;
2. around each shared seed the part extends both ways, to every window that the
   seed stands for, and sends these windows' hashes with its least doc_id;
   every part but the one with the least is told that least doc_id;
3. a window of a document above the least doc_id is covered; overlapping covered
   windows merge into maximal repeats, and their words are removed.

A part sends a seed or window once, however often it holds it, so a passage that
a third of all documents share costs a row per part; rows of one hash are read
in a stream that keeps one row.  The documents are shuffled once, and the three
steps reuse that exchange.  Windows are compared by 64-bit hashes.

Defined cases: null texts have no words; documents of fewer than ``WINDOW``
words lose none; equal doc_ids (repeated rows) don't cover each other; a null
doc_id counts as the largest; texts of any length are read whole; empty tables
give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import mix64

WINDOW = 13
SEED = 5
PART_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max


def _hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    weights = mix64(np.arange(1, k + 1, dtype=np.uint64) + np.uint64(k << 32)) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * weights[j]
    return mix64(total)


def _seeds(hashes: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The seed of each window: the least gram hash in it."""
    grams = _grams(hashes, seed)
    width = window - seed + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least, have = grams, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least[:n]


class Part:
    """The documents of one part, by ascending doc_id, laid end to end; a window starts at each place in ``starts``."""

    def __init__(self, docs: pa.Table, window: int, seed: int):
        ids = docs.column("doc_id").fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.null = ids[order], docs.column("doc_id").take(pa.array(order)).combine_chunks()
        texts = docs.column("text").cast(pa.binary()).take(pa.array(order)).to_pylist()
        self.words = [(x or b"").split() for x in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64)
        self.hashes = [_hash_words(w) for w in self.words]
        self.window, self.seed = window, seed
        n = np.maximum(self.counts - window + 1, 0)
        self.of = np.repeat(np.arange(len(n)), n)
        self.starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    def seeds(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *[_seeds(h, self.window, self.seed) for h in self.hashes]])

    def windows(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *[_grams(h, self.window) for h in self.hashes]])


def _least(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, each with its least id, and the place of every row among them; ids ascend."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    place = np.empty(len(hashes), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], ids[order[new]], place


def _inside(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _send_seeds(window: int, seed: int) -> Callable[[pa.Table], pa.Table]:
    def send(docs: pa.Table) -> pa.Table:
        found = np.unique(Part(docs, window, seed).seeds())
        return pa.table({"h": _as_long(found), "part": pa.repeat(docs.column("part")[0], len(found))})

    return send


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, part) sorted by h: those whose h has several rows."""
    wait_h, wait_p, wait_hit = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
    for batch in batches:
        h = np.concatenate([wait_h, batch.column("h").to_numpy()])
        p = np.concatenate([wait_p, batch.column("part").to_numpy()])
        same = h[1:] == h[:-1]
        hit = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        hit[: len(wait_hit)] |= wait_hit
        wait_h, wait_p, wait_hit = h[-1:], p[-1:], hit[-1:]
        out = hit[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(p[:-1][out]), pa.array(h[:-1][out])], ["part", "h"])
    if wait_hit.any():
        yield pa.RecordBatch.from_arrays([pa.array(wait_p), pa.array(wait_h)], ["part", "h"])


def _send_windows(window: int, seed: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(docs: pa.Table, told: pa.Table) -> pa.Table:
        empty = pa.table({"h": _as_long(np.zeros(0, np.uint64)), "part": pa.array([], pa.int32()), "least": pa.array([], pa.int64())})
        if not docs.num_rows or not told.num_rows:
            return empty
        part = Part(docs, window, seed)
        near = _inside(part.seeds(), np.sort(_unsigned(told.column("h"))))
        hashes, least, _ = _least(part.windows()[near], part.ids[part.of[near]])
        return pa.table({"h": _as_long(hashes), "part": pa.repeat(docs.column("part")[0], len(hashes)), "least": pa.array(least)})

    return send


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, part, least) sorted by h and least: all but the first of each h, with the first's least."""
    last_h, last_least = None, None
    for batch in batches:
        h, part, least = (batch.column(n).to_numpy() for n in ("h", "part", "least"))
        if not len(h):
            continue
        first = np.concatenate(([h[0] != last_h], h[1:] != h[:-1]))
        at = np.maximum.accumulate(np.where(first, np.arange(len(h)), -1))
        global_least = np.where(at >= 0, least[at], last_least if last_least is not None else 0)
        last_h, last_least = h[-1], global_least[-1]
        rest = ~first
        yield pa.RecordBatch.from_arrays([pa.array(part[rest]), pa.array(h[rest]), pa.array(global_least[rest])], ["part", "h", "least"])


def _remove(window: int, seed: int, keep_text: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def remove(docs: pa.Table, told: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if keep_text else [])]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        if not docs.num_rows:
            return pa.table({n: pa.array([], k) for n, k in zip(names, kinds, strict=False)})
        part = Part(docs, window, seed)
        hashes, least, place = _least(part.windows(), part.ids[part.of])
        if told.num_rows:
            h = _unsigned(told.column("h"))
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            found = hashes[at] == h
            np.minimum.at(least, at[found], told.column("least").to_numpy()[found])
        covered = least[place] < part.ids[part.of]
        at = (part.begin[part.of] + part.starts)[covered]
        edge = np.zeros(int(part.counts.sum()) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        removed, sha, kept = [], [], []
        for words, begin, n in zip(part.words, part.begin.tolist(), part.counts.tolist(), strict=True):
            out = gone[begin : begin + n]
            if out.any():
                words = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
            text = b" ".join(words)
            removed.append(n - len(words))
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode() if keep_text else "")
        columns = [part.null, pa.array(part.counts), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())]
        return pa.table(dict(zip(names, columns, strict=False)))

    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, part_bytes: int = PART_BYTES, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; kept_text too, if asked for."""
    if not 0 < seed <= window:
        raise ValueError("a seed has at least one word and no more than a window")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    dealt = docs.select(F.col("doc_id").cast("long"), "text").withColumn("part", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(parts)).cast("int"))
    seeds = dealt.groupBy("part").applyInArrow(_send_seeds(window, seed), "h long, part int")
    shared = seeds.repartition("h").sortWithinPartitions("h").mapInArrow(_shared, "part int, h long")
    windows = dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_send_windows(window, seed), "h long, part int, least long")
    told = windows.repartition("h").sortWithinPartitions("h", "least").mapInArrow(_answer, "part int, h long, least long")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    return dealt.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_remove(window, seed, keep_text), schema)


#: The same rows in DuckDB, by listing all windows.
ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 12, 0))) AS i FROM w),
wins AS (SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS least FROM wins GROUP BY k),
hit AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM wins JOIN firsts USING (k) WHERE least < doc_id),
gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, j: NOT list_contains(ps, j)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
