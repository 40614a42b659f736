"""Benchmark decontamination: one Aho-Corasick automaton over normalised items.

Items and texts are normalised alike: A-Z to lower case, every other ASCII
character that is no digit or letter to a separator, separators to one space.
The automaton holds the windows of ``WINDOW`` consecutive item words (a shorter
item is one window), each between spaces, and passes once over a text.  Matches
are mapped to word numbers and, through the words' own offsets, to spans of code
points of the original text.

The automaton is held by every task, so its size is bounded: a benchmark of more
than ``BLOCK_WORDS`` windows (about 2 KB of automaton each) is cut into shards of
so many.  The texts are still read once: a task holds ``CHUNK`` bytes of texts and
passes every shard over them in turn, one automaton at a time, and merges the
hits.  All shards are broadcast as lists of windows.

Defined cases: null texts and items have no words; items without words have no
window; repeated item_ids count once; windows of an item without id hit words
but name no item; texts of any length are scanned whole, few bytes at a time as
Python objects; repeated rows stay; empty tables give no rows or no hits; extra
columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import slices

WINDOW = 10
BLOCK_WORDS = 50_000
CHUNK = 32 << 20
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))
_SCHEMA = "doc_id long, n_words long, runs array<int>, items array<string>, spans array<struct<start:long,stop:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[dict[bytes, set[str]]]:
    """Windows with the ids of their items, in shards whose window count is bounded; the driver holds one at a time."""
    block: dict[bytes, set[str]] = defaultdict(set)
    for row in items.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        for key in windows_of(words_of((row["text"] or "").encode()), window):
            block[key].update(() if row["item_id"] is None else (row["item_id"],))
            if len(block) >= block_words:
                yield dict(block)
                block = defaultdict(set)
    if block:
        yield dict(block)


def automaton(block: dict[bytes, set[str]]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for key, ids in block.items():
        made.add_word(f" {key.decode('latin-1')} ", (key.count(b" ") + 1, tuple(sorted(ids))))
    made.make_automaton()
    return made


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def spans_of(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code-point spans of runs of words in the original text."""
    if not runs:
        return []
    found = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(points[found[a][0]]), "stop": int(points[found[b - 1][1]])} for a, b in runs]


def scan(made: ahocorasick.Automaton, text: bytes) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs [start, stop) of hit words, and ids of the items found."""
    words = words_of(text)
    if not words:
        return [], set()
    flat = b" " + b" ".join(words) + b" "
    runs, ids, gaps = [], set(), None
    for end, (length, names) in made.iter(flat.decode("latin-1")):
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20)
        last = int(np.searchsorted(gaps, end))
        runs.append((last - length, last))
        ids.update(names)
    return _merge(runs), ids


class Shards:
    """The broadcast shards of a benchmark; one automaton stands at a time."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int, block_words: int):
        self.held = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks(items, window, block_words)]

    def __iter__(self) -> Iterator[ahocorasick.Automaton]:
        if len(self.held) == 1:
            if not hasattr(self, "one"):
                self.one = automaton(self.held[0].value)
            yield self.one
        else:
            yield from (automaton(block.value) for block in self.held)


def _scanned(batches: Iterator[pa.RecordBatch], shards: Shards) -> Iterator[tuple[pa.RecordBatch, list[tuple[list[tuple[int, int]], set[str]]]]]:
    """Slices of few texts with the runs of hit words and the item ids of each text, after all shards."""

    def passed(chunk: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
        found = [[([], set()) for _ in range(part.num_rows)] for part in chunk]
        for made in shards:
            for part, held in zip(chunk, found, strict=True):
                for k, text in enumerate(part.column("text").cast(pa.binary())):
                    runs, ids = scan(made, text.as_py() or b"")
                    if runs:
                        held[k] = (_merge(held[k][0] + runs), held[k][1] | ids)
        return zip(chunk, found, strict=True)

    chunk, size = [], 0
    for part in slices(batches):
        chunk.append(part)
        size += part.nbytes
        if len(shards.held) == 1 or size >= CHUNK:
            yield from passed(chunk)
            chunk, size = [], 0
    yield from passed(chunk)


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, runs (word numbers, start and stop in turn), items, spans of every row of docs."""
    shards = Shards(docs, items, window, block_words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scanned(batches, shards):
            texts = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
            arrays = [
                part.column("doc_id"), pa.array([len(words_of(x)) for x in texts], pa.int64()), pa.array([[x for r in runs for x in r] for runs, _ in found], pa.list_(pa.int32())),
                pa.array([sorted(ids) for _, ids in found], pa.list_(pa.string())), pa.array([spans_of(x, runs) for x, (runs, _) in zip(texts, found, strict=True)], _SPANS),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "items", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, _SCHEMA)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = find_leaks(docs, items)
    odd = F.aggregate("runs", F.struct(F.lit(-1).cast("long").alias("sign"), F.lit(0).cast("long").alias("n")), lambda s, x: F.struct((-s["sign"]).alias("sign"), (s["n"] + s["sign"] * x).alias("n")), lambda s: s["n"])
    return found.select(
        "doc_id", "n_words", odd.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"), "spans",
    )


def clean_rows(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs, with all their columns, that have no hit word; texts are scanned where they lie."""
    shards = Shards(docs, items, WINDOW, block_words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scanned(batches, shards):
            yield part.filter(pa.array([not runs for runs, _ in found], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


#: The digest in DuckDB, by listing all windows of documents and items.
ORACLE_SQL = r"""
WITH folded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
keys AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS k
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM items WHERE len(ws) > 0)),
starts AS (
  SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM folded, (SELECT DISTINCT n FROM keys)),
hits AS (
  SELECT s.doc_id, s.i, s.n, k.item_id FROM starts s JOIN keys k ON k.n = s.n AND k.k = array_to_string(s.ws[s.i:s.i + s.n - 1], ' ')),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM folded LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""
