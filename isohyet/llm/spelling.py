"""Spelling variant grouping by dense prefix-suffix tiling.

Words come from the corpus with their counts.  Two words of L and L or L + 1 code
points are a single edit apart exactly when their common prefix and their common
suffix together reach the longer length minus one.  Of two such words either the
first floor(L / 2) code points agree or the last L - floor(L / 2), so every word
is posted under both halves, for L its own length and its own length minus one.
Postings that share a key form blocks; of the words of a block, code points stand
in padded matrices, aligned at the start and at the end, and all pairs of two
blocks are compared at once.

A key of more than BLOCK words is dealt over chunks, and each pair of chunks is a
block pair of its own, so one task holds a few blocks whatever the key.  The
comparisons within one key grow with the square of its words: that is the dealt
method; words spread over as many keys as there are halves of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import checkpoint, shuffle_partitions

LEAST_LENGTH, LEAST_COUNT, SPOIL, TIMES = 7, 2, 31, 10
#: Words of a block; code-point matrices of two blocks and their comparison are held at once.
BLOCK = 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-z\\x{C0}-\\x{FF}"


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, spoil: int = SPOIL) -> DataFrame:
    """word and n, the occurrences of every word of all texts that is long and frequent enough.

    A run whose hash with its doc_id is a multiple of ``spoil`` loses one code point
    first; a null doc_id counts as empty.  Shorter runs can't become words, since
    runs only lose code points, and are left by the pattern itself.  Null and empty
    texts have no words; repeated rows count each.
    """
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0)))
    run = F.translate("_run", UPPER, LOWER)
    told = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"), runs.alias("_run")).withColumn("_run", run)
    told = told.withColumn("_h", F.crc32(F.concat("_doc", F.lit(":"), "_run").cast("binary")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    spoilt = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    word = F.when(F.col("_h") % spoil == 0, spoilt).otherwise(F.col("_run"))
    counted = told.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= least_length) & (F.col("n") >= least_count))


#: A key: the class (length of the shorter word), the side and the half that both words share.
KEY = ["_l", "_side", "_half"]


def _postings(table: DataFrame) -> DataFrame:
    """word, n and the four keys of each word: both halves, for its own length and for its length minus one."""
    size = F.length("word")
    classes = table.withColumn("_l", F.explode(F.array(size, size - 1))).filter("_l > 0")
    sides = classes.withColumn("_side", F.explode(F.array(F.lit("p"), F.lit("s"))))
    half = F.expr("CASE WHEN _side = 'p' THEN left(word, CAST(floor(_l / 2) AS INT)) ELSE right(word, CAST(_l - floor(_l / 2) AS INT)) END")
    return sides.withColumn("_half", half)


def _tiles(posted: DataFrame, block: int) -> DataFrame:
    """Postings with the chunk pair (_i, _j) in which they are compared, and their own _chunk.

    The sizes of the keys are counted with partial sums.  Keys of one word have no
    pairs and go; only keys of more than a block have more than one chunk.
    """
    sizes = posted.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    met = posted.join(sizes, KEY).withColumn("_chunks", F.ceil(F.col("_size") / block).cast("int"))
    met = met.withColumn("_chunk", F.pmod(F.xxhash64("word"), F.col("_chunks")).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return met.select(*KEY, F.least("_chunk", "_other").alias("_i"), F.greatest("_chunk", "_other").alias("_j"), "_chunk", "word", "n")


def matrix(told: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of words, and their code points padded with zeros: from the start, and backwards from the end."""
    size = np.array([len(w) for w in told], np.int32)
    row = np.repeat(np.arange(len(told)), size)
    col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    points = np.frombuffer("".join(told).encode("utf-32-le"), np.uint32)
    start, end = np.zeros((2, len(told), int(size.max(initial=1))), np.uint32)
    start[row, col] = points
    end[row, size[row] - 1 - col] = points
    return size, start, end


def near_pairs(told: list[str], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The wanted pairs (rows and columns of a square of booleans) that are a single edit apart, and their common prefixes.

    The matrices are read column by column: a pair stays open while its columns
    agree, so the columns it stays open for are its common prefix, or suffix.
    """
    size, start, end = matrix(told)
    i, j = np.nonzero(wanted & (np.abs(size[:, None] - size[None, :]) <= 1))
    longer, shorter = np.maximum(size[i], size[j]), np.minimum(size[i], size[j])

    def common(points: np.ndarray) -> np.ndarray:
        found, still = np.zeros(len(i), np.int32), np.arange(len(i))
        for k in range(points.shape[1]):
            still = still[(k < shorter[still]) & (points[i[still], k] == points[j[still], k])]
            if not len(still):
                break
            found[still] += 1
        return found

    prefix = common(start)
    hit = (prefix + common(end) >= longer - 1) & (prefix < longer)
    return i[hit], j[hit], prefix[hit]


def _block(rows: list[tuple]) -> pa.RecordBatch:
    """Near pairs, both ways, of rows (class, side, half, i, j, chunk, word, n) of whole chunk pairs.

    Two words that share the first half are met on that side alone, the others on
    the side of the last half, so no pair is told twice.
    """
    length, side, _, first, second, chunk, told, n = (list(x) for x in zip(*rows, strict=True))
    group = np.cumsum([0] + [x[:5] != y[:5] for x, y in zip(rows, rows[1:], strict=False)])
    size, length, chunk = np.array([len(w) for w in told]), np.array(length), np.array(chunk)
    wanted = np.triu(group[:, None] == group[None, :], 1) & (np.minimum(size[:, None], size[None, :]) == length[:, None])
    split = np.array(first) != np.array(second)
    wanted &= ~split[:, None] | (chunk[:, None] != chunk[None, :])
    i, j, prefix = near_pairs(told, wanted)
    keep = (np.array(side)[i] == "p") == (prefix >= length[i] // 2)
    a, b = np.concatenate([i[keep], j[keep]]).tolist(), np.concatenate([j[keep], i[keep]]).tolist()
    return pa.RecordBatch.from_arrays([pa.array([told[x] for x in a], pa.string()), pa.array([told[x] for x in b], pa.string()), pa.array([n[x] for x in b], pa.int64())], ["word", "near", "near_n"])


def near_words(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, near, near_n: all words a single edit from each word of a table of distinct words with their n."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if len(held) >= block and row[:5] != held[-1][:5]:
                    yield _block(held)
                    held = []
                held.append(row)
        if held:
            yield _block(held)

    at = [*KEY, "_i", "_j"]
    dealt = _tiles(_postings(table), block).repartition(shuffle_partitions(table.sparkSession), *at).sortWithinPartitions(*at)
    return dealt.mapInArrow(compare, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that is reached from each word of a table (word, form) by following forms.

    Steps are doubled each round.  Forms have ten times the occurrences of their
    words, so chains are a few steps long and have no rings; rounds end when none moves.
    """
    now = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        now = checkpoint(now.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))


def group_spellings(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES, block: int = BLOCK, spoil: int = SPOIL) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the corpus.

    A word's form is its most frequent near word (ties: the least in code-point
    order) if that is ``times`` as frequent.  Extra columns of docs are not read;
    an empty table has no words.
    """
    table = checkpoint(words(docs, least_length, least_count, spoil))
    best = F.min(F.struct((-F.col("near_n")).alias("_m"), "near"))
    found = near_words(table, block).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    told = table.join(found, "word", "left")
    held = -F.col("_best._m") >= times * F.col("n")
    told = checkpoint(told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(held, F.col("_best.near")).alias("form"), F.when(held, -F.col("_best._m")).alias("form_n")))
    ends = roots(told.filter("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same words by another way: near words share what is left when one code point goes.
ORACLE_SQL = f"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM (
  SELECT b, list_reduce(CAST(range(8) AS UBIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END, CAST(b AS UBIGINT)) AS c FROM range(256) r(b))),
run AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{LETTERS}]{{{LEAST_LENGTH},}}')), '{UPPER}', '{LOWER}') AS run FROM documents),
hex AS (SELECT run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM run),
crc AS (SELECT run, xor(list_reduce(list_transform(range(CAST(length(x) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS UBIGINT)), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1]), CAST(4294967295 AS UBIGINT)), CAST(4294967295 AS UBIGINT)) AS h FROM hex, tab),
told AS (SELECT CASE WHEN h % {SPOIL} = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM crc),
w AS MATERIALIZED (SELECT word, count(*) AS n FROM told GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND count(*) >= {LEAST_COUNT}),
gone AS MATERIALIZED (SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest FROM w, range(100000) r(i) WHERE i < length(word)),
pair AS (SELECT a.word, b.word AS near, b.n AS near_n FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gone a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM gone a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(row(-near_n, near)) AS b FROM pair GROUP BY 1),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= {TIMES} * w.n THEN b[2] END AS form, CASE WHEN -b[1] >= {TIMES} * w.n THEN -b[1] END AS form_n FROM w LEFT JOIN best USING (word)),
step AS (SELECT word, word AS root, 0 AS depth FROM f UNION ALL SELECT step.word, f.form, depth + 1 FROM step JOIN f ON f.word = step.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, depth) AS root FROM step GROUP BY 1) r USING (word)"""
