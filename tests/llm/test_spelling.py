"""Spelling variants against brute force."""

import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isohyet.llm import spelling

KIND = "doc_id long, text string"


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point makes b of a: by trying them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows, least_length=7, least_count=2, times=10, spoil=31):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def got(df):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()), key=lambda r: r[0])


def corpus(seed=1, many=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdéÿ×") for _ in range(rng.randint(7, 11))) for _ in range(40)]
    rows = []
    for k in range(many):
        told = []
        for _ in range(rng.randint(0, 200)):
            w = base[min(int(rng.expovariate(0.2)), len(base) - 1)]
            for _ in range(rng.choice((0, 0, 0, 1, 2))):
                at = rng.randrange(len(w))
                w = rng.choice((w[:at] + w[at + 1 :], w[:at] + rng.choice("abcdé") + w[at + 1 :], w[:at] + rng.choice("ab") + w[at:]))
            told.append(rng.choice((w, w.upper(), w + "1", "short")))
        rows.append((k, rng.choice((" ", "-", "\n", "_")).join(told)))
    return rows


@pytest.mark.parametrize("block", [4, 1024])
def test_equals_brute_force(spark, block):
    rows = corpus() + [(None, "Nothing nothing nothing"), (None, None), (7, ""), (7, "Nothing nothing"), (7, "Nothing nothing")]
    rows.append((900, "Überlangÿ " * 5000 + "a" * 3000 + " " + "a" * 3000 + " " + "a" * 3001 + " " + "a" * 3001))
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS word", "2 AS n", "3 AS near", "'x' AS _l").repartition(5)
    want = brute(rows)
    assert got(spelling.group_spellings(df, block=block)) == want
    assert any(w[1] for w in want) and any(w[4] > 3 for w in want)


def test_chain_of_forms(spark):
    rows = [(k, w) for k, (w, n) in enumerate((("abcdefg ", 300), ("abcdefgh ", 30), ("abcdefghi ", 3), ("abcdefghij ", 2))) for w in [w * n]]
    made = {r[0]: r for r in got(spelling.group_spellings(spark.createDataFrame(rows, KIND), spoil=10**9))}
    assert made["abcdefghi"][2] == "abcdefg" and made["abcdefghi"][1] == "abcdefgh" and made["abcdefghij"][1] is None
    assert [tuple(r) for r in made.values()] == brute(rows, spoil=10**9)


def test_ties_go_to_the_least_code_points(spark):
    rows = [(1, "zzzzzza " * 20 + "zzzzzzb " * 20 + "zzzzzzé " * 2 + "zzzzzzÿq " * 2)]
    assert got(spelling.group_spellings(spark.createDataFrame(rows, KIND), spoil=10**9)) == brute(rows, spoil=10**9)


def test_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({spelling.ORACLE_SQL})").fetchall())
    made = got(spelling.group_spellings(spark.read.parquet(f"{sf}/documents.parquet")))
    assert made == want and any(r[1] is not None for r in made)


def test_empty_table(spark):
    assert got(spelling.group_spellings(spark.createDataFrame([], KIND))) == []
    assert got(spelling.group_spellings(spark.createDataFrame([(1, None), (None, "12 34")], KIND))) == []


def test_hot_key_is_split(spark):
    """3,000 words that share their first half are compared in chunk pairs, none of them larger than a few blocks."""
    rng = random.Random(3)
    told = sorted({"qqqq" + "".join(rng.choice("abcdef") for _ in range(5)) for _ in range(3000)})
    table = spark.createDataFrame([(w, 2) for w in told], "word string, n long")
    sizes = spelling._tiles(spelling._postings(table), 128).groupBy("_l", "_side", "_half", "_i", "_j").count()
    assert sizes.selectExpr("max(count)").first()[0] < 3 * 128
    made = {(r["word"], r["near"]) for r in spelling.near_words(table, 128).collect()}
    small = told[:200]
    assert {p for p in made if p[0] in small[:40]} == {(a, b) for a in small[:40] for b in told if one_edit(a, b)}
    assert len(made) == spelling.near_words(table, 128).count() and all((b, a) in made for a, b in made)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=6), min_size=2, max_size=8))
def test_prefix_and_suffix_tell_single_edits(told):
    import numpy as np

    i, j, _ = spelling.near_pairs(told, np.triu(np.ones((len(told), len(told)), bool), 1))
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(len(told)) for b in range(a + 1, len(told)) if one_edit(told[a], told[b])}
