"""The whole pipeline against plain Python over the same documents, and its stages on empty, odd and clashing rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isohyet.llm import common, cotraining, sharding, simhash

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def windows(text):
    w = words(text)
    return {tuple(w[a : a + 10]) for a in range(max(1, len(w) - 9))} if w else set()


def one_of_each_group(rows):
    """The least doc_id of each component of two-bit fingerprints and of five-word similarity 0.8, by all pairs."""
    label = list(range(len(rows)))
    texts = [(r.text or "").encode() for r in rows]
    prints = [simhash.fingerprint(t) for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in texts)]
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    groups = defaultdict(list)
    for r, x in zip(rows, label, strict=True):
        groups[x].append(r)
    return [min(g, key=lambda r: r.doc_id) for g in groups.values()]


def replicated(rows):
    """Copies by the inverse Poisson distribution of each source's rate at the document's hashed number."""
    size = Counter()
    for r in rows:
        size[r.source] += len((r.text or "").encode())
    out = []
    for r in rows:
        mean = sum(size.values()) / len(size) / size[r.source]
        draws = max(1, math.ceil(mean / 64))
        for j in range(1, draws + 1):
            u = int(hashlib.md5(f"20|{r.doc_id}|{j}".encode()).hexdigest()[:13], 16) / 2**52
            p = total = math.exp(-mean / draws)
            n = 0
            while total <= u:
                n += 1
                p *= mean / draws / n
                total += p
            out += [r] * n
    return out


def test_run_equals_plain_python(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    bench = {w for r in common.table(spark, SF, "benchmark").collect() for w in windows(r.text)}
    model = cotraining.train(docs.select(*corpus_pipeline.COLUMNS), labels)
    rows = [r for r in docs.collect() if cotraining.score_texts(model, [(r.text or "").encode()], [r.lang], [r.source])[2][0] >= cotraining.ACCEPT]
    assert 50 < len(rows) < docs.count()
    rows = one_of_each_group(rows)
    sizes = {len(w) for w in bench}
    rows = [r for r in rows if not any(tuple(w[k : k + n]) in bench for w in [words(r.text)] for n in sizes for k in range(len(w) - n + 1))]
    rows = replicated(rows)
    key = lambda r: (r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()))
    rows.sort(key=key)
    shard, slot = sharding.locate(np.arange(len(rows), dtype=np.uint64), len(rows), 40)
    want = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest(), int(a), int(b)) for r, a, b in zip(rows, shard, slot, strict=True))
    assert Counter((r.doc_id, r.text_sha256, r.shard, r.slot) for r in corpus_pipeline.run(spark, SF).collect()) == want


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, stage):
    name, work = corpus_pipeline.STAGES[stage]
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(200_000))
    rows = [(None, None, None, None, 0), (None, "", "en", "s", 0), (1, "a tie of texts here", "en", "s", 1), (1, "a tie of texts here", "en", "s", 1), (1, "another text under the id", None, "s", 1), (2, long, "de", None, 3)]
    docs = spark.createDataFrame([(*r, 5, 6, 7.0, 8) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, shard int, copy int, rate double, node long")
    got = work(spark, docs, SF)
    assert set(corpus_pipeline.COLUMNS) <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    if name in ("benchmark decontamination", "sharding"):
        assert kept == Counter((r[0], r[1]) for r in rows)
    if name == "SimHash near-dedup":
        # texts without words have fingerprint zero and are one group; the repeated row is one
        assert sorted(kept.values()) == [1, 1, 1, 1] and (1, "another text under the id") in kept and (2, long) in kept
    assert set(kept) <= {(r[0], r[1]) for r in rows}
    assert work(spark, docs.limit(0), SF).filter(F.lit(True)).count() == 0
