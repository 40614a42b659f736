"""Co-training: the Spark rounds against plain loops, long and repeated rows, and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.llm import common, cotraining

SCHEMA = "doc_id long, text string, lang string, source string, shard int"
MB = " ".join(f"long{i}" for i in range(200_000))


def corpus():
    rng = np.random.default_rng(3)
    good, bad = [f"good{i}" for i in range(40)], [f"bad{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(240):
        fine = i % 3 > 0
        words = list(rng.choice(good if fine else bad, 12)) + [f"any{k}" for k in rng.integers(0, 60, 20)]
        rows.append((i, " ".join(rng.permutation(words)) + ("" if fine else " || ##"), ("en", None)[i % 2], f"s{i % 40}", 1))
        if i < 120:
            labels.append((i, int(fine), 0))
    rows += [rows[5], rows[130], (None, rows[131][1], "en", None, 1), (5, "another text of five", None, None, 1), (300, None, None, None, 1), (301, MB + " good1 good2 good3", "en", "s1", 1), (302, MB + " bad1 bad2 || ##", "en", "s2", 1)]
    return rows, [*labels, (5, 0, 0), (301, 1, 0), (302, 0, 0), (None, 1, 0), (7, None, 1)]


def by_loops(rows, labels, rounds):
    """The same rounds in plain Python: fits are shared, the choice of rows and texts is not."""
    worst = {}
    for i, q, t in labels:
        if i is not None and q is not None:
            worst[i] = min(worst.get(i, 1), int(q == 1 and not t))
    keyed = {(i, t): (i, t, lang, source) for i, t, lang, source, _ in rows if i in worst}
    made = {k: (*cotraining.tokens((k[1] or "").encode()), k) for k in keyed}
    return worst, keyed, made


def test_rounds_equal_plain_loops(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    worst, keyed, made = by_loops(rows, labels, 2)
    keys = {(r.doc_id, r.text): r.key for r in docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).collect()}
    order = sorted(keyed, key=lambda k: keys[k])
    held = [made[k][0] for k in order]
    y = np.array([worst[k[0]] for k in order])
    words = cotraining.universe(held, y)
    plain = cotraining.Model(words=words)
    sample = [plain.row((k[1] or "").encode(), keyed[k][2], keyed[k][3])[0] for k in order]
    node = {r.text: r.node for r in docs.select("text", F.xxhash64("text").alias("node")).collect()}
    labelled_texts = {t for i, t, *_ in rows if i in worst}
    pool = {}
    for _, t, lang, source, _ in rows:
        row, full = plain.row((t or "").encode(), lang, source)
        if full and t not in labelled_texts:
            pool[node[t]] = min([pool[node[t]], row] if node[t] in pool else [row], key=lambda r: (r.held.tobytes(), r.meta.tobytes()))
    given, nodes = {"text": [], "meta": []}, {"text": set(), "meta": set()}
    model = cotraining.fit(words, sample, y, given)
    for _ in range(2):
        ids = sorted(pool)
        a, b, _ = model.score(model.logits([pool[k] for k in ids]))
        picks = []
        for view, mine, other in (("meta", a, b), ("text", b, a)):
            for label in (0, 1):
                sure, lean = (mine, other) if label else (1 - mine, 1 - other)
                able = [(-float(sure[k]), ids[k]) for k in range(len(ids)) if sure[k] >= cotraining.SURE and lean[k] >= 0.5 and ids[k] not in nodes[view]]
                picks += [(view, label, k) for _, k in sorted(able)[: cotraining.PER_ROUND]]
        for view, label, k in sorted(picks, key=lambda x: (x[0] != "text", x[1])):
            if k not in nodes[view]:
                nodes[view].add(k)
                given[view].append((pool[k], label))
        model = cotraining.fit(words, sample, y, given)
    assert given["text"] and given["meta"]
    got = cotraining.train(docs, told, rounds=2)
    assert (got.words, got.chosen.tolist()) == (words, model.chosen.tolist())
    assert got.text.weights == pytest.approx(model.text.weights) and got.both.weights == pytest.approx(model.both.weights)
    scored = {(r.doc_id, r.score, r.keep) for r in cotraining.score_documents(docs, got).collect()}
    for i, t, lang, source, _ in rows:
        want = cotraining.score_texts(model, [(t or "").encode()], [lang], [source])[2][0]
        assert any(j == i and s == pytest.approx(want, abs=1e-6) for j, s, _ in scored)
    assert cotraining.score_documents(docs, got).count() == len(rows)
    keep = {(i, k) for i, _, k in scored}
    assert (301, True) in keep and (302, False) in keep and (300, False) in keep


def test_sample_is_bounded_and_whole(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert cotraining.training_rows(docs, told, labelled=10).dropDuplicates(["key"]).count() == 10
    full = cotraining.training_rows(docs, told).dropDuplicates(["key"])
    assert full.count() == 123  # 120, the other text of 5, and both long ones
    assert full.filter(F.size("held") > 200_000).count() == 2
    assert not cotraining.train(docs, told.filter("quality = 1")).fitted
    assert not cotraining.train(docs.limit(0), told).fitted


def test_held_out_accuracy(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    got = cotraining.score_documents(docs, cotraining.train(docs, labels.filter(half))).join(labels.filter(~half), "doc_id")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    assert got.agg(F.avg((good == F.col("keep")).cast("int"))).first()[0] > 0.9
    assert got.filter(good).agg(F.avg(F.col("keep").cast("int"))).first()[0] > 0.95
