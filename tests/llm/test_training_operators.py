"""Each operator against brute force on a small fixture with nulls, empty and long texts, ties, repeated rows and clashing names."""

import hashlib
import html
import re
import zlib
from collections import Counter

import ahocorasick  # noqa: F401
import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from isohyet.llm import chat, common, cotraining, decontaminate, graph, mixing, ppm, sharding, simhash, spotsigs, substrings, tagpaths

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, rate double, shard int, h long, _bucket int"
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(40))


def fixture():
    texts = [None, "", "   \n\t", "a", "The cat sat on the mat and the dog ran to the house. " * 5, "The cat sat on the mat and the dog ran to the house. " * 5, LONG, LONG + " end"]
    texts += [f"intro{i} {PASSAGE} outro{i} the end of it" for i in range(6)] + ["ÀÉ über straße ñandú 中文 字 🙂 x <|im_end|>"] + [f"unique{i} and the other{i} of it" for i in range(5)]
    rows = [(i, t, None if i % 5 == 0 else ("en", "de")[i % 2], None if i % 7 == 0 else f"s{i % 3}", len(t or ""), i, 1.0, 2, 3, 4) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[9], rows[9]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_op4_brute_force(docs, empty):
    rows = fixture()
    least = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            least[key] = min(least.get(key, i), i)
    want = Counter()
    for i, t, *_ in rows:
        w = words(t)
        gone = {p for k in range(len(w) - 12) if least[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        want[i, len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest()] += 1
    for size in (1 << 10, 1 << 22):
        assert Counter(map(tuple, substrings.remove_repeats(docs, part_bytes=size).collect())) == want
    assert substrings.remove_repeats(empty).count() == 0


def test_op4_of_one_repeated_row(spark):
    """Repeated rows, and rows of one doc_id or none, spread over parts and don't cover each other; the exchange of texts is made once."""
    rows = spark.range(300).select(F.when(F.col("id") % 3 > 0, 7).alias("doc_id"), F.lit(PASSAGE).alias("text")).repartition(4)
    rows = rows.unionByName(spark.createDataFrame([(9, f"x {PASSAGE} y")], rows.schema))
    made = substrings.remove_repeats(rows, part_bytes=1 << 12)
    got = Counter((r.doc_id, r.n_removed) for r in made.collect())
    assert got == {(7, 0): 200, (None, 40): 100, (9, 40): 1}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def fold(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def test_op7_brute_force(spark, docs, empty):
    items = [(1, PASSAGE.upper()), (10, "shared1 shared2 shared3"), (2, None), (3, "..."), (None, "dog ran"), (10, "straße"), (5, PASSAGE)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, t, *_ in fixture():
        w, hit, ids = fold(t), set(), set()
        for name, text in items:
            x = fold(text)
            for a in range(max(1, len(x) - 9)) if x else ():
                key = x[a : a + 10]
                for k in range(len(w) - len(key) + 1):
                    if w[k : k + len(key)] == key:
                        hit.update(range(k, k + len(key)))
                        ids.update([] if name is None else [str(name)])
        want[i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)] += 1
    assert Counter(tuple(r)[:6] for r in decontaminate.decontaminate(docs, bench).collect()) == want
    small = decontaminate.find_leaks(docs, bench, block_words=7)
    assert Counter((r.doc_id, tuple(r["items"]), tuple(r.runs)) for r in small.collect()) == Counter((r.doc_id, tuple(r["items"]), tuple(r.runs)) for r in decontaminate.find_leaks(docs, bench).collect())
    text = fixture()[8][1]
    spans = [r.spans for r in small.filter("doc_id = 8").collect()][0]
    assert text[spans[0].start : spans[0].stop] == PASSAGE
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    for size in (7, 50_000):
        assert decontaminate.clean_rows(docs, bench, block_words=size).count() == sum(n for k, n in want.items() if not k[5])
    assert decontaminate.clean_rows(docs, bench.limit(0)).count() == len(fixture())


def test_op10_brute_force(spark, docs, empty):
    def fp(text):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if not w:
            return 0
        hs = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), seed=42) for k in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    near = [(100 + k, f"{PASSAGE} tail{k}", None, None, 0, 0, 0.0, 0, 0, 0) for k in range(30)]
    rows = fixture() + near
    made = spark.createDataFrame(rows, SCHEMA)
    prints = {r[0]: fp(r[1]) for r in rows}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = simhash.near_duplicates(made).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{p:016x}", find(i)) for i, p in prints.items()}
    assert simhash.near_duplicates(empty).count() == 0


def test_links_of_a_wide_list():
    rng = np.random.default_rng(5)
    fp = np.unique(rng.integers(0, 1 << 16, 3000)).astype(np.int64)
    rep = np.arange(len(fp)) + 7
    a, b = simhash._links(np.zeros(len(fp), np.int64), fp, rep)
    root = np.arange(len(fp))
    for k in range(len(fp)):
        near = np.flatnonzero(np.bitwise_count((fp ^ fp[k]).view(np.uint64)) <= 2)
        least = root[near].min()
        root[np.isin(root, root[near])] = least
    label = dict(zip(rep.tolist(), rep.tolist(), strict=True)) | dict(zip(a.tolist(), b.tolist(), strict=True))
    assert [label[int(r)] for r in rep] == (root + 7).tolist()


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 99), (101, 100), (7, 7)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {99: 99, 100: 99, 101: 99}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_op9_one_row_repeated_spreads(spark):
    """One row 40,000 times is numbered in many partitions, not in one."""
    rows = spark.range(40_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.rand(3).alias("_salt"))
    dealt = rows.repartitionByRange(8, "doc_id", "text", "_salt").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    got = sharding.shard_documents(rows.drop("_salt")).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("last")).collect()
    assert dealt < 10_000 and len(got) == 40 and {(r.n, r.last) for r in got} == {(1000, 999)}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel(n):
    x = np.arange(n, dtype=np.uint64)
    y = sharding.permute(x, n, 3)
    assert sorted(y.tolist()) == x.tolist()
    assert (sharding.permute(y, n, 3, inverse=True) == x).all()
    shard, slot = sharding.locate(x, n, 7, 3)
    assert (sharding.rank_at(shard, slot, n, 7, 3) == x).all()


def test_op9(docs, empty):
    got = sharding.shard_documents(docs).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(fixture()) and max(sizes.values()) - min([*sizes.values(), *([0] if len(sizes) < 40 else [])]) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert {(r.doc_id, r.size) for r in got} == {(i, len((t or "").encode()) + 16) for i, t, *_ in fixture()}
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sharding.shard_documents(docs.repartition(2)).collect()), key=str)
    assert {(r.doc_id, r.text_crc32, r.law, r.grown_shard) for r in got} == {(i, zlib.crc32((t or "").encode()), "rows", None) for i, t, *_ in fixture()}
    rows = sharding.shard_rows(docs.withColumn("slot", F.lit(9)))
    assert sorted((r.shard, r.slot) for r in rows.collect()) == sorted((r.shard, r.slot) for r in got)
    places = lambda found: Counter((r.doc_id, r.row_number, r.shard, r.slot) for r in found)
    assert places(rows.collect()) == places(got)
    assert sharding.shard_documents(empty).count() == 0 and sharding.shard_rows(empty).count() == 0


def test_op9_of_one_repeated_row(spark):
    """A row that is repeated ten thousand times spreads over the partitions that number it, and every copy has a place of its own."""
    rows = spark.range(10_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.col("id").alias("_id"))
    got = sharding.shard_rows(rows.unionByName(spark.createDataFrame([(None, None, -1), (None, "x", -2)], "doc_id long, text string, _id long")))
    assert got.select("row_number").distinct().count() == 10_002 and set(got.columns) == {"doc_id", "text", "_id", "row_number", "shard", "slot"}
    assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 5_000
    assert got.filter("_id < 0").agg(F.max("row_number")).first()[0] == 1


def test_op5(spark, docs, empty):
    got = mixing.mix(docs).collect()
    assert all(r.copy <= r.n_copies for r in got)
    again = mixing.mix(docs.repartition(2)).collect()
    assert Counter((r.doc_id, r.copy) for r in got) == Counter((r.doc_id, r.copy) for r in again)
    assert mixing.mix(empty).count() == 0
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.lit("s").alias("source"))
    for epochs in (0.5, 3.0, 200.0):
        n = [r.n for r in mixing.mix(many, epochs=epochs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
        n += [0] * (3000 - len(n))
        assert np.mean(n) == pytest.approx(epochs, rel=0.08) and np.var(n) == pytest.approx(epochs, rel=0.15)
    weighted = mixing.mix(docs, {"s0": 3.0, "s1": 1.0})
    assert {r.source for r in weighted.select("source").distinct().collect()} <= {"s0", "s1"}
    rare = spark.createDataFrame([(1, "ab", "rare", 1, 1.0), (1, "ab", "rare", 2, 2.0), *[(k, "x" * 100, "big", 3, 3.0) for k in range(2, 400)]], "doc_id long, text string, source string, _rate int, cdf double")
    whole = mixing.mix(rare)
    few = Counter((r.doc_id, r["_rate"], r.cdf, r.copy) for r in whole.filter("source = 'rare'").collect())
    assert len(few) > 9000 and set(few.values()) == {1} and max(k[3] for k in few) == whole.filter("doc_id = 1").first().n_copies
    assert "_mix_run" in whole._jdf.queryExecution().toString()
    held, mixing.BROADCAST_SOURCES = mixing.BROADCAST_SOURCES, 0
    try:
        assert Counter((r.doc_id, r.copy) for r in mixing.mix(docs).collect()) == Counter((r.doc_id, r.copy) for r in got)
    finally:
        mixing.BROADCAST_SOURCES = held


def test_op8_round_trip(spark):
    odd = ["", None, "<|im_start|>user\nhi<|im_end|>\n", "<\\|x", "<\\\\|<|", "<", "|<", "🙂 é", chat.PROBE]
    rows = [(c, t, ("user", "assistant", None, "sys\n\\n<|im_end|>")[(t + c) % 4], odd[(t * 3 + c) % len(odd)]) for c in range(5) for t in range(9)] + [(1, 2, "user", "tie"), (1, 2, "user", "tie"), (None, 0, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.chat_digest(turns).collect()}
    for conv in {r[0] for r in rows} | {-1}:
        said = sorted([(t, r or "", x or "") for c, t, r, x in [*rows, (-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)] if c == conv])
        loss = "".join(x for _, r, x in said if r == "assistant")
        assert got[conv].n_turns == len(said)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in said).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_digest(turns.limit(0)).count() == 1
    part = "struct<kind:string,text:string,ref:string,tokens:int>"
    typed = spark.createDataFrame([(1, 0, "user", [("text", "see <|image|>", None, None), ("image", None, "a.png", 3), ("audio", None, "b.wav", None)])], f"conv_id long, turn long, role string, parts array<{part}>")
    row = chat.format_conversations(typed).first()
    assert row.n_tokens_expanded == 4 and [a.ref for a in row.attachments] == ["a.png", "b.wav"]
    assert row.formatted[row.attachments[0].offset :].startswith("<|image|><|image|><|image|><|audio|>")
    some = typed.unionByName(spark.createDataFrame([(1, 1, "assistant", None), (1, 2, None, [])], typed.schema))
    row = chat.format_conversations(some).first()
    assert row.n_turns == 3 and row.n_tokens_expanded == 4 and len(row.attachments) == 2
    ties = [(1, 0, "assistant", "<|a"), (1, 0, "assistant", "<z"), (1, 0, "assistant", None)]
    got = chat.chat_digest(spark.createDataFrame(ties, "conv_id long, turn long, role string, text string")).filter("conv_id = 1").first()
    assert got.loss_sha256 == hashlib.sha256(b"<z<|a").hexdigest()


def test_op2(spark, docs, empty):
    got = {r.doc_id: r for r in spotsigs.fingerprint_documents(docs).collect()}
    rows = sorted(fixture(), key=lambda r: (-r[0], r[1] or ""))
    ids = [r[0] for r in rows]
    for k, (i, t, *_) in enumerate(rows):
        if ids.count(i) > 1:
            continue
        t, x = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 3
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - n] + x[:n]).encode()).hexdigest()
        assert got[i].n_chars == len(t) and 0 <= got[i].near_edited <= 1
    assert got[4].fingerprint == got[5].fingerprint and got[0].fingerprint == ""
    small = spotsigs.with_next(docs, buckets=1).collect()
    for n in (3, 40, 1000):
        assert Counter((r.doc_id, r.next.text) for r in small) == Counter((r.doc_id, r.next.text) for r in spotsigs.with_next(docs, buckets=n).collect())
    assert spotsigs.fingerprint_documents(empty).count() == 0
    prints = common.table(spark, SF, "documents").select("doc_id", spotsigs.signatures(F.col("text")).alias("sigs"))
    sets = {}
    for r in prints.collect():
        sets.setdefault(tuple(r.sigs), r.doc_id)
        sets[tuple(r.sigs)] = min(sets[tuple(r.sigs)], r.doc_id)
    items = [(i, set(s)) for s, i in sets.items() if s]
    want = {(min(a, b), max(a, b)) for a, s in items for b, t in items if a < b and len(s & t) / len(s | t) >= 0.8}
    assert {(r.id_a, r.id_b) for r in spotsigs.alike_sets(prints).collect()} == want
    label = {i: i for _, i in sets.items()}
    for _ in label:
        for a, b in want:
            label[a] = label[b] = min(label[a], label[b])
    rows = spotsigs.near_duplicates(prints).collect()
    assert len(rows) == prints.count()
    of = {r.doc_id: sets[tuple(r.sigs)] for r in prints.collect()}
    assert all(r.class_id == label[of[r.doc_id]] and r.n_links == sum(of[r.doc_id] in p for p in want) for r in rows)


def naive_code_length(trained, text, order, symbols):
    """PPM with exclusion by dictionaries: bits of text after training on whole texts, contexts of all lengths that were seen twice."""
    counts = Counter()
    for t in trained:
        for i in range(len(t)):
            for k in range(min(order, i) + 1):
                counts[t[i - k : i], t[i]] += 1
    seen = {}
    for (context, c), n in counts.items():
        seen.setdefault(context, {})[c] = n

    def probability(context, c):
        held = seen.get(context, {})
        lower = (lambda x: probability(context[1:], x)) if context else (lambda x: 1 / symbols)
        n, q = sum(held.values()), len(held)
        rest = {x: lower(x) for x in range(-1, symbols - 1) if x not in held}
        mass = sum(rest.values())
        whole = n + (q if mass > 1e-12 else 0)
        return held[c] / whole if c in held else q / whole * rest[c] / mass

    total = 0.0
    for i, c in enumerate(text):
        context = max((text[i - k : i] for k in range(min(order, i) + 1) if k == 0 or sum(seen.get(text[i - k : i], {}).values()) >= 2), key=len)
        total -= np.log2(probability(context, c))
    return total


def naive_signatures(text):
    """The set of (anchor, chain) of a text, by a loop over its words."""
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    common = set(spotsigs.ANCHORS)
    chain = lambda k, able: tuple([w for w in words[k + 1 :] if able(w)][: spotsigs.CHAIN])
    spots = [k for k, w in enumerate(words) if w in common]
    if spots:
        return {(words[k], chain(k, lambda w: w not in common)) for k in spots}
    return {(words[k], tuple(words[k + 1 : k + 1 + spotsigs.CHAIN])) for k in range(len(words))}


def test_op2_likenesses_equal_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    odd = [(-5, None), (-6, ""), (-7, "no anchored words stand here"), (-8, "the"), (-9, "the end of the first and the second"), (None, "of the null"), (None, "of the other null")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = [(r.doc_id, r.text or "", r.h) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in spotsigs.fingerprint_documents(docs).collect()}
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    for k, (i, t, _) in enumerate(rows):
        x = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        edited = t[: len(t) - n] + x[:n]
        r = got[i, len(t), hashlib.sha256(edited.encode()).hexdigest()]
        mine = naive_signatures(t)
        assert r.n_signatures == len(mine)
        assert r.near_edited == pytest.approx(like(mine, naive_signatures(edited)))
        assert r.near_next == pytest.approx(like(mine, naive_signatures(x)))
        assert len({*r.fingerprint.split(",")} - {""}) == len(mine)


def test_op2_of_one_id_and_of_nulls(spark):
    """Half of the rows have one doc_id, a quarter none: they spread over ranges, and every row has its next one."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("the text of "), F.col("id").cast("string")).alias("text")
    )
    got = spotsigs.with_next(rows, buckets=64).collect()
    assert len(got) == 4000 and len({r.next.text for r in got}) == 4000
    sizes = Counter(r["b"] for r in rows.withColumn("_h", F.xxhash64("text")).withColumn("b", spotsigs._buckets(rows, 64)).select("b").collect())
    assert max(sizes.values()) < 400


def test_op1_code_lengths_equal_brute_force():
    texts = {"a": [b"abracadabra abracadabra", b"cadabra a bar"], "b": [b"barbar bac bac dab", b"abab bar"]}
    letters = sorted({c for parts in texts.values() for t in parts for c in t})
    number = {c: k for k, c in enumerate(letters)}  # -1 stands for every other byte
    model = ppm.train(texts, order=3)
    for text in (b"abracadabra", b"bar zz cad", b"bacdab ab rac", b"a" * 30):
        got = ppm.code_lengths(model, [text])[0]
        for k, lang in enumerate(("a", "b")):
            trained = [tuple(number[c] for c in t) for t in texts[lang]]
            want = naive_code_length(trained, tuple(number.get(c, -1) for c in text), 3, len(letters) + 1)
            assert got[k] == pytest.approx(want, rel=1e-4)


def test_op1_ties_and_long_training_texts(spark):
    """Languages of the same texts tie: the first by name wins; a text longer than a piece gives one piece from inside it."""
    rows = [(i, "same text of both", ("zz", "aa")[i % 2], None, 0) for i in range(40)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_chars long")
    model = ppm.train({"zz": [b"same text of both"], "aa": [b"same text of both"]})
    got = ppm.identify(docs, model).collect()
    assert len(got) == 43 and {(r.lang_pred, r.score) for r in got} == {("aa", 0.5)}
    long = spark.createDataFrame([(1, "".join(chr(97 + i % 26) for i in range(1000)), "aa")], "doc_id long, text string, lang string")
    (piece,) = ppm.training_sample(long, piece=50)["aa"]
    assert len(piece) == 50 and piece in long.first().text.encode()


def test_op1(spark, docs, empty):
    model = ppm.train({"a": [b"abab abab abab"], "b": [b"bcbc bcbc \xc3\xa9"]}, order=3)
    for tree in model.trees:
        prob = np.exp2(-tree.bits.reshape(-1, model.size).astype(float))
        assert prob[:, 1:].sum(1) == pytest.approx(1, abs=1e-5)
    whole, block = [b"abab" * 50, b"", b"bcbcz"], ppm.BLOCK
    bits = ppm.code_lengths(model, whole)
    ppm.BLOCK = 7
    try:
        assert ppm.code_lengths(model, whole) == pytest.approx(bits)
    finally:
        ppm.BLOCK = block
    assert bits[0].argmin() == 0 and bits[2].argmin() == 1 and not bits[1].any()
    got = {r.doc_id: r for r in ppm.identify_languages(docs).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und" and got[0].score == 0
    assert {r.lang_pred for r in got.values()} <= {"und", "en", "de"}
    assert ppm.identify_languages(empty).count() == 0
    full = common.table(spark, "/root/testdata/sf0.01", "documents")
    told = ppm.identify_languages(full).join(full.select("doc_id", "lang"), "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert told > 0.95


def test_op6(spark, docs, empty):
    full, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    got = cotraining.classify(full, labels).join(labels, "doc_id")
    share = {(r.quality, r.toxic): r.k for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    assert share[1, 0] > 0.95 and share[0, 0] < 0.1 and share[1, 1] < 0.4
    plain = cotraining.classify(docs, labels.limit(0)).collect()
    assert {r.keep for r in plain if r.doc_id < 3} == {False} and all(r.keep for r in plain if r.doc_id >= 3)
    assert cotraining.classify(empty, labels).count() == 0


def test_op3(spark):
    rows = common.table(spark, "/root/testdata/sf0.01", "pages").collect()
    for r in rows:
        inner = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", inner)]
        assert tagpaths.main_text(r.html) == "\n".join(x for x in blocks if x)
    page = "<body><div class='cookie-notice'>We use cookies, a lot.</div><aside>Side text, here.</aside><div><p>One &amp; two,  three.<p>Four<br>five; six.<ul><li>A</ul></div><form>Name: x</form><div id=comments><p>I agree, fully.</p></div>"
    assert tagpaths.main_text(page) == "One & two, three.\nFour five; six.\nA"
    odd = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (2, None, "", 1), (3, "u", "<script>x", 1), (4, "u", "<a \"<p>" * 2000, 1)], "page_id long, url string, html string, text int")
    got = tagpaths.extract(odd).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got) and [r.text for r in got if r.page_id < 4] == [""] * 4
    assert tagpaths.extract(odd.limit(0)).count() == 0


def test_pipeline(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    now, before = docs, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, now, SF)
        rows = made.collect()
        assert set(corpus_pipeline.COLUMNS) <= set(made.columns)
        assert all(before[r.doc_id] == r.text for r in rows)
        if name == "SimHash near-dedup":
            texts = [r.text for r in rows]
            assert len(set(texts)) == len(texts)
            assert {r.text for r in now.collect()} >= set(texts)
        if name == "benchmark decontamination":
            assert decontaminate.decontaminate(made, common.table(spark, SF, "benchmark")).filter("contaminated").count() == 0
        now = common.checkpoint(made)
    n = now.count()
    assert sorted((r.shard, r.slot) for r in now.collect()) == sorted((k % 40, k // 40) for k in range(n))
    assert corpus_pipeline.run(spark, SF).count() == n


def test_sketches_never_reject_similar_sets():
    rng = np.random.default_rng(9)
    rejected = 0
    for _ in range(400):
        n = int(rng.integers(1, 700))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.unique(np.concatenate([a[: int(n * rng.uniform(0.6, 1))], rng.integers(0, 1 << 63, int(n * rng.uniform(0, 0.4)), dtype=np.uint64)]))
        a = np.unique(a)
        like = len(np.intersect1d(a, b)) / max(1, len(np.union1d(a, b)))
        passes = simhash.may_be_similar(simhash.sketch(a), simhash.sketch(b), len(a), len(b))
        assert passes or like < simhash.SIMILAR
        assert passes == simhash.may_be_similar(simhash.sketch(b), simhash.sketch(a), len(b), len(a))
        rejected += not passes
    assert rejected > 50


def test_near_copies_are_verified(spark, empty):
    base = [f"w{k * 7919 % 5003}" for k in range(300)]
    rows = [(0, " ".join(base)), (9, None), (None, None)]
    for k in range(1, 7):
        w = list(base)
        for j in range(k):
            w[37 * j + k] = f"edit{k}x{j}"
        rows.append((k, " ".join(w)))
    rows += [(20 + k, " ".join(f"other{k}w{j * k % 211}" for j in range(120))) for k in range(6)]
    rows.append(rows[-1])
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    texts = dict(rows)
    for k in range(1, 7):
        if simhash.similarity(texts[0].encode(), texts[k].encode()) >= 0.9:
            assert got[k] == 0
    assert all(got[20 + k] == 20 + k for k in range(6))
    kept = simhash.keep_one(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter({i for i, c in got.items() if i is not None and i == c})
    assert simhash.keep_one(empty).count() == 0


def copies(spark, texts):
    return spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def all_pairs_components(texts):
    label = list(range(len(texts)))
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS or simhash.similarity(texts[i].encode(), texts[j].encode()) >= simhash.SIMILAR:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return dict(enumerate(label))


def test_near_copies_of_one_vocabulary(spark):
    """Many texts of the same words in other orders, of which two are near copies: the first partner of a list is the wrong one."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join(rng.permutation(base)) for _ in range(40)]
    for k in (7, 23):
        w = texts[k].split()
        texts.append(" ".join(w[20:] + w[:20]))
        texts.append(" ".join(w[8:100] + w[:8] + w[100:]))
    want = all_pairs_components(texts)
    assert want[40] == 7 and want[42] == 23
    assert {r.doc_id: r.component_id for r in simhash.near_copies(copies(spark, texts)).collect()} == want


def test_near_copies_with_appended_and_cut_blocks(spark):
    """Every pair of five-word similarity 0.8 and more is found, down to the limit."""
    texts = []
    for k in range(120):
        w = [f"a{k}x{j}" for j in range(100 + 3 * k)]
        more = int(len(w) * (0.02 + 0.26 * k / 120))
        texts += [" ".join(w), " ".join(w + [f"b{k}x{j}" for j in range(more)]) if k % 2 else " ".join(w[more * 4 // 5 :])]
    want = all_pairs_components(texts)
    assert 80 < sum(i != c for i, c in want.items()) < 120
    assert {r.doc_id: r.component_id for r in simhash.near_copies(copies(spark, texts)).collect()} == want


def test_near_copies_of_members_with_one_fingerprint(spark):
    """A text that shares its fingerprint with a lesser one, but not its words, has a near copy of its own."""
    phrase = "over and over " * 400
    rests = [" ".join(f"{c}{j}" for j in range(60)) for c in "rm"]
    texts = [phrase + rests[0], phrase + rests[1], "over and over " * 2 + rests[1]]
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    assert prints[0] == prints[1] and (prints[1] ^ prints[2]).bit_count() > simhash.RADIUS
    assert simhash.similarity(texts[0].encode(), texts[2].encode()) < 0.8 <= simhash.similarity(texts[1].encode(), texts[2].encode())
    assert {r.doc_id: r.component_id for r in simhash.near_copies(copies(spark, texts)).collect()} == {0: 0, 1: 0, 2: 0}


def test_keep_one_without_ids_of_its_own(spark):
    """Rows without a doc_id and different texts under one doc_id stay; near copies and repeated rows go."""
    texts = [" ".join(f"t{k}x{j}" for j in range(60)) for k in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3]), (7, texts[4] + " end"), (None, texts[4]), (None, None), (0, texts[5])]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = Counter((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert got == Counter([(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (7, texts[4] + " end"), (None, None), (0, texts[5])])


def test_op3_keeps_whole_blocks():
    """Inline text stays in its block, short blocks laid in body stay, and a wrapper that tells of a layout is no sidebar."""
    said = "This is a sentence of the article, and it goes on for a while; then it ends. " * 4
    tidy = " ".join(said.split())
    for page, want in (
        (f"<html><body><main><div>{said}<b>it</b> more</div></main></body></html>", f"{tidy} it more"),
        (f"<html><body><div>{said}<a href=x>link</a> and, so on.</div><div>{said}</div></body></html>", f"{tidy} link and, so on.\n{tidy}"),
        (f"<html><body><h1>Title</h1><p>{said}</p><p>Short <em>one</em>.</p></body></html>", f"Title\n{tidy}\nShort one."),
        *((f"<html><body><div class='{c}'><article><p>{said}</p></article></div></body></html>", tidy) for c in ("no-sidebar", "page has-sidebar", "with-menu", "sidebar-left")),
        (f"<html><body><div class='site-sidebar'><p>{said}</p></div><article><p>{said}</p></article><div id='comments'><article><p>{said}</p></article></div></body></html>", tidy),
    ):
        assert tagpaths.main_text(page) == want
