"""SimHash near-duplicates through a byte-position index with count filtering.

Fingerprints that differ in at most ``RADIUS`` = 2 bits differ in at most two of
their eight positional bytes, so the guaranteed minimum of shared positional
bytes is six.  Lists on single positions would hold a 256th of all rows each;
the index therefore posts every distinct fingerprint under each of the 28
choices of six positions, which retains exactly the pairs whose tally reaches
the minimum.  A posting list leaves two bytes free, so it holds at most 65,536
distinct fingerprints, however large a group of near copies is; its pairs are
verified by their bits and linked by local components, a row per member at most.
Copies collapse to one fingerprint before the index.

Defined cases: null texts and texts without words have fingerprint zero and are
linked like any other; fewer words than three make one shingle; repeated rows
stay, each with its row; a null doc_id never represents a group that has another
id; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import checkpoint, mix64, slices
from isohyet.llm.graph import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 2
CHOICES = tuple(combinations(range(8), 6))
#: Lists of up to so many members compare by shifted slices, larger ones by looking up every neighbour.
SMALL_LIST = 24
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text in UTF-8; strict majority of shingles, repeats counted."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary())
        prints = np.fromiter((fingerprint(x.as_py() or b"") for x in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        parts = np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8)
        for number, at in enumerate(CHOICES):
            key = np.zeros((len(fp), 8), np.uint8)
            key[:, 7] = number
            key[:, :6] = parts[:, at]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).reshape(-1)), batch.column("fp"), batch.column("rep")], ["key", "fp", "rep"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS


def _wide_pairs(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one long list, by looking up the neighbours of every member over the bits that vary in it."""
    vary = int(np.bitwise_or.reduce((fp ^ fp[0]).view(np.uint64)))
    bits = [np.uint64(1 << b) for b in range(64) if vary >> b & 1]
    flips = [*bits, *(x | y for x, y in combinations(bits, 2))]
    sorted_fp = np.sort(fp.view(np.uint64))
    order = np.argsort(fp.view(np.uint64))
    left, right = [], []
    for flip in flips:
        want = sorted_fp ^ flip
        at = np.minimum(np.searchsorted(sorted_fp, want), len(fp) - 1)
        hit = (sorted_fp[at] == want) & (sorted_fp < want)
        left.append(order[hit])
        right.append(order[at[hit]])
    return np.concatenate(left), np.concatenate(right)


def _links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from members to the least representative of their component in each list; whole lists, sorted by key."""
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(new, len(key)))
    many = np.repeat(size > 1, size)
    key, fp, rep = key[many], fp[many], rep[many]
    size = size[size > 1]
    if not len(size):
        return rep[:0], rep[:0]
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    left, right = [], []
    small = np.repeat(size <= SMALL_LIST, size)
    for step in range(1, min(SMALL_LIST, int(size.max()))):
        at = np.flatnonzero((key[step:] == key[:-step]) & small[:-step])
        at = at[_near(fp[at], fp[at + step])]
        left.append(at)
        right.append(at + step)
    for k in np.flatnonzero(size > SMALL_LIST):
        a, b = _wide_pairs(fp[begin[k] : begin[k] + size[k]])
        left.append(a + begin[k])
        right.append(b + begin[k])
    i, j = np.concatenate(left), np.concatenate(right)
    label = rep.copy()
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        if (label == before).all():
            break
    off = label != rep
    pairs = np.unique(np.stack([rep[off], label[off]]), axis=1)
    return pairs[0], pairs[1]


def _by_list(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], links: Callable[..., tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, the first name; the last list of a batch waits for the next one."""
    wait: list[np.ndarray] = []
    for batch in batches:
        got = [batch.column(n).to_numpy() for n in names]
        if not len(got[0]):
            continue
        got = [np.concatenate(x) for x in zip(wait, got, strict=True)] if wait else got
        cut = np.searchsorted(got[0], got[0][-1])
        wait = [x[cut:] for x in got]
        if cut:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in links(*[x[:cut] for x in got])], ["a", "b"])
    if wait:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in links(*wait)], ["a", "b"])


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _by_list(batches, ("key", "fp", "rep"), _links)


def near_fingerprints(reps: DataFrame) -> DataFrame:
    """Edges (a, b) between the ids of reps (fp, rep), of fingerprints of at most RADIUS bits; a row per member and list at most."""
    posted = reps.filter("rep is not null").mapInArrow(_postings, "key long, fp long, rep long")
    return posted.repartition("key").sortWithinPartitions("key").mapInArrow(_link, "a long, b long")


def linked(prints: DataFrame) -> DataFrame:
    """prints (doc_id, fp) with component_id, the least doc_id reachable by links of at most RADIUS bits."""
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = connected_components(near_fingerprints(reps))
    groups = reps.join(found, reps["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = checkpoint(fingerprints(docs))
    return linked(prints).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# The stage: near copies of five-word shingles as well ------------------------------------------

#: The verified similarity of sets of shingles.
SIMILAR, WORDS_A_SHINGLE = 0.8, 5
#: Candidate pairs up to this many are broadcast to the texts (16 bytes each); beyond, the join is shuffled.
BROADCAST_PAIRS = 1_000_000
#: One text in so many is read for common shingles, of which so many are held at most (16 bytes each).
SAMPLE, COMMON = 16, 500_000
#: The growth, round by round, of the places up to which members of a list meet.
STEPS = 64


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard measure of the sets of five-word shingles; a shorter text is one shingle."""
    made = []
    for text in (a, b):
        words = text.lower().split()
        made.append(set(zip(*[words[k:] for k in range(WORDS_A_SHINGLE)], strict=False)) if len(words) >= WORDS_A_SHINGLE else {tuple(words)})
    return len(made[0] & made[1]) / len(made[0] | made[1])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [[x or b"" for x in batch.column(n).cast(pa.binary()).to_pylist()] for n in ("text_a", "text_b")]
        good = pa.array([similarity(a, b) >= SIMILAR for a, b in zip(*texts, strict=True)], pa.bool_())
        yield batch.select(["a", "b"]).filter(good)


def shingle_hashes(text: bytes) -> np.ndarray:
    """Sorted hashes of the set of five-word shingles that ``similarity`` compares."""
    words = text.lower().split()
    if not words:
        return np.zeros(1, np.uint64)
    base = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(WORDS_A_SHINGLE, len(words))
    found = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        found = mix64(found + base[k : k + len(found)])
    return np.unique(found)


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of a set in as many bits as it has members (a power of two, 64 at least): bit h mod m changes with every member h."""
    m = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_be_similar(a: bytes, b: bytes, size_a: int, size_b: int) -> bool:
    """False only for sets that cannot reach SIMILAR.

    Each member that one set alone holds changes one parity, so the parities differ
    in no more places than the sets have such members, and sets of SIMILAR = 4/5
    have a ninth of their sizes together at most.  The longer sketch folds to the
    shorter one.
    """
    x, y = (int.from_bytes(v, "little") for v in (a, b))
    bits = [8 * len(a), 8 * len(b)]
    while bits[0] != bits[1]:
        k = int(bits[1] > bits[0])
        bits[k] //= 2
        low = (1 << bits[k]) - 1
        x, y = ((x >> bits[0]) ^ (x & low), y) if not k else (x, (y >> bits[1]) ^ (y & low))
    return 9 * (x ^ y).bit_count() <= size_a + size_b


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("sketch_a", "sketch_b", "size_a", "size_b")]
        good = [may_be_similar(*x) for x in zip(*columns, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def prefix(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles under which a set is posted, rare ones first, and how many of them it is posted under as the smaller set of a pair.

    A pair of SIMILAR = 4/5 shares 4/5 of the larger and 8/9 of the smaller set at
    least.  Under any one order of all shingles, the larger set's first n - 4n/5 + 1
    and the smaller set's first n - 8n/9 + 1 therefore have a shingle in common.
    """
    n = len(hashes)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        hashes = hashes[np.lexsort((hashes, np.where(common[at] == hashes, counts[at], 0)))]
    return hashes[: n + (-4 * n) // 5 + 1], n + (-8 * n) // 9 + 1


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [shingle_hashes(x.as_py() or b"") for x in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64))], ["h"])


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most common shingles in a sample of the texts; they only set the order, so that a sample will do."""
    counted = texts.filter(F.pmod("node", F.lit(SAMPLE)) == 0).select("text").mapInArrow(_sampled, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    counted = checkpoint(counted.filter("n > 2"))
    least = 2
    while counted.filter(f"n > {least}").count() > COMMON:
        least *= 2
    got = counted.filter(f"n > {least}").toArrow()
    hashes, counts = got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def prefix_postings(texts: DataFrame) -> DataFrame:
    """key (a shingle of the prefix), node, size (twice the number of shingles, plus one where the smaller set of a pair is posted)."""
    sent = texts.sparkSession.sparkContext.broadcast(common_shingles(texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            keys, sizes, many = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
            for x in batch.column("text").cast(pa.binary()):
                hashes = shingle_hashes(x.as_py() or b"")
                key, short = prefix(hashes, *sent.value)
                keys.append(key)
                sizes.append(2 * len(hashes) + (np.arange(len(key)) < short))
                many.append(len(key))
            node = np.repeat(batch.column("node").to_numpy(), many)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(node), pa.array(np.concatenate(sizes).astype(np.int32))], ["key", "node", "size"])

    return texts.select("node", "text").mapInArrow(work, "key long, node long, size int")


def _lists(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Columns of whole lists, from rows that are sorted by key, the first name."""
    wait: list[list[np.ndarray]] = []
    for batch in batches:
        got = [batch.column(n).to_numpy() for n in names]
        if not len(got[0]):
            continue
        if wait and got[0][-1] == wait[-1][0][-1]:
            cut = np.searchsorted(got[0], got[0][-1])
            if not cut:
                wait.append(got)
                continue
        cut = np.searchsorted(got[0], got[0][-1])
        if wait or cut:
            whole = [np.concatenate(x) for x in zip(*wait, [g[:cut] for g in got], strict=True)]
            if len(whole[0]):
                yield whole
        wait = [[g[cut:] for g in got]]
    if wait:
        yield [np.concatenate(x) for x in zip(*wait, strict=True)]


def _spans(key: np.ndarray) -> np.ndarray:
    """The length of each row's list."""
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(new, len(key)))
    return np.repeat(size, size)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of more than one node, each node once, in the order of sizes; rows come sorted by key and node."""
    for key, node, size in _lists(batches, ("key", "node", "size")):
        once = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node, size = key[once], node[once], size[once]
        order = np.lexsort((node, size, key))
        key, node, size = key[order], node[order], size[order]
        many = _spans(key) > 1
        yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (key, node, size)], ["key", "node", "size"])


def _open(key: np.ndarray, component: np.ndarray) -> np.ndarray:
    """The length of each row's list, 0 where all of it is one component."""
    spans = _spans(key)
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    mixed = np.minimum.reduceat(component, begin) != np.maximum.reduceat(component, begin)
    return np.where(np.repeat(mixed, spans[begin]), spans, 0)


def _longest_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    most = max((int(_open(key, component).max()) for key, component in _lists(batches, ("key", "component"))), default=0)
    yield pa.RecordBatch.from_arrays([pa.array([most], pa.int64())], ["n"])


def candidates(done: int, upto: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of a list more than ``done`` and at most ``upto`` apart, of different components, that may reach SIMILAR by their sizes.

    With ``upto`` = 0, each member with the least node of its list.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, size, component in _lists(batches, ("key", "node", "size", "component")):
            open_ = _open(key, component) > done + 1
            key, node, size, component = (x[open_] for x in (key, node, size, component))
            if not len(key):
                continue
            count, small = size.astype(np.int64) >> 1, size & 1
            if not upto:
                begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                lead = np.repeat(np.lexsort((node, key))[begin], _spans(key)[begin])
                at = np.flatnonzero((component != component[lead]) & (5 * np.minimum(count, count[lead]) >= 4 * np.maximum(count, count[lead])))
                yield _pairs([node[at]], [node[lead[at]]])
                continue
            left, right, held = [], [], 0
            for step in range(done + 1, min(upto + 1, int(_spans(key).max()))):
                at = np.flatnonzero((key[step:] == key[:-step]) & (component[step:] != component[:-step]) & (small[:-step] == 1) & (5 * count[:-step] >= 4 * count[step:]))
                left.append(node[at])
                right.append(node[at + step])
                held += len(at)
                if held > 1 << 20:
                    yield _pairs(left, right)
                    left, right, held = [], [], 0
            if held:
                yield _pairs(left, right)

    return work


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _beside(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """pairs (a, b) with the columns of table (node, ...) for either side; only rows of pairs are shuffled."""
    few = pairs.count() <= BROADCAST_PAIRS
    told = F.broadcast(pairs) if few else pairs
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    held = table.select("node", *columns).join(F.broadcast(nodes) if few else nodes, "node", "left_semi").dropDuplicates(["node"])
    sides = [held.select(F.col("node").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in columns]).join(told, n) for n in ("a", "b")]
    return sides[0].join(sides[1], ["a", "b"])


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach SIMILAR, of docs (node, text); texts travel only for pairs that their sketches let pass."""
    hopeful = checkpoint(_beside(pairs, nodes, ["sketch", "size"]).mapInArrow(_hopeful, "a long, b long"))
    return _beside(hopeful, docs, ["text"]).select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def _node_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [x.as_py() or b"" for x in batch.column("text").cast(pa.binary())]
        prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
        sets = [shingle_hashes(x) for x in texts]
        made = [pa.array(prints.view(np.int64)), pa.array([len(x) for x in sets], pa.int32()), pa.array([sketch(x) for x in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("doc_id"), *made], ["node", "doc_id", "fp", "size", "sketch"])


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (node, doc_id, fp), where a node is the 64-bit hash of a text, and node, component of every distinct text.

    Distinct texts are linked by fingerprints of at most RADIUS bits and by
    verified five-word similarity.  Candidates come from an exact rule (see
    ``prefix``): texts meet in the lists of their rarest shingles, where every
    pair is verified unless it has come into one component before.  First each
    member meets the least of its list, then those up to 64, 4096, ... places apart
    in the order of sizes; so a large group of near copies costs a few pairs a
    member, and only lists that still hold several components go on.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("node", F.xxhash64("text"))
    rows = checkpoint(docs.mapInArrow(_node_prints, "node long, doc_id long, fp long, size int, sketch binary"))
    first = F.min(F.struct("fp", "size", "sketch")).alias("of")
    nodes = checkpoint(rows.groupBy("node").agg(F.min("doc_id").alias("least"), first, F.count(F.lit(1)).alias("n")).select("node", "least", "n", "of.*"))
    reps = nodes.groupBy("fp").agg(F.min("node").alias("rep"))
    same = nodes.join(reps, "fp").filter("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    copied = nodes.filter("n > 1").select(F.col("node").alias("_node"), F.col("least").alias("_least"))
    copied = F.broadcast(copied) if copied.count() <= BROADCAST_PAIRS else copied
    texts = docs.join(copied, F.col("node") == F.col("_node"), "left").filter("_node is null or doc_id <=> _least").select("node", "text")
    lists = checkpoint(prefix_postings(texts).repartition("key").sortWithinPartitions("key", "node").mapInArrow(_shared, "key long, node long, size int"))
    links = near_fingerprints(reps).unionByName(same)
    component, tested, done, upto = None, None, 0, 0
    while True:
        if component is None:
            told = lists.withColumn("component", F.col("node"))
        else:
            joined = component.filter("node <> component")
            few = joined.count() <= BROADCAST_PAIRS
            told = lists.join(F.broadcast(joined) if few else joined, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("component"))
            if not few:  # a broadcast side leaves the lists whole and in order
                told = told.repartition("key").sortWithinPartitions("key", "size", "node")
            if (told.mapInArrow(_longest_open, "n long").agg(F.max("n")).first()[0] or 0) <= done + 1:
                return rows, component
        pairs = told.mapInArrow(candidates(done, upto), "a long, b long").distinct()
        pairs = checkpoint(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        tested = pairs if tested is None else tested.unionByName(pairs)
        good = verified(docs, nodes, pairs)
        if component is None:
            found = connected_components(links.unionByName(good))
            component = checkpoint(nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
        else:
            of = lambda n: component.select(F.col("node").alias(n), F.col("component").alias(f"_{n}"))
            between = checkpoint(good.join(of("a"), "a").join(of("b"), "b").select("_a", "_b"))
            if not between.isEmpty():
                found = connected_components(between, "_a", "_b").select(F.col("node").alias("component"), F.col("component").alias("_to"))
                component = checkpoint(component.join(found, "component", "left").select("node", F.coalesce("_to", "component").alias("component")))
        done, upto = upto, STEPS * max(upto, 1)


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id of every row and component_id, the least doc_id of its group of near copies (see ``grouped``)."""
    rows, component = grouped(docs)
    least = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(component, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(component.join(least, "component").select("node", "component_id"), "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the least doc_id of each group of near copies (one row, if the row repeats).

    Rows are told apart by doc_id and text together, so that rows without a
    doc_id, and different texts under one doc_id, stay unless they are near
    copies; a row without a doc_id stands for a group where no row has one.
    """
    rows, component = grouped(docs)
    row = [F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("node").alias("_node")]
    least = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(component, "node")
    kept = least.groupBy("component").agg(F.min(F.struct(*row)).alias("row")).select("row.*")
    own = F.col("doc_id").cast("long")
    keyed = docs.withColumns({"_none": own.isNull(), "_id": F.coalesce(own, F.lit(0)), "_node": F.xxhash64("text")})
    names = ["_none", "_id", "_node"]
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).drop(*names)
