"""Near-duplicate classes of texts: DartMinHash signatures of weighted shingles, banded, verified and joined to classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import SHINGLE_WORDS, SIMILARITY, digest, released, table, written

#: 32 bands of 4 coordinates: two texts of similarity 0.8 share no band once in 20 million times.
BANDS, ROWS = 32, 4
K = BANDS * ROWS
#: Members of a bucket up to which each is compared with each.
SMALL = 8
#: Members of larger buckets are compared with a leader, the least by one of so many hashes of the node, band by band.
ORDERS = 8
#: Members of a block of a large bucket: blocks are compared two by two, so that no task gets a whole bucket.
BLOCK = 1024
#: Shingles of a block, about, where its texts are long; a longer text is a block alone.
BLOCK_SHINGLES = 1 << 22
#: Keys of more than 1 / HOT_KEYS of all rows are fewer than that and may be broadcast; the rows of a key that is joined are dealt out to salts.
HOT_KEYS, PER_SALT = 20_000, 256
#: Rounds of stars until classes stand, at most; the number grows with the logarithm of the longest chain of links.
ROUNDS = 64
#: Stands for a missing doc_id.
LOWEST = -(2**63)
_DART = np.uint64(0x9E3779B97F4A7C15)


def elements(w: tokens.Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of the different shingles of each text in order; the weight is how often it occurs.

    A text with fewer than `size` words is one shingle, one without words has none."""
    n = len(w.text_at) - 1
    count = np.diff(w.word_at)
    text = w.text_of_word
    h = w.hashes
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    total = np.zeros(len(h), np.uint64)
    place = np.arange(len(h)) - w.word_at[:-1][text]
    for j in range(size):
        other = np.minimum(np.arange(len(h)) + j, len(h) - 1)
        inside = place + j < count[text]
        total = tokens.mix(total + np.where(inside, h[other], np.uint64(0)) + np.uint64(j + 1))
    keep = (place + size <= count[text]) | (place == 0)
    text, total = text[keep], total[keep]
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (total[1:] != total[:-1])
    at = np.flatnonzero(first)
    return text[at], total[at], np.diff(np.append(at, len(text))).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    """Values in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(float) + 1) / 2.0**53


def signatures(text: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Weighted minwise signatures of n sets: (n x k values, which sets have elements).

    Each element has darts, thrown by its hash alone, over weight x rank. Its weights are cut into regions [0, 1), [1, 2),
    [2, 4), ...; in each, darts arrive along the rank at a rate of the region's width. Those under the element's weight
    hit, each for one of k coordinates, and a coordinate keeps its earliest. Ranks up to (k ln k + 2 k) / total weight
    are thrown; where that leaves a coordinate empty, up to twice as far, and so on.
    """
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(text, weight, n)
    far = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300), 0)
    todo = total > 0
    while todo.any():
        mine = todo[text]
        t, x, w = text[mine], item[mine], weight[mine]
        found_t, found_r, found_v = [], [], []
        region, low, width = 0, 0.0, 1.0
        while len(t):
            alive_t, alive_x, alive_w = t, x, w
            rank = np.zeros(len(t))
            throw = 0
            while len(alive_t):
                base = tokens.mix(alive_x + np.uint64(int(_DART) * ((region << 32) + throw + 1) % 2**64))
                rank = rank - np.log(_unit(base)) / width
                near = rank <= far[alive_t]
                alive_t, alive_x, alive_w, rank, base = alive_t[near], alive_x[near], alive_w[near], rank[near], base[near]
                value = tokens.mix(base + _DART)
                hit = low + width * _unit(tokens.mix(value)) <= alive_w
                found_t.append(alive_t[hit] * k + (value[hit] % np.uint64(k)).astype(np.int64))
                found_r.append(rank[hit])
                found_v.append(value[hit])
                throw += 1
            low, region = (1.0, 1) if region == 0 else (low * 2, region + 1)
            width = low
            more = w > low
            t, x, w = t[more], x[more], w[more]
        slot, rank, value = np.concatenate(found_t), np.concatenate(found_r), np.concatenate(found_v)
        order = np.lexsort((rank, slot))
        slot, value = slot[order], value[order]
        at = tokens.run_starts(slot)
        full = np.bincount(slot[at] // k, minlength=n) == k
        done = todo & full
        use = done[slot[at] // k]
        out.reshape(-1)[slot[at][use]] = value[at][use]
        todo &= ~full
        far = np.where(todo, far * 2, far)
    return out, total > 0


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    rows = values.shape[1] // bands
    cut = values.reshape(len(values), bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _DART + np.zeros((len(values), 1), np.uint64)
    for j in range(rows):
        key = tokens.mix(key + cut[:, :, j])
    return key


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    offsets[1:] = np.cumsum([len(r) for r in rows])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.uint64)).cast(pa.uint64()).view(pa.int64()))


def least_matches(least: float, k: int = K) -> int:
    """Of k coordinates, how many two texts of similarity `least` share but for once in some ten million times."""
    return int(k * least - 5.5 * (k * least * (1 - least)) ** 0.5)


def banded(docs: DataFrame) -> DataFrame:
    """(id, copy, bands, sketch, size) of texts: the band keys, none for a text without words, a byte of each coordinate, and the shingles' number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[np.ndarray] = []
            sketches: list[bytes] = []
            sizes: list[int] = []
            for _, w in tokens.iter_words(batch.column(1)):
                n = len(w.text_at) - 1
                text, item, weight = elements(w)
                values, some = signatures(text, item, weight, n)
                keys = band_keys(values)
                rows += [keys[i] if some[i] else keys[i, :0] for i in range(n)]
                sketches += [x.tobytes() for x in (values >> np.uint64(56)).astype(np.uint8)]
                sizes += np.bincount(text, weight, n).astype(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), _lists(rows), pa.array(sketches, pa.binary()), pa.array(sizes, pa.int64())], ["id", "copy", "bands", "sketch", "size"])

    return docs.select("id", "text", "copy").mapInArrow(released(run), "id bigint, copy string, bands array<bigint>, sketch binary, size bigint")


def shingled(texts: DataFrame) -> DataFrame:
    """(node, items): the shingles of texts as different values, the i-th occurrence of one being a value of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[np.ndarray] = []
            for _, w in tokens.iter_words(batch.column(1)):
                text, item, weight = elements(w)
                times = weight.astype(np.int64)
                at = np.cumsum(times) - times
                which = np.arange(times.sum()) - np.repeat(at, times)
                values = np.repeat(item, times)
                values = np.where(which > 0, tokens.mix(values + which.astype(np.uint64) * _DART), values)
                owner = np.repeat(text, times)
                cuts = np.searchsorted(owner, np.arange(len(w.text_at)))
                rows += [values[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(rows)], ["node", "items"])

    return texts.select("node", "text").mapInArrow(released(run), "node bigint, items array<bigint>")


def counted(rows: DataFrame, key: str, total: int, least: int = 2) -> DataFrame:
    """rows with `n`, the number of rows of their key, where that is `least` or more.

    A key with over 1 / HOT_KEYS of `total` rows, of which there are fewer than HOT_KEYS, is looked up where its rows are;
    only the others' rows are dealt out by key."""
    sizes = written(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= least), "sizes")
    most = max(SMALL, total // HOT_KEYS)
    hot = F.broadcast(sizes.where(F.col("n") > most))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(sizes.where(F.col("n") <= most), key))


def salted(rows: DataFrame, node: str) -> DataFrame:
    """rows, which have `n`, with a `salt`: those of a key are dealt out to a salt for about PER_SALT of them."""
    salts = F.ceil(F.col("n") / PER_SALT).cast("int")
    return rows.withColumn("salt", F.pmod(F.xxhash64(node, F.lit(1)), salts).cast("int"))


def for_salts(keys: DataFrame) -> DataFrame:
    """keys, which have `n`, once for each salt."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / PER_SALT).cast("int") - 1)))


def buckets(bands: DataFrame) -> DataFrame:
    """(node, size, i, key, next, n): the buckets of more than one node, by band i, with the next band's key, the bucket's size as n and the node's as size."""
    pair = F.transform("bands", lambda k, i: F.struct(k.alias("key"), F.xxhash64(k, F.get(F.col("bands"), (i + 1) % F.size("bands"))).alias("next")))
    keys = bands.select("node", "size", F.posexplode(pair).alias("i", "k")).select("node", "size", "i", "k.key", "k.next")
    return written(counted(keys, "key", BANDS * bands.count()), "buckets")


def candidates(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes to be compared first, from buckets. Their number grows with the nodes, whatever the buckets' sizes.

    In buckets of up to SMALL members, each pair, the lesser node as b. In larger ones each member a with the bucket's
    leader b; besides, these are split by the next band's key, and the parts treated in the same way. Leaders are the
    least by a hash of the node and the band's number modulo ORDERS, so that overlapping buckets share leaders, but not
    always the same. What this leaves of larger buckets is left to crossing().
    """
    large = shared.where(F.col("n") > SMALL).select("node", "i", "key", "next", "n")
    split = large.select("node", "i", F.col("next").alias("key"))
    split = written(counted(split, "key", large.count()), "parts")
    few = shared.where(F.col("n") <= SMALL).select("node", "key").unionByName(split.where(F.col("n") <= SMALL).select("node", "key"))
    members = few.groupBy("key").agg(F.collect_list("node").alias("m"))
    pairs = members.select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b")).where("b < a")
    many = large.select("node", "i", "key", "n").unionByName(split.where(F.col("n") > SMALL).select("node", "i", "key", "n"))
    leaders = many.groupBy("key", "n").agg(F.min(F.struct(F.xxhash64("node", F.col("i") % ORDERS).alias("h"), F.col("node").alias("leader"))).alias("l"))
    leaders = for_salts(leaders.select("key", "n", "l.leader")).drop("n")
    starred = salted(many, "node").join(leaders, ["key", "salt"]).where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    return pairs.unionByName(starred).distinct()


def resembles(a: Column, b: Column, least: float = SIMILARITY) -> Column:
    """Whether the weighted Jaccard similarity of two lists of different values is at least `least`."""
    common = F.size(F.array_intersect(a, b))
    bounded = F.least(F.size(a), F.size(b)) >= least * F.greatest(F.size(a), F.size(b))
    return bounded & (common >= least * (F.size(a) + F.size(b) - common))


def shingles_of(rows: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The shingles of the nodes in pairs. rows has the texts, nodes the first id of each text."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    asked = nodes.join(asked, "node", "left_semi").select(F.col("first").alias("id"), "copy", "node")
    # the only time that texts are dealt out; rows that repeat both id and text count once
    texts = rows.join(asked.hint("merge"), ["id", "copy"]).dropDuplicates(["id", "copy"])
    return written(shingled(texts), "shingles")


def linked(items: DataFrame, pairs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) that are similar, by their whole shingle multisets. The pairs of one b are dealt out by salts, to each of which
    b's shingles go once."""
    pairs = written(counted(pairs, "b", pairs.count(), 1), "counted")
    items_of = lambda c: items.select(F.col("node").alias(c), F.col("items").alias(f"{c}_items"))
    b_items = for_salts(pairs.select("b", "n").distinct()).drop("n").join(items_of("b"), "b")
    both = salted(pairs, "a").join(items_of("a"), "a").join(b_items, ["b", "salt"])
    return both.where(resembles(F.col("a_items"), F.col("b_items"), least)).select("a", "b")


def paired_blocks(shared: DataFrame, texts: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets of more than SMALL members in which classes are still apart, in pairs of blocks (key, p, q): as `left` those
    outside the largest class, in block p, and all of them in block q. A block is bounded by its members and by their shingles.

    A node is a member of BANDS buckets at most; what is compared of it is put together once and joined to its members once."""
    large = shared.where(F.col("n") > SMALL).select("key", "i", "n", "node", "size").join(found, "node", "left")
    large = written(large.withColumn("root", F.coalesce("root", "node")), "members")
    by_class = large.groupBy("key", "root", "n").agg(F.count("*").alias("m"), F.sum("size").alias("shingles"))
    mixed = by_class.groupBy("key", "n").agg(F.max(F.struct("m", "root", "shingles")).alias("top"), F.sum("shingles").alias("shingles")).where("top.m < n")
    blocks = lambda n, shingles: F.least(n, F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))).cast("int")
    mixed = mixed.withColumn("ps", blocks(F.col("n") - F.col("top.m"), F.col("shingles") - F.col("top.shingles"))).withColumn("qs", blocks(F.col("n"), F.col("shingles")))
    mixed = for_salts(mixed).select("key", "salt", F.col("top.root").alias("top"), "ps", "qs")
    members = salted(large, "node").join(mixed, ["key", "salt"]).drop("salt")
    members = members.join(texts.select("node", "bands", "sketch").join(items, "node"), "node")
    block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda p, q, left: F.struct(p.alias("p"), q.alias("q"), F.lit(left).alias("left"))
    lefts = F.when(F.col("root") != F.col("top"), F.transform(every("qs"), lambda q: place(F.col("p"), q, True))).otherwise(F.array().cast("array<struct<p:int,q:int,left:boolean>>"))
    rights = F.transform(every("ps"), lambda p: place(p, F.col("q"), False))
    members = members.withColumn("p", block("ps")).withColumn("q", block("qs")).withColumn("places", F.concat(lefts, rights))
    side = ["i", "node", "root", "top", "size", "bands", "sketch", "items"]
    return members.select("key", F.explode("places").alias("at"), *side).select("key", "at.*", *side)


def crossing(shared: DataFrame, texts: DataFrame, items: DataFrame, found: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links (a, b) that join what classes are still apart in buckets of more than SMALL members: all that candidates() may have left.

    Members outside a bucket's largest class are compared with all members. A pair counts in the first band that it
    shares; where that bucket is small, it was compared. Pairs go whose sizes or whose sketches rule `least` out; the
    others are compared by their whole shingle multisets, unless links of the same block have joined them. Both sides are
    cut into blocks, each two blocks are compared on their own, and pairs are never rows.
    """
    enough = least_matches(least)

    def compare(t: pa.Table) -> pa.Table:
        node, root, size, is_left = (t[c].to_numpy() for c in ("node", "root", "size", "left"))
        root = root.copy()
        i, top = t["i"][0].as_py(), t["top"][0].as_py()
        outside = root != top
        keys = t["bands"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)[:, :i]
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(node), -1)
        lists = t["items"].combine_chunks()
        at, kinds = lists.offsets.to_numpy() - lists.offsets[0].as_py(), np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
        mark = np.zeros(len(kinds) + 1, bool)
        links: list[tuple[int, int]] = []
        right = np.flatnonzero(~is_left)
        for x in np.flatnonzero(is_left).tolist():
            y = right[(root[right] != root[x]) & (np.minimum(size[right], size[x]) >= least * np.maximum(size[right], size[x]))]
            # two members outside the largest class meet twice
            y = y[~outside[y] | (node[y] > node[x])]
            y = y[(sketch[y] == sketch[x]).sum(1) >= enough]
            y = y[~(keys[y] == keys[x]).any(1)]
            if not len(y):
                continue
            own = kinds[at[x] : at[x + 1]]
            mark[own] = True
            for k in y.tolist():
                if root[k] == root[x]:
                    continue
                common = np.count_nonzero(mark[kinds[at[k] : at[k + 1]]])
                if common >= least * (size[x] + size[k] - common):
                    links.append((int(node[x]), int(node[k])))
                    root[root == root[k]] = root[x]
            mark[own] = False
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return paired_blocks(shared, texts, items, found).groupBy("key", "p", "q").applyInArrow(compare, "a bigint, b bigint")


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge that isn't the least of its component: alternates large and small stars until only stars are left."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")
    for _ in range(ROUNDS):
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
        tangled = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n")).where("ups > 1 OR ups = 1 AND n > 1")
        if tangled.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
    raise RuntimeError(f"classes of near copies don't stand after {ROUNDS} rounds")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge: root is the least node of its component."""
    found = stars(edges)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def _members(docs: DataFrame, least: float) -> DataFrame:
    """(id, copy, class_id, kept) for each row of docs: its doc_id or LOWEST, its text's digest, its class, and whether the class keeps it."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("id"), F.coalesce("text", F.lit("")).alias("text"), digest(F.col("text")).alias("copy"))
    signed = written(banded(rows), "bands")
    first = F.coalesce(F.min(F.when(F.col("id") > LOWEST, F.col("id"))), F.lit(LOWEST))
    # a node is a text, numbered once
    texts = signed.groupBy("copy").agg(first.alias("first"), *[F.first(c).alias(c) for c in ("bands", "sketch", "size")])
    texts = written(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    shared = buckets(texts)
    pairs = written(candidates(shared), "pairs")
    items = shingles_of(rows, texts, pairs)
    found = stars(linked(items, pairs, least))
    # each node of a large bucket was compared with a leader, so that its shingles are there
    more = written(crossing(shared, texts, items, found, least), "links")
    if not more.isEmpty():
        found = stars(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    texts = texts.join(found, "node", "left").select("copy", "first", F.coalesce("root", "node").alias("root"))
    heads = texts.groupBy("root").agg(F.min(F.struct((F.col("first") == LOWEST).alias("none"), "first", "copy")).alias("h"))
    heads = written(heads.select("root", "h.none", F.col("h.first").alias("head"), F.col("h.copy").alias("head_copy")), "heads")
    # a doc_id names one class; others that begin with it and those without any are named by a negative number
    owners = heads.where("NOT none").groupBy("head").agg(F.min("head_copy").alias("owner"))
    made = F.lit(-2) - F.xxhash64("head_copy").bitwiseAND(F.lit(2**62 - 1))
    named = heads.where("NOT none").join(owners, "head").select("root", "head", "head_copy", F.when(F.col("head_copy") == F.col("owner"), F.col("head")).otherwise(made).alias("class_id"))
    named = named.unionByName(heads.where("none").select("root", "head", "head_copy", made.alias("class_id")))
    texts = texts.join(named, "root").select("copy", "head", "head_copy", "class_id")
    out = signed.select("id", "copy").join(texts, "copy")
    return out.select("id", "copy", "class_id", ((F.col("id") == F.col("head")) & (F.col("copy") == F.col("head_copy"))).alias("kept"))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and kept (whether it is that) for each row of docs.

    Texts are linked if the weighted Jaccard similarity of their five-word shingles is at least `least`; classes are
    what links connect. Equal texts are in one class; null texts are empty ones. Texts without words match only equal
    texts. A doc_id joins no texts: rows without one, and rows that repeat one, are in the classes of their texts. A
    class in which no row has a doc_id, or whose least doc_id is that of another class too, is named by a negative
    number made of a text. Of rows with the same text and doc_id all are marked; one is kept by callers that need one.
    """
    return _members(docs, least).select(F.when(F.col("id") > LOWEST, F.col("id")).alias("doc_id"), "class_id", "kept")


def kept(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The first document of each class, with its columns as they were; of rows with one doc_id and text, one."""
    first = _members(docs, least).where("kept").select(F.when(F.col("id") > LOWEST, F.col("id")).alias("_id"), F.col("copy").alias("_first")).distinct()
    own = docs.withColumn("_own", digest(F.col("text")))
    return own.join(first, F.equal_null(own["doc_id"], first["_id"]) & (own["_own"] == first["_first"]), "left_semi").dropDuplicates(["doc_id", "_own"]).drop("_own")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


QUERIES = {"op2_near_dedup": op2_near_dedup}
ORACLES: dict[str, str] = {}
