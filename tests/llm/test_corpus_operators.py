"""Near copies, page text, classifier, language model and pipeline on small tables, against brute force or held-out rows."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import mixing, near_dedup, ngram_trie, page_text, quality_trees, tokens

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, copy string, key string, class string, x bigint"
VOCABULARY = [f"word{i}" for i in range(400)]


def table(texts, ids=None):
    return [(i, t, "en", f"s{k % 3}", len(t or ""), 1, "c", "k", "cl", 2) for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts))]


def prose(r, n):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def multiset(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def expected(texts, least=0.8):
    sets, root = [multiset(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if (texts[i] or "") == (texts[j] or "") or sets[i] and sets[j] and similarity(sets[i], sets[j]) >= least:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(texts))]


def corpus():
    r = random.Random(11)
    texts = [None, "", "", " \n", "a b", "a b", "a b c"]
    shared = prose(r, 120)
    for k in range(12):
        base = prose(r, r.choice([30, 120, 600]))
        texts += [base] * r.choice([1, 2])
        for _ in range(r.randrange(4)):
            w = base.split()
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        texts.append(f"{prose(r, 100)} {shared} {prose(r, 40)}")
    base = prose(r, 300).split()
    for k in range(60):  # a large group of near copies, in which buckets are split
        w = list(base)
        w[k * 5] = f"edit{k}"
        texts.append(" ".join(w))
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r for r in near_dedup.classes(spark.createDataFrame(table(texts), SCHEMA).repartition(3)).collect()}
    want = expected(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    assert [got[i].kept for i in range(len(texts))] == [w == i for i, w in enumerate(want)]


def test_kept_documents(spark):
    d = spark.createDataFrame(table(["a b c d e f", "a b c d e f", "other words here", None, "a b c d e f"], [5, 3, 9, None, 5]), SCHEMA)
    out = near_dedup.kept(d)
    assert out.columns == d.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 3), (False, 9), (True, 0)]
    assert near_dedup.kept(d.limit(0)).count() == 0 and near_dedup.classes(d.limit(0)).count() == 0


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(4)
    item = r.integers(0, 2**63, 300).astype(np.uint64)
    a, b = r.integers(1, 9, 300).astype(float), r.integers(1, 9, 300).astype(float)
    k = 2048
    values, some = near_dedup.signatures(np.repeat([0, 1], 300), np.concatenate([item, item]), np.concatenate([a, b]), 3, k)
    assert some.tolist() == [True, True, False]
    assert abs((values[0] == values[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05
    alone, _ = near_dedup.signatures(np.zeros(300, int), item, b, 1, k)
    assert (alone[0] == values[1]).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(300, 200), (250, 300)]
    got = dict(tuple(r) for r in near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in (200, 250, 300)}
    assert near_dedup.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(6)
    for _ in range(300):
        a, b = ([r.randrange(6) for _ in range(r.randrange(14))] for _ in "ab")
        got = sorted(page_text.shared(a, b))
        it = iter(b)
        assert len(got) == lcs(a, b) and all(a[i] in it for i in got)


PAGE = "<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li>Menu</ul></nav><div class=\"cookie-notice\">Accept</div>{body}<div id=comments><p>Nice!</p></div><form>Mail <input></form><aside>Side</aside><footer>&copy; x</footer></body></html>"


def test_page_text(spark):
    article = "<article><header><h1>A &amp; B</h1></header><p>One\n  two<br>three<p>Four <b>five</b> &lt;six&gt;&nbsp;</p><div class=ad>Buy</div><aside>no</aside><script>x</script></article>"
    plain = "<div>Site name</div><p>{0}</p><div>Links below</div><p>{0} again</p>"
    data = [
        (1, "http://a.example/x/1", PAGE.format(body=article)), (2, "http://b.example/p/1.html", PAGE.format(body=plain.format("first"))), (3, "https://b.example/p/2?utm=1#t", PAGE.format(body=plain.format("second"))),
        (4, "http://c.example/", PAGE.format(body=plain.format("alone"))), (5, None, None), (6, "", ""), (7, "http://d.example/z", "text & more < 3 <p>unclosed <b>bold"), (3, "https://b.example/p/2?utm=1#t", PAGE.format(body=plain.format("second"))),
    ]
    d = spark.createDataFrame([(*x, "a", 1) for x in data], "page_id bigint, url string, html string, text string, _key int").repartition(3)
    got = {}
    for r in page_text.extracted(d).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == ["A & B\nOne two\nthree\nFour five <six>"]
    assert got[2] == ["first\nfirst again"]
    assert got[4] == ["Site name\nalone\nLinks below\nalone again"]
    assert got[5] == [""] and got[6] == [""] and len(got[3]) == 2
    assert got[7] == ["text & more < 3\nunclosed bold"]
    assert page_text.extracted(d.limit(0)).count() == 0


def test_trees_learn_and_hold_out(spark):
    r = random.Random(8)
    texts = [prose(r, 80).capitalize() + "." if i % 3 else " | ".join(prose(r, 60).split()) for i in range(600)] + [None, "", "x"]
    d = spark.createDataFrame(table(texts), SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(5, None, None), (None, 1, 0), (9999, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    trees = quality_trees.learned(d, labels)
    got = {x.doc_id: x.score for x in quality_trees.scored(d, trees).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] >= 0.3) == (i % 3 > 0) for i in held)
    assert len(got) == len(texts) and all(0 <= s <= 1 for s in got.values())
    kept = quality_trees.kept(d, trees)
    assert kept.columns == d.columns and {x.doc_id for x in kept.collect()} == {i for i, s in got.items() if s >= 0.3}
    one = quality_trees.learned(d, labels.where("quality = 1"))
    assert quality_trees.scored(d.limit(0), quality_trees.learned(d, labels.limit(0))).count() == 0 and one.depth == 0


def test_trees_traverse_as_one_by_one():
    r = np.random.default_rng(3)
    x = r.normal(size=(500, 5))
    trees = quality_trees.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=20)

    def walk(row, node):
        while trees.left[node] != node:
            node = trees.left[node] + (row[trees.feature[node]] > trees.cut[node])
        return trees.value[node]

    want = [trees.start + sum(walk(row, n) for n in trees.roots) for row in x[:50]]
    assert np.allclose(trees.margins(x[:50]), want)


def test_elias_fano_finds_what_it_holds():
    r = np.random.default_rng(1)
    for n, u in ((0, 5), (1, 10), (1000, 5000), (1000, 2**60), (5000, 5000), (3, 2**40)):
        v = np.sort(r.choice(u, n, replace=False) if u < 10**6 else r.integers(0, u, n)).astype(np.uint64)
        s = ngram_trie.EliasFano.of(v, u)
        assert (s.find(v) == np.arange(n)).all() and (s.at(np.arange(n)) == v).all()
        other = np.setdiff1d(r.integers(0, u, 500).astype(np.uint64), v)
        assert (s.find(other) == -1).all()


def test_language_model_equals_brute_force(spark):
    r = random.Random(12)
    texts = [None, "", "Ä b", " \t", "never seen words"] + [prose(r, r.choice([1, 2, 50, 300])).title() for _ in range(60)]
    d = spark.createDataFrame(table(texts), SCHEMA).repartition(3)
    train = d.where(~ngram_trie.held_out(d))
    model = ngram_trie.trained(train)
    got = {x.doc_id: x for x in ngram_trie.scored(d, model).collect()}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    seqs = [["<b>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), "</e>"] for t in texts]
    mine = [s for i, s in enumerate(seqs) if zlib.crc32(str(i).encode()) % 7 != 2]
    one, two, three = (Counter(tuple(s[k : k + n]) for s in mine for k in range(len(s) - n + 1)) for n in (1, 2, 3))
    total, kinds = sum(c for k, c in one.items() if k != ("<b>",)), len(one) - 1
    prior = lambda c: ngram_trie.FACTOR * c**ngram_trie.POWER
    off = lambda n: ngram_trie.DISCOUNTS[min(n, 3) - 1]
    cut = lambda p: 10 ** (-ngram_trie.STEP * math.ceil(-math.log10(p) / ngram_trie.STEP - 1e-9))
    left = Counter()
    for k, n in three.items():
        left[k[:2]] += off(n)
    for i, s in enumerate(seqs):
        base = score = 0
        for k in range(1, len(s)):
            p = (one[(s[k],)] + 1) / (total + kinds + 1)
            base += math.log10(p)
            if c := one[(s[k - 1],)]:
                n = two[tuple(s[k - 1 : k + 1])]
                p = p * (1 - c / (c + prior(c))) + (cut(n / (c + prior(c))) if n else 0)
            if k > 1 and (c := two[tuple(s[k - 2 : k])]):
                n = three[tuple(s[k - 2 : k + 1])]
                p = p * cut(left[tuple(s[k - 2 : k])] / c) + (cut((n - off(n)) / c) if n else 0)
            score += math.log10(p)
        x = got[i]
        assert (x.n_tokens, x.n_known) == (len(s) - 1, sum((w,) in one for w in s[1:])) and model.n_tokens == total
        assert x.base_score == pytest.approx(base) and x.score == pytest.approx(score)
    nothing = ngram_trie.trained(train.limit(0))
    assert {x.base_score for x in ngram_trie.scored(d, nothing).collect()} == {0.0}
    assert ngram_trie.scored(d.limit(0), nothing).count() == 0


def test_words_have_their_own_hashes():
    texts = pa.array(["Ab ab", None, "", "ab\x0bÄ", "x" * 3_000_000 + " ab"])
    seen = {}
    for i, w in tokens.iter_words(texts):
        for k, (a, b) in enumerate(zip(w.start, w.end)):
            word = bytes(w.raw[a:b])
            assert seen.setdefault(word, w.hashes[k]) == w.hashes[k]
    assert len(seen) == len(set(seen.values())) == 4


def test_pipeline_runs_in_order(spark, tmp_path):
    r = random.Random(21)
    function = "the of and to in a is that".split()
    clean = [" ".join(r.choice(function) if r.random() < 0.3 else r.choice(VOCABULARY) for _ in range(120)) for _ in range(60)]
    texts = clean + [clean[0], clean[1] + " end"] + [" | ".join(prose(r, 60).split()) for _ in range(20)] + [None, "", "short"]
    spark.createDataFrame(table(texts), SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 62), 0) for i in range(len(texts))], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    left = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "sentencepiece":
            assert docs.columns == names
        left.append({x.doc_id for x in docs.select("doc_id").collect()})
    assert left[0] == left[1] == set(range(62)) and left[2] == set(range(60)) and left[3] <= left[2] and left[4] == left[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_links_below_every_leader_are_found(spark):
    r = random.Random(31)
    shared = prose(r, 400)
    own = lambda k, n: " ".join(f"own{k}x{j}" for j in range(n))
    texts = [f"{shared} {own(k, 52)}" for k in range(300)]  # each two at 0.79
    for k in range(0, 300, 4):  # pairs at about 0.82, below 0.8 to all others
        texts[k + 1] = f"{shared} {own(k, 13)} {own(k + 1, 39)}"
    want = expected(texts)
    assert len(set(want)) == 225
    d = spark.createDataFrame(table(texts), SCHEMA).repartition(3)
    got = {x.doc_id: x.class_id for x in near_dedup.classes(d).collect()}
    assert [got[i] for i in range(300)] == want


def test_blocks_of_long_texts_are_bounded_by_shingles(spark, monkeypatch):
    r = random.Random(37)
    shared = prose(r, 400)
    own = lambda k, n: " ".join(f"own{k}x{j}" for j in range(n))
    texts = [f"{shared} {own(k, 52)}" for k in range(120)]  # each two at 0.79
    for k in range(0, 120, 4):
        texts[k + 1] = f"{shared} {own(k, 13)} {own(k + 1, 39)}"
    paired, most = near_dedup.paired_blocks, []

    def measured(*tables):
        rows = paired(*tables)
        sizes = rows.groupBy("key", "p", "q").agg(F.sum(F.size("items")).alias("n"))
        most.append(sizes.agg(F.max("n")).first()[0])
        return rows

    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 10_000)
    monkeypatch.setattr(near_dedup, "paired_blocks", measured)
    d = spark.createDataFrame(table(texts), SCHEMA).repartition(3)
    got = {x.doc_id: x.class_id for x in near_dedup.classes(d).collect()}
    assert [got[i] for i in range(120)] == expected(texts)
    # two blocks, of which hashes may give one twice the mean; the whole bucket on both sides is over 80,000
    assert most and 0 < most[0] <= 40_000


def join_rows(spark, since):
    """Rows that inner joins by node made in the executions after the `since`-th, and the number of executions."""
    store, made = spark._jsparkSession.sharedState().statusStore(), 0
    n = store.executionsCount()
    for x in (store.executionsList(since, n - since).apply(k) for k in range(n - since)):
        values, nodes = store.executionMetrics(x.executionId()), store.planGraph(x.executionId()).allNodes()
        for node in (nodes.apply(k) for k in range(nodes.size())):
            if "Join" in node.name() and re.search(r"\[node#\d+L?\], \[node#\d+L?\], Inner", node.desc()):
                ids = [m.accumulatorId() for m in (node.metrics().apply(k) for k in range(node.metrics().size())) if m.name() == "number of output rows"]
                made += sum(int(values.apply(i).replace(",", "")) for i in ids if values.contains(i))
    return made, n


def test_members_of_large_buckets_are_joined_once(spark, monkeypatch):
    """What is compared of a text goes once to each of its buckets, so that rows of joins double with the group."""
    r = random.Random(41)
    shared = prose(r, 400)
    own = lambda k, n: " ".join(f"own{k}x{j}" for j in range(n))
    texts = [f"{shared} {own(k, 52)}" for k in range(160)]  # each two at 0.79
    for k in range(0, 160, 4):
        texts[k + 1] = f"{shared} {own(k, 13)} {own(k + 1, 39)}"
    paired, members = near_dedup.paired_blocks, []

    def measured(shared, *tables):
        members.append(shared.where(F.col("n") > near_dedup.SMALL).count())
        return paired(shared, *tables)

    monkeypatch.setattr(near_dedup, "paired_blocks", measured)
    for n in (80, 160):
        since = join_rows(spark, 0)[1]
        got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(table(texts[:n]), SCHEMA).repartition(3)).collect()}
        assert [got[i] for i in range(n)] == expected(texts[:n])
        made = join_rows(spark, since)[0]
        # one row for each member, and one for each text
        assert 0 < members[-1] <= near_dedup.BANDS * n and 0 < made <= members[-1] + n


def test_no_probability_is_rounded_up():
    p = np.array([1.0, 0.5, 1e-3, 4.3e-7, 4e-7, 1e-7, 2e-9, 1e-12, 1e-18])
    code = ngram_trie.quantised(p)
    got = ngram_trie._POWER[code]
    assert (got <= p * (1 + 1e-8)).all() and (got >= p * 10 ** (-ngram_trie.STEP) * (1 - 1e-8)).all()
    counts = np.append(np.ones(1_000_000), 2.4e8 - 1_000_000)  # the successors of a hot word
    shares = counts / (2.4e8 + ngram_trie.prior(np.array([2.4e8])))
    assert ngram_trie._POWER[ngram_trie.quantised(shares)].sum() <= shares.sum()
    assert ngram_trie._POWER[ngram_trie.quantised(shares[:1])][0] <= shares[0]


def test_ids_join_no_texts(spark):
    r = random.Random(41)
    a, b, c, e = (prose(r, 80) for _ in range(4))
    near = a.replace(a.split()[40], "changed", 1)
    rows = table([a, b, b, near, c, e, c, e], [None, None, 4, 7, 7, None, 7, None])
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert similarity(multiset(a), multiset(near)) >= 0.8
    of = {}
    for x in near_dedup.classes(d).collect():
        of.setdefault(x.class_id, []).append((x.doc_id, x.kept))
    low = lambda group: sorted(group, key=str)
    assert sorted(map(low, of.values()), key=str) == sorted(map(low, [[(None, False), (7, True)], [(None, False), (4, True)], [(7, True), (7, True)], [(None, True), (None, True)]]), key=str)
    kept = near_dedup.kept(d)
    assert kept.columns == d.columns
    assert Counter((x.doc_id, x.text) for x in kept.collect()) == Counter([(7, near), (4, b), (7, c), (None, e)])
    twice = spark.createDataFrame([(i, t, "s") for i, t in ((None, a), (None, c), (7, b), (7, e))], "doc_id bigint, text string, source string")
    assert Counter(x.text for x in mixing.dealt(twice).collect()) == Counter([a, b, c, e])
