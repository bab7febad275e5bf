"""Awkward rows and brute force for the operators on training text: missing and repeated ids, very long texts, mirrors, deep pages, languages, and the whole pipeline."""

import hashlib
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import common, fingerprints, license_scan, mixing, near_dedup, ngram_trie, page_text, piece_bpe, prefix_counts, quality_rules, quality_trees

WORD = r"[^\x20\x09-\x0D]+"
VOCABULARY = [f"word{i}" for i in range(300)]
ENGLISH = "the of and to in a is that for it was on are as with be by this at from report committee budget river garden season people".split()


def prose(r, n, words=VOCABULARY):
    return " ".join(r.choice(words) for _ in range(n))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


# fingerprints


def test_next_document_in_a_total_order(spark):
    r = random.Random(2)
    rows = [(r.choice([None, 1, 2, 3, *range(10, 60)]), prose(r, r.randrange(1, 30))) for _ in range(300)] + [(None, None), (7, "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    key = lambda x: (-(2**63) if x[0] is None else x[0], signed(xxhash.xxh64((x[1] or "").encode(), seed=42).intdigest()))
    order = sorted(rows, key=key, reverse=True)
    want = Counter()
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        want[doc, hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    for _ in range(2):  # and again the same
        assert Counter((x.doc_id, x.edited_sha256) for x in fingerprints.fingerprints(d).collect()) == want


def test_fingerprints_of_long_texts(spark):
    text = " ".join(f"w{i}" for i in range(120_000))
    d = spark.createDataFrame([(1, text), (2, text + " more"), (3, "x" * 300_000)], "doc_id bigint, text string")
    got = {x.doc_id: x for x in fingerprints.fingerprints(d).collect()}
    assert got[2].near_next > 0.97 and got[3].near_next == 0 and got[1].n_chars == len(text)


# mixing


def test_mix_of_rows_without_id_and_of_many_sources(spark):
    r = random.Random(4)
    rows = [(r.choice([None, None, 1, 2, k]), prose(r, r.choice([5, 5, 5, 40])), r.choice([None, "a", "b", "c", "d", "é", f"s{k % 7}"])) for k in range(400)] + [(None, None, "a"), (9, "", None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = Counter(c.execute(mixing.ORACLES["op9_mixing"].replace("SELECT doc_id, size, source_size, target, times * size AS taken, times,", "SELECT doc_id, size, source_size, round(target, 6) AS target, times * size AS taken, times,")).fetchall())
    got = Counter((x.doc_id, x.size, x.source_size, round(x.target, 6), x.taken, x.times, x.position) for x in mixing.mixed(d).collect())
    assert got == want
    dealt = Counter((x.doc_id, x.text) for x in mixing.dealt(d).collect())
    assert set(dealt) <= {(i, t) for i, t, _ in rows} and max(dealt.values()) <= 3
    assert dealt == Counter((x.doc_id, x.text) for x in mixing.dealt(d.repartition(2)).collect())


def test_running_sums(spark):
    r = random.Random(6)
    rows = [(r.choice([None, "a", "b", "c"]), r.randrange(50), r.randrange(10), k) for k in range(500)]
    d = spark.createDataFrame(rows, "s string, x int, v bigint, k int")
    got = {x.k: (x.before, x._rank) for x in common.running(d, [F.col("s").isNull(), F.col("s"), F.col("x"), F.col("k")], {"before": "v"}).collect()}
    total = 0
    for n, (*_, v, k) in enumerate(sorted(rows, key=lambda x: (x[0] is None, x[0] or "", x[1], x[3]))):
        assert got[k] == (total, n)
        total += v
    assert common.running(d.limit(0), [F.col("k")], {"before": "v"}).count() == 0


# pages


def page(body, ident="", head="<title>t</title>"):
    return f"<html><head>{head}</head><body><div>My site</div><p>Home and contact</p>{body}<p>All about us</p></body></html>"


def test_names_of_parts_count_as_a_whole():
    of = lambda html: "\n".join(t for t, p in page_text.page_lines(html) if p)
    assert of('<div id="comment-on-budget"><p>Body text</p></div>') == "Body text"
    assert of('<article><div class="article-header"><h1>Title</h1></div><p>x</p></article>') == "Title\nx"
    assert of('<div class="has-sidebar content"><p>Text</p></div>') == "Text"
    for name in ("comments", "comment-list", "siteHeader", "cookie-notice", "main-nav", "ad slot-1x", "post-comments", "sidebar left", "footer_links"):
        assert of(f'<div class="{name}"><p>Gone</p></div><p>stays</p>') == "stays", name


def test_mirrors_keep_their_text_and_neighbours_decide(spark):
    r = random.Random(8)
    own = [f"Article {k}: {prose(r, 40)}." for k in range(12)]
    rows = []
    for k, text in enumerate(own):
        body = f"<p>{text}</p><p>More of {k}</p>"
        rows.append((k, f"http://h.example/news/{k:02d}", page(f"<article>{body}</article>" if k % 2 else body)))
    rows += [(50, "http://h.example/news/04?utm=1", rows[4][2]), (51, "http://h.example/news/04#top", rows[4][2]), (52, "http://h.example/news/04", rows[4][2]), (53, "http://h.example/news/04/", rows[4][2])]
    rows += [(60, "http://one.example/a", page("<p>Mirror</p>")), (61, "http://one.example/a?utm=1", page("<p>Mirror</p>"))]
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = {x.page_id: x for x in page_text.extracted(d).collect()}
    for k, text in enumerate(own):
        assert got[k].text == f"{text}\nMore of {k}" and got[k].marked == bool(k % 2) and got[k].n_common == 3
    assert {got[k].text for k in (50, 51, 52, 53)} == {got[4].text}
    assert got[60].text == got[61].text == "My site\nHome and contact\nMirror\nAll about us"


def test_neighbours_across_ranges(spark):
    rows = [(k, f"http://h{k % 3}.example/p/{k:04d}", page(f"<p>Own text of page number {k} here</p>")) for k in range(600)]
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = page_text.extracted(d).collect()
    assert Counter(x.text for x in got) == Counter(f"Own text of page number {k} here" for k in range(600))


def test_deep_and_long_pages(spark):
    deep = "<div>" * 20_000 + "<b>" * 5_000 + "<p>deep text" + "</div>" * 20_000
    long = "".join(f"<p>line {k}<li>x" for k in range(20_000))
    d = spark.createDataFrame([(1, "http://a.example/1", deep), (2, "http://b.example/1", long), (3, "http://a.example/2", "<" * 50_000)], "page_id bigint, url string, html string")
    began = time.time()
    got = {x.page_id: x for x in page_text.extracted(d).collect()}
    assert got[1].text == "deep text" and got[2].text.count("\n") == 39_999 and time.time() - began < 60


# licences


@pytest.mark.parametrize("name", ["ISC", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "Zlib"])
def test_notices_between_prose(name):
    r = random.Random(len(name))
    template = max((t for n, t in license_scan.TEMPLATES if n == name), key=len)
    text = f"{prose(r, 300, ENGLISH)}. {template.capitalize()}. {prose(r, 300, ENGLISH)}"
    (found,) = license_scan.Scanner().scan(pa.array([text]))
    assert (found[0].license, found[0].dice) == (name, 1.0)


def test_license_scan_of_awkward_rows(spark):
    grant = license_scan.TEMPLATES[1][1]
    r = random.Random(3)
    long = f"{prose(r, 150_000, ENGLISH)} {grant} {prose(r, 100_000, ENGLISH)}"
    phrase = "released under the mit license"
    rows = [(1, long), (1, long), (None, phrase), (2, None), (3, f"{phrase}. {phrase}"), (4, "x" * 400_000)]
    d = spark.createDataFrame([(i, t, "c", 1.0, ["z"]) for i, t in rows], "doc_id bigint, text string, license string, dice double, licenses array<string>")
    began = time.time()
    got = license_scan.scanned(d).collect()
    assert Counter((x.doc_id, x.license, x.n_matches) for x in got) == Counter([(1, "MIT", 1), (1, "MIT", 1), (None, "MIT", 1), (2, None, 0), (3, "MIT", 2), (4, None, 0)])
    assert time.time() - began < 60


# tokens


def test_long_runs_and_empty_tables_of_tokens(spark):
    from tokenizers import Tokenizer

    path, piece = piece_bpe.model_path("byte_bpe_50k.json"), piece_bpe.model_path()
    r = random.Random(1)
    texts = ["x" * 40_000, "".join(r.choice("abc") for _ in range(40_000)), "日" * 20_000, " " * 30_000, prose(r, 60_000)]
    d = spark.createDataFrame([(k % 2, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    library = Tokenizer.from_file(path)
    got = Counter((x.doc_id, x.n_tokens) for x in prefix_counts.token_counts(d, path).collect())
    assert got == Counter((k % 2, len(library.encode(t, add_special_tokens=False).ids)) for k, t in enumerate(texts))
    coder = piece_bpe.PieceBPE(piece)
    told = Counter((x.doc_id, x.n_tokens, x.n_corrected) for x in piece_bpe.digests(d, piece).collect())
    assert told == Counter((k % 2, len(coder.library.encode(t)) + 2, 0) for k, t in enumerate(texts))
    coded = piece_bpe.encoded(d, piece, digest="back").collect()
    assert Counter(x.back for x in coded) == Counter(hashlib.sha256(coder.library.decode(coder.library.encode(t)).encode()).hexdigest() for t in texts)
    assert prefix_counts.token_counts(d.limit(0), path).count() == 0 and coder.memory == {}


# quality


def test_rules_of_other_languages(spark):
    r = random.Random(5)
    text = ". ".join(" ".join("слово" + "абвгдежз"[r.randrange(8)] * r.randrange(1, 4) for _ in range(12)) for _ in range(10))
    long = " ".join("Wort" + "".join(r.choice("abcdefg") for _ in range(14)) for _ in range(80))
    d = spark.createDataFrame([(1, text, "ru"), (2, text, "en"), (3, text, None), (4, long, "FI"), (5, long, "de"), (6, None, "ru")], "doc_id bigint, text string, lang string")
    assert {x.doc_id for x in quality_rules.kept(d).collect()} == {1, 4} == {x.doc_id for x in quality_rules.measured(d).where("kept").collect()}
    assert quality_rules.kept(d.drop("lang")).count() == 0


def test_statistics_equal_brute_force():
    r = random.Random(7)
    texts = [None, "", " \n ", "One two. Two one!", "é ü\n\né ü\nlast", "A" * 5000, prose(r, 3000).title(), "a b a b a b", "\n\n"]
    got = quality_trees.statistics(pa.array(texts))
    at = {n: i for i, n in enumerate(quality_trees.STATISTICS)}
    for t, row in zip(texts, got):
        raw = (t or "").encode()
        w = [x.encode() for x in re.findall(WORD, t or "")]
        n, size = max(1, len(w)), max(1, len(raw))
        pairs = len(set(zip(w, w[1:])))
        lengths = [len(x) for x in w]
        want = {name: sum(b in members for b in raw) / size for name, members in ((k, set(v)) for k, v in quality_trees.CLASSES.items())}
        want |= {
            "log_bytes": np.log1p(len(raw)), "log_words": np.log1p(len(w)), "word_bytes": sum(lengths) / n, "word_spread": np.std(lengths) if w else 0, "short_words": sum(x <= 3 for x in lengths) / n, "long_words": sum(x >= 14 for x in lengths) / n,
            "distinct_words": len(set(w)) / n, "top_word": max(Counter(w).values(), default=0) / n, "repeated_pairs": 1 - pairs / max(1, len(w) - 1), "capital_words": sum(65 <= x[0] <= 90 for x in w) / n,
        }
        for name, value in want.items():
            assert row[at[name]] == pytest.approx(value, abs=1e-6), (t and t[:20], name)
        assert np.isfinite(row).all()


def test_boosting_lowers_the_loss_and_equals_a_plain_split():
    r = np.random.default_rng(2)
    x, y = r.normal(size=(400, 4)), (r.random(400) < 0.5).astype(float)
    y[x[:, 2] > 0.3] = 1
    one = quality_trees.fit(x, y, trees=1, depth=1)
    p = np.full(400, (y.sum() + 0.5) / 401)
    g, h = y - p, p * (1 - p)
    best = (-1.0, None, None)
    for f in range(4):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality_trees.BINS + 1)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= quality_trees.LEAST_ROWS:
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + quality_trees.L2) for s in (left, ~left))
                best = max(best, (gain, f, cut))
    root = one.roots[0]
    assert (one.feature[root], one.cut[root]) == (best[1], pytest.approx(best[2]))
    loss = [-np.mean(y * np.log(s) + (1 - y) * np.log(1 - s)) for s in (quality_trees.fit(x, y, trees=k).scores(x) for k in (1, 5, 20))]
    assert loss[0] > loss[1] > loss[2]


def test_labelled_ids_that_repeat_count_once(spark):
    d = spark.createDataFrame([(1, f"text {k}") for k in range(200)] + [(2, "other words")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    trees = quality_trees.learned(d, labels)
    assert 0 < quality_trees.scored(d, trees).first().score < 1


# the language model


def test_language_model_of_repeated_rows_and_long_texts(spark):
    r = random.Random(9)
    long = prose(r, 120_000)
    rows = [(1, long), (1, long), (3, "a b"), (None, "a b"), (4, "never " * 10), (5, None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = ngram_trie.trained(d.where(~ngram_trie.held_out(d)))
    got = ngram_trie.scored(d, model).collect()
    assert sorted(x.n_tokens for x in got) == [1, 3, 3, 11, 120_001, 120_001]
    assert len({x.score for x in got if x.n_tokens == 120_001}) == 1 and all(x.score < 0 for x in got)
    again = ngram_trie.scored(d, ngram_trie.trained(d.where(~ngram_trie.held_out(d)).repartition(5))).collect()
    assert sorted((x.n_tokens, round(x.score, 6)) for x in again) == sorted((x.n_tokens, round(x.score, 6)) for x in got)


def test_texts_seen_twice_stand_out(spark):
    r = random.Random(13)
    texts = [prose(r, 80, [f"w{i}" for i in range(5000)]) for _ in range(200)]
    d = spark.createDataFrame(list(enumerate(texts + texts[:40])), "doc_id bigint, text string")
    got = {x.doc_id: x.score / x.n_tokens for x in ngram_trie.scored(d, ngram_trie.trained(d)).collect()}
    once = sorted(got[k] for k in range(40, 200))
    assert sum(got[k] > once[int(len(once) * 0.9)] for k in range(40)) >= 38


# all of it


def same_class(texts, least=0.8):
    def sets(t):
        w = re.findall(WORD, t or "")
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    all_sets, root = [sets(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = sum((all_sets[i] & all_sets[j]).values())
            if (texts[i] or "") == (texts[j] or "") or both and both >= least * sum((all_sets[i] | all_sets[j]).values()):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def test_pipeline_equals_brute_force(spark, tmp_path):
    r = random.Random(17)
    function = "the of and to in a is that".split()
    clean = [" ".join(r.choice(function) if r.random() < 0.3 else r.choice(VOCABULARY) for _ in range(120)) for _ in range(80)]
    near = [c.replace(c.split()[50], "changed", 1) for c in clean[:10]]
    texts = clean + near + clean[10:14] + [" | ".join(prose(r, 60).split()) for _ in range(20)] + [None, "", "short"]
    rows = [(k if k % 9 else None, t, "en", ["a", "b", None][k % 3], len(t or "")) for k, t in enumerate(texts)] + [(200, clean[20], "en", "a", 1), (200, clean[21], "en", "a", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 94), 0) for k in range(len(texts))], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()

    def table(name, rows):
        c.execute(f"CREATE OR REPLACE TABLE {name} (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
        if rows:
            c.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?, ?)", rows)

    left = list(enumerate(rows))
    table("documents", [(k, *x[1:]) for k, x in left])  # numbered, so that rows can be told apart
    good = {k for k, kept in c.execute(f"SELECT doc_id, kept FROM ({quality_rules.ORACLES['op7_quality_rules']})").fetchall() if kept}
    left = [(k, x) for k, x in left if k in good]
    trees = quality_trees.learned(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = trees.scores(quality_trees.statistics(pa.array([x[1] for _, x in left], pa.string())))
    left = [y for y, s in zip(left, scores) if s >= quality_trees.THRESHOLD]
    classes = same_class([x[1] for _, x in left])
    low = -(2**63)
    heads = {}
    for cls, (_, x) in zip(classes, left):
        firsts = min(y[0] for c2, (_, y) in zip(classes, left) if c2 == cls and y[1] == x[1] and y[0] is not None) if any(c2 == cls and y[1] == x[1] and y[0] is not None for c2, (_, y) in zip(classes, left)) else low
        key = (firsts == low, firsts, hashlib.md5((x[1] or "").encode()).hexdigest(), x[1])
        heads[cls] = min(heads.get(cls, key), key)
    kept = Counter((None if h[1] == low else h[1], h[3]) for h in heads.values())
    stages = dict(corpus_pipeline.STAGES)
    got = docs
    for name in ("quality_rules", "quality_classifier", "near_dedup"):
        got = common.written(stages[name](spark, got, str(tmp_path)), name)
    assert Counter((x.doc_id, x.text) for x in got.collect()) == kept
    mixed = Counter((x.doc_id, x.text) for x in stages["source_mix"](spark, got, str(tmp_path)).collect())
    plan = mixing.plan(got, once=True)
    times = Counter()
    for x in plan.collect():
        if x.times:
            times[x.doc_id, x.size] += x.times
    told = Counter()
    for (i, t), n in mixed.items():
        told[i, len(re.findall(WORD, t))] += n
    assert told == times
    coder = piece_bpe.PieceBPE(piece_bpe.model_path())
    want = Counter()
    for (i, t), n in mixed.items():
        ids = coder.library.encode(t, add_bos=True, add_eos=True)
        want[i, tuple(ids), hashlib.sha256(coder.library.decode(ids).encode()).hexdigest()] += n
    assert Counter((x.doc_id, tuple(x.token_ids), x.decoded_sha256) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_hot_buckets_lose_no_link(spark):
    """A third of all rows in one group of near copies, equal texts among them, and a template family beside it: recall of linked pairs."""
    r = random.Random(23)
    base = prose(r, 200, [f"b{i}" for i in range(2000)]).split()
    texts = []
    for k in range(150):
        w = list(base)
        w[(k % 140) + 5] = f"edit{k % 140}"
        texts.append(" ".join(w))
    frame = prose(r, 100, [f"f{i}" for i in range(2000)])
    texts += [f"{frame} {prose(r, 60, [f'g{k}x{i}' for i in range(60)])}" for k in range(60)] + [prose(r, 120, [f"h{i}" for i in range(9000)]) for _ in range(200)]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    got = {x.doc_id: x.class_id for x in near_dedup.classes(d).collect()}
    want = same_class(texts)
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    assert sum(got[i] == got[j] for i, j in linked) == len(linked)
    assert [got[k] for k in range(len(texts))] == want

