"""Fingerprints, quality rules, mixing, encoders and counts against brute force on small tables with awkward rows."""

import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from palimpsest.llm import fingerprints, license_scan, mixing, piece_bpe, prefix_counts, quality_rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, size string, key string, block string, before string"
WORDS = "the of and alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def rows(n=40, seed=1):
    r = random.Random(seed)
    texts = [None, "", " \n\t", "one", "one two three four", "a b c d e", "a b c d e", "x  y\x0bz\n\nx  y\x0bz", "é" * 30 + " ñ 日本 🙂", "word " * 300]
    while len(texts) < n:
        texts.append(" ".join(r.choice(WORDS) for _ in range(r.choice([3, 20, 90, 400]))).replace("mu ", "mu.\n"))
    sources = ["b", "a", None, "c", "a", "a"]
    return [(i * 7 % 1000, t, None, sources[i % 6], None, "k", "s", "key", "bl", "be") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def shingle_set(t):
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words(t)]

    def chain(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64(v.to_bytes(8, "little"), seed=seed).intdigest()
        return signed(seed)

    if len(h) >= 5:
        return {chain(h[i : i + 5]) for i in range(len(h) - 4)}
    return {signed(xxhash.xxh64(" ".join(str(signed(x)) for x in h).encode(), seed=42).intdigest())} if h else set()


def test_fingerprints_match_brute_force(docs):
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    table = {r[0]: r[1] or "" for r in rows()}
    order = sorted(table, reverse=True)
    assert set(got) == set(table)
    k = fingerprints.K
    for i, d in enumerate(order):
        text, after = table[d], table[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[d].n_chars == len(text)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sketches = [sorted(shingle_set(t))[:k] for t in (text, edited, after)]
        for value, s in zip((got[d].fingerprint, got[d].edited_fingerprint), sketches):
            assert value == "".join(f"{x % 2**64:016x}" for x in s)

        def alike(a, b):
            u = sorted({*a, *b})[:k]
            return sum(x in a and x in b for x in u) / len(u) if u else 1.0

        assert got[d].near_edited == pytest.approx(alike(sketches[0], sketches[1]))
        assert got[d].near_next == pytest.approx(alike(sketches[0], sketches[2]))


def test_fingerprints_of_repeated_and_missing_ids(spark, empty):
    assert fingerprints.fingerprints(empty).count() == 0
    d = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, None)], "doc_id bigint, text string")
    got = fingerprints.fingerprints(d).collect()
    assert len(got) == 4
    assert len({r.fingerprint for r in got if r.n_chars}) == 1
    alone = fingerprints.fingerprints(d.limit(1)).collect()
    assert alone[0].near_next == 1.0


def test_sketches_merge_and_estimate(spark):
    r = random.Random(5)
    a = [f"w{r.randrange(10**6)}" for _ in range(3000)]
    b = a[:2000] + [f"w{r.randrange(10**6)}" for _ in range(1000)]
    d = spark.createDataFrame([("k", " ".join(a)), ("k", " ".join(b)), ("e", None)], "key string, text string")
    got = {r.key: r.sketch for r in fingerprints.merged_by(d, "key", "text").collect()}
    assert got["k"] == sorted(shingle_set(" ".join(a)) | shingle_set(" ".join(b)))[: fingerprints.K] and got["e"] == []
    pair = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
    pair = pair.select(fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    row = pair.select(fingerprints.resemblance(F.col("a"), F.col("b")).alias("r"), fingerprints.containment(F.col("a"), F.col("b")).alias("c"), fingerprints.distinct_shingles(F.col("a")).alias("n")).first()
    assert abs(row.r - 0.5) < 0.15 and abs(row.c - 0.66) < 0.2 and abs(row.n / 2996 - 1) < 0.3


def test_quality_counts_match_brute_force(docs, empty):
    assert quality_rules.measured(empty).count() == 0
    got = {r.doc_id: r for r in quality_rules.measured(docs).collect()}
    for d, t, *_ in rows():
        w = words(t)
        tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (not r.kept or not r.base_failed)
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_repeated_windows_of_every_density(spark):
    r = random.Random(9)
    texts = [" ".join(r.choice("abcdefgh"[:k]) for _ in range(n)) for k in (1, 2, 4, 8) for n in (3, 4, 9, 60, 700)] + [" ".join(f"w{r.randrange(3000)}" for _ in range(9000)) + " a b c d a b c"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.measured(d).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        tri = Counter(zip(w, w[1:], w[2:]))
        assert got[i] == len({i + j for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for j in range(3)})


def test_mix_meets_targets(docs, empty):
    assert mixing.mixed(empty).count() == 0
    got = mixing.plan(docs).collect()
    assert len(got) == len(rows())
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        assert r.size == len(words(next(t for d, t, *_ in rows() if d == r.doc_id)))
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in got))
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]
    mixed = mixing.dealt(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.times for r in got if r.times})


def test_mix_reshares_excess(spark):
    d = spark.createDataFrame([(1, "w " * 10, "a"), (2, "w " * 1000, "b"), (3, "w " * 10, "c")], "doc_id bigint, text string, source string")
    target = {r.source: r.target for r in mixing.plan(d).collect()}
    assert target == {"a": 30, "b": 960, "c": 30}


@pytest.fixture(scope="module")
def coder():
    return piece_bpe.PieceBPE(piece_bpe.model_path())


def test_agenda_equals_library(coder):
    r = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "a", "the", "é", "▁", "<s>", "</s>", "<0x41>", "　", "\x00", "日本", "🙂", "Hello", "1234", "\r\n", "ﬁ", "…", "x" * 60]
    for _ in range(1500):
        t = "".join(r.choice(bits) for _ in range(r.randrange(20)))
        ids = coder.encode(t)
        assert ids == coder.library.encode(t, add_bos=True, add_eos=True)
    assert coder.corrected == 0


def test_memory_is_bounded_and_right(coder):
    small = piece_bpe.PieceBPE(piece_bpe.model_path())
    small.memory.most = 50
    texts = [" ".join(f"word{i * j % 997}" for j in range(60)) for i in range(40)]
    assert [list(memoryview(p).cast("I")) for p in small.encode_packed(texts)] == coder.library.encode(texts)


def test_encode_and_decode_frames(docs, empty, coder):
    path = piece_bpe.model_path()
    assert piece_bpe.digests(empty, path).count() == 0
    got = {r.doc_id: r for r in piece_bpe.digests(docs, path).collect()}
    for d, t, *_ in rows():
        ids = coder.library.encode(t or "", add_bos=True, add_eos=True)
        assert (got[d].n_tokens, got[d].n_corrected) == (len(ids), 0)
        assert got[d].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(coder.library.decode(ids).encode()).hexdigest()
    back = piece_bpe.decoded(piece_bpe.encoded(docs, path), path)
    for r in back.collect():
        assert r.decoded == coder.library.decode(coder.library.encode(r.text or "", add_bos=True, add_eos=True))


def test_prefix_counts_equal_the_library(docs):
    from tokenizers import Tokenizer

    path = piece_bpe.model_path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), prefix_counts.PrefixCounter(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    r = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "a", "the", "é", "'s", "'", "re", "'re", "<|endoftext|>", "<|end", "123", "日本", "🙂", "\r\n", "\xa0", "\x1c", "\x85", "!", "　", "I'll", "  \n"]
    for i in range(800):
        t = "".join(r.choice(bits) for _ in range(r.randrange(14)))
        assert counter.count(t) == count(t)
        if i < 250:
            assert counter.prefix_counts(t).tolist() == [count(t[:k]) for k in range(len(t) + 1)]
    got = {r.doc_id: r for r in prefix_counts.token_counts(docs, path, 100).collect()}
    cut = {r.doc_id: r for r in prefix_counts.truncated(docs, path, 50).collect()}
    for d, t, *_ in rows():
        t = t or ""
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len(t.encode()), count(t), count(t) > 100)
        assert t.startswith(cut[d].text) and cut[d].n_tokens == count(cut[d].text) <= 50


def test_license_scan_finds_edited_notices(spark, empty):
    assert license_scan.scanned(empty).count() == 0
    mit = license_scan.TEMPLATES[1][1]
    edited = mit.replace("furnished", "given").replace("free of charge", "free of charge,\n")
    texts = [None, "", "free software", f"some prose here. {edited} and more prose", "Licensed under the Apache License, Version 2.0.", "x " * 50 + "\nReleased under the MIT License.\n" + "y " * 50, "the license of the software is apache"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scanned(d).collect()}
    assert [got[i].license for i in range(7)] == [None, None, None, "MIT", "Apache-2.0", "MIT", None]
    assert got[3].dice > 0.9 and got[4].dice == got[5].dice == 1.0


def test_license_scan_equals_brute_force_over_regions():
    scanner = license_scan.Scanner()
    for name, template in license_scan.TEMPLATES:
        (found,) = scanner.scan(pa.array([f"lorem ipsum dolor {template.upper()} sit amet"]))
        assert found and found[0].dice == 1.0 and found[0].license == name


def test_license_scan_equals_brute_force_over_all_windows():
    of = dict(license_scan.TEMPLATES[2:4])
    grant, two, three = license_scan.TEMPLATES[1][1], of["BSD-2-Clause"], of["BSD-3-Clause"]
    cut = " ".join(grant.split()[:70])
    texts = [f"{grant} {grant}", f"{two} {three}", f"some words {cut} {grant} and {license_scan.TEMPLATES[4][1]} {cut}"]

    def brute(text):
        w, every = text.split(), []
        pairs = list(zip(w, w[1:]))
        for name, t in license_scan.TEMPLATES[1:5]:
            template = set(zip(t.split(), t.split()[1:]))
            for a in range(len(pairs)):
                seen = set()
                for b in range(a, min(len(pairs), a + int(len(template) * 1.2 / 0.8))):
                    seen.add(pairs[b])
                    if 3 * len(seen) >= 2 * len(template) - 3 and (d := 2 * len(seen & template) / (len(seen) + len(template))) >= 0.8:
                        every.append((-d, a - b - 1, a, name, b + 1))
        out = []
        for d, _, a, name, b in sorted(every):
            if all(b < m[2] or a > m[3] for m in out):
                out.append((name, -d, a, b))
        return out

    scanner = license_scan.Scanner(license_scan.TEMPLATES[1:5])
    for text, n in zip(texts, (2, 2, 4)):
        (found,) = scanner.scan(pa.array([text]))
        assert [(m.license, m.dice, m.start, m.end) for m in found] == brute(text) and len(found) == n
