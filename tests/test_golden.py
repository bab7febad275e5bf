"""Golden metrics of whole texts against brute force."""

import random
import re

from palimpsest.functions import normalize as N
from palimpsest.operators import evaluation
from palimpsest.plans import noise, queries


def levenshtein(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(now[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def edited(r, t, n):
    t = list(t)
    for _ in range(n):
        i = r.randrange(len(t) + 1)
        t[i : i + r.randrange(3)] = r.choice(["", "x", "яé", "𝔘"])
    return "".join(t)


def test_distance_equals_brute_force():
    r = random.Random(5)
    for n in (0, 1, 2, 5, 40, 300):
        for edits in (0, 1, 3, 20, 150):
            for letters in ("ab", "abcdefgh я𝔘"):
                a = "".join(r.choice(letters) for _ in range(n))
                b = edited(r, a, edits)
                want = levenshtein(a, b)
                assert evaluation.distance(a, b) == evaluation.distance(b, a) == want
                x, y = (evaluation.np.array([ord(c) for c in t], evaluation.np.uint32) for t in (a, b))
                if len(x) and len(y):
                    assert evaluation._bit_parallel(x, y) == want and evaluation._along_diagonals(x, y, 600) == want
    a = "".join(r.choice("abcdefgh ") for _ in range(30_000))
    assert evaluation.distance(a, "head " + a[:9_000] + a[9_001:] + " tail") == 11


def test_golden_summary_reads_whole_texts(spark, tmp_path):
    r = random.Random(7)
    texts = [" ".join(r.choice("the nation, of stations and well-be run".split()) for _ in range(r.choice([5, 90, 260]))) + "." for _ in range(40)] + [""]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    pages = noise.pages(spark, str(tmp_path)).select("doc_id", N.spacing(queries.F.col("text")).alias("text"))
    actual = {x.doc_id: x.text for x in pages.collect()}
    word = "[А-Яа-яЁёA-Za-z]"
    patterns = {"mixed_script_tokens": r"\b(?=\w*[A-Za-z])(?=\w*[А-Яа-яЁё])[\w-]{4,}\b", "spaced_hyphen": rf"\b{word}+-\s+{word}+\b", "compact_hyphen_short": rf"\b{word}{{2,}}-{word}{{1,4}}\b"}
    got = queries.golden_summary(spark, str(tmp_path)).first()
    assert got.sample_count == len(texts)
    for name, p in patterns.items():
        assert got[name] == sum(len(re.findall(p, t)) for t in actual.values()) > 0
    rates = [round(levenshtein(t, actual[i]) / len(t), 4) if t else (None if actual[i] else 0.0) for i, t in enumerate(texts)]
    rates = [x for x in rates if x is not None]
    assert abs(got.avg_normalized_edit_distance - sum(rates) / len(rates)) < 1e-4
    assert abs(got.avg_keyword_retention_rate - sum("the" in t.lower() for t in actual.values()) / len(texts)) < 1e-4
