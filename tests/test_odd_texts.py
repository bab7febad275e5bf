"""Queries over texts that the given tables lack give the rows of their SQL."""

import duckdb

from palimpsest.plans import catalog


def both(spark, folder, name, texts):
    """Rows of a query and of its SQL over documents with these (doc_id, text), null texts among them."""
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    told = duckdb.connect()
    told.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    want = told.execute(catalog.ORACLES[name])
    columns = [d[0] for d in want.description]
    return sorted((tuple(r) for r in catalog.QUERIES[name](spark, str(folder)).select(*columns).collect()), key=repr), sorted(want.fetchall(), key=repr)


def test_hyphens_before_words_with_other_letters(spark, tmp_path):
    # some pages end their head with a broken word
    got, want = both(spark, tmp_path, "anomaly_totals", [(i, "Qué éco-  léger") for i in range(240)])
    assert got == want and want[0][2] > 0


def test_lines_that_are_all_noise(spark, tmp_path):
    texts = [(3, "12"), (6, "xiv\n~~~~"), (12, "word\n"), (24, "12\n"), (36, "\n"), (48, ""), (54, None), (66, "a\rb\x0bc\n7 \t"), (78, "12\n "), (96, "  ~~~  \nstays"), (102, "\t12")]
    got, want = both(spark, tmp_path, "noise_lines", texts)
    assert got == want and (12, "word\n") in want and (6, None) in want
