"""What a query costs grows with its input: work for a task is bounded, and no test of a text is stated more often than it is needed."""

import os
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import rx
from palimpsest.plans import catalog
from palimpsest.sources import tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_a_large_file_is_dealt_out_by_its_size(spark, tmp_path, monkeypatch):
    pq.write_table(pa.table({"doc_id": list(range(2000)), "text": [f"{i} " * 50 for i in range(2000)]}), tmp_path / "documents.parquet", compression="none")
    size = (tmp_path / "documents.parquet").stat().st_size
    monkeypatch.setattr(tables, "PART_BYTES", size // 40, raising=False)
    d = tables.table(spark, str(tmp_path), "documents")
    assert d.rdd.getNumPartitions() >= 40
    rows = [r[0] for r in d.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(rows) == 2000 and max(rows) < 200
    assert sorted(r[0] for r in d.select("doc_id").collect()) == list(range(2000))


def stated(df):
    """How many pattern tests and line cuts a query's plan states."""
    return len(re.findall(r"RLIKE|regexp_\w+\(|split\(", df._jdf.queryExecution().optimizedPlan().toString()))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables to run over")
@pytest.mark.parametrize("name, most", [("page_classes", 100), ("layout_roles", 60), ("cleaned_documents", 700)])
def test_tests_are_stated_once(spark, name, most):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10**6)
    spark.conf.set("spark.sql.debug.maxToStringFields", 10**6)
    n = stated(catalog.QUERIES[name](spark, FOLDER))
    print(name, n)
    assert n <= most


def test_look_aheads_change_no_match(spark):
    odd = "и там ЖЕ см.: ibid. İSBN ısbn ſee ISBN 5 a@b.c [12] слово¹ x12. // http://я ᲂп. 5 К.   №5 10 % 5.4 K"
    d = spark.createDataFrame([(odd,), (odd[::-1],), ("",), ("no match here",)], "t string")
    patterns = [(k, v, f) for k, v in vars(P).items() if k.isupper() and isinstance(v, str) for f in ("", "i", "im") if rx.lead(v, f)]
    assert len(patterns) > 20
    differ = [F.regexp_extract_all("t", F.lit(rx.rx(v, f)), F.lit(0)) != F.regexp_extract_all("t", F.lit(f"(?dU{f}){v}"), F.lit(0)) for _, v, f in patterns]
    assert d.select(*[F.coalesce(c, F.lit(True)).alias(f"c{i}") for i, c in enumerate(differ)]).distinct().collect() == [tuple([False] * len(differ))]
