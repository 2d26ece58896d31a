"""Spans of texts that come in several rows."""
import re

from sparklake.llm import secret_scan
from sparklake.session import scratch_path

TEXT = "xx 0123456789abcdef0 then fedcba98765432100 end"


def test_spans_of_repeated_rows(spark):
    rows = [(1, TEXT)] * 2 + [(None, "a " + TEXT)] * 3 + [(2, "none"), (2, TEXT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((str(i), ",".join(f"hex:{m.start()}:{m.end()}" for m in re.finditer("[0-9a-f]{16,}", t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.spans) for r in secret_scan.digest(docs).collect()) == want
    ledger = scratch_path(spark, "test_repeats")
    secret_scan.scan(docs, ledger, first=True)
    for r in spark.read.parquet(ledger).where("size(found) > 0").collect():
        assert [f.end - f.start for f in r.found] == [17, 17] and r.found[0].start in (3, 5)
