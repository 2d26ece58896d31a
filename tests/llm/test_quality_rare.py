"""Groups and languages too small for an estimate of their own."""
import random

import pytest

from sparklake.llm import quality_rules

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("each", [18, 5])  # 72 rows: a pool over all languages; 20: below MIN_GROUP
def test_rare_languages_are_judged(spark, each):
    rng = random.Random(4)
    rows = []
    for lang in ("fr", "es", "it", None):
        for i in range(each):
            words = [f"w{rng.randrange(5000)}" for _ in range(80)]
            rows.append((len(rows), " ".join(words if i else [w + "##" for w in words]), lang, "s"))
    got = {r.doc_id: r for r in quality_rules.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(r.d2 is not None for r in got.values())
    assert {i: r.kept for i, r in got.items()} == {i: "##" not in t for i, t, *_ in rows}
