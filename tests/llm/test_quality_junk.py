"""Groups with much junk."""
import random

from sparklake.llm import quality_rules

SCHEMA = "doc_id long, text string, lang string, source string"


def prose(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_junk_beyond_a_quarter_of_a_group(spark):
    rng = random.Random(3)
    rows = []
    for lang, junk in (("en", 36), ("de", 54)):  # of 120: 30 and 45 %
        for i in range(120):
            t = prose(rng, rng.randrange(60, 160))
            rows.append((len(rows), t if i >= junk else " ".join(w + "#$"[i % 2] * 3 for w in t.split()), lang, "s"))
    got = {r.doc_id: r.kept for r in quality_rules.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: "##" not in t and "$$" not in t for i, t, *_ in rows}
