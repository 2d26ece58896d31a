"""Forms of phone numbers."""
import re

from sparklake.llm import pii

PHONES = ["+1 (017) 555-7713", "+1 (132) 555-1352", "+1 (988) 155-1352", "017-555-7713", "(017) 555 7713", "017.055.7713",
          "+10175557713", "+1 017 5557713", "9885552485", "+44 20 7946 0958", "+49 (0)30 123456", "+353861234567", "+4915112345678"]
OTHER = ["1234567890", "+12 345", "10175557713", "17-55-7713", "a017-555-7713", "017-555-77131"]


def test_phone_numbers_of_any_area(spark):
    texts = [f"call {p}, or not." for p in PHONES + OTHER]
    got = pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()
    got = {r.doc_id: r for r in got}
    digits = lambda t: re.sub("[^0-9]", "", t)
    for i, t in enumerate(texts):
        if i >= len(PHONES):
            assert (got[i].found, got[i].text) == ([], t)
            continue
        assert got[i].found == ["phone"] and got[i].text != t
        assert re.sub("[0-9]", "9", got[i].text) == re.sub("[0-9]", "9", t)
    for i in (3, 4, 6, 7):  # the number of 0 in other forms
        assert digits(got[i].text)[-10:] == digits(got[0].text)[-10:]
    for i, code in ((0, "1"), (9, "44"), (10, "49"), (11, "353"), (12, "49")):
        assert digits(got[i].text).startswith(code)


def test_phone_pseudonyms_stay_apart(spark):
    docs = spark.range(0, 10_000_000_000, 9_999_991).selectExpr(
        "id AS doc_id", "regexp_replace(lpad(id, 10, '0'), '^(...)(...)', '($1) $2-') AS text")
    got = [r.text for r in pii.pseudonymised(docs, "k").collect()]
    assert len(got) == len(set(got)) == 1001 and all(re.fullmatch(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}", t) for t in got)
