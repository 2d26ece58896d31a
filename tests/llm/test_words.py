"""Word BPE, periodic runs and spelling variants against the library and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparklake.llm import periodic_runs, queries, spelling, word_bpe

DATA = "/root/testdata/sf0.001"


def _docs(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind)


def _sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# ---- word BPE

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(word_bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


ODD = ["", " \t\n", "It's WE'LL they'Re 'tis", "a\x1cb\x1f c\x85d e f　g", "ΑΣ ΌΣΟΣ İstanbul ŒUVRE ﬁ éÉ",
       "x<|endoftext|>y <|startoftext|><|endoftext|> <|ENDOFTEXT|>", "中文字 한국어 가 1234 ½ ²", "😀😀 ... !!!###\x00",
       "aaaa" * 3000, "abracadabra" * 500, "ꟊ𞤀Ა ᲊ"]


def test_word_bpe_equals_the_library(library):
    encoder = word_bpe.Encoder(vocabulary := word_bpe.Vocabulary(word_bpe.default_vocabulary()))
    decoder = word_bpe.Decoder(vocabulary)
    rng = random.Random(5)
    letters = "abcdeABC's're'LL 12 \t\n\x1c\x85éÉ́ΣσİßŒ中😀#!<|endoftext|>"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(20000))]
    for text, got, want in zip(texts, encoder.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == want.ids
        assert decoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_word_bpe_one_place_a_round(library):
    vocabulary = word_bpe.Vocabulary(word_bpe.default_vocabulary())
    assert vocabulary.in_order
    vocabulary.in_order = False
    texts = ["mississippi hahahahaha banana aaaaaaa", "tomorrow"]
    got = word_bpe.Encoder(vocabulary).encode_batch(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_word_bpe_small_bounds(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "KEPT_BYTES", 300)
    monkeypatch.setattr(word_bpe, "BATCH_SYMBOLS", 7)
    encoder = word_bpe.Encoder(word_bpe.Vocabulary(word_bpe.default_vocabulary()))
    for text in ["the quick brown fox", "the slow brown bear and the fox", "the quick bear"] * 3:
        assert np.frombuffer(encoder.encode_batch([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_bpe_query(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_word_bpe"](spark, DATA).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want = len(ids), _sha(b"".join(i.to_bytes(4, "little") for i in ids)), _sha(library.decode(ids, skip_special_tokens=False))
        assert tuple(got[r.doc_id])[1:] == want


def test_word_bpe_nulls_ties_clashes_and_empty_tables(spark, library):
    long = "Word " * 60_000
    rows = [(None, None, "a", 1), (1, "", "b", 2), (1, "Same text", None, 3), (1, "Same text", None, 3), (2, long, "c", None)]
    docs = _docs(spark, rows, "doc_id long, text string, __row string, ids int")
    got = word_bpe.encode(docs, decoded=True)
    assert got.columns == ["doc_id", "text", "__row", "ids", "decoded"]
    want = sorted(str((i, t, x, library.encode(t or "", add_special_tokens=False).ids)) for i, t, x, _ in rows)
    assert sorted(str((r.doc_id, r.text, r["__row"], r.ids)) for r in got.collect()) == want
    again = word_bpe.decode(got.withColumnRenamed("decoded", "before").withColumn("decoded", F.lit(1)))
    assert again.where("decoded <> before").count() == 0
    assert word_bpe.encode(docs.limit(0)).count() == 0 and word_bpe.digest(docs.limit(0)).count() == 0
    unknown = spark.createDataFrame([([49407, 10**6, -1],), (None,)], "ids array<int>")
    assert [r.decoded for r in word_bpe.decode(unknown).collect()] == ["<|endoftext|>", ""]


# ---- periodic runs

def _runs(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if (length := j - i + q) >= max(6, 4 * q):
                run = words[i:i + length]
                if all(run[p:] != run[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _some_texts():
    rng = random.Random(11)
    texts = []
    for _ in range(1500):
        k = rng.choice([1, 2, 3, 5, 30])
        words = [rng.randrange(k) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            words += ([rng.randrange(k) for _ in range(rng.randint(1, 9))] * rng.randint(1, 7))[:rng.randint(1, 60)]
            words += [rng.randrange(k) for _ in range(rng.randint(0, 9))]
        texts.append(words * (rng.randint(2, 5) if rng.random() < 0.2 else 1))
    return texts


def test_runs_against_brute_force():
    texts = _some_texts()
    starts = np.cumsum([0] + [len(t) for t in texts])
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = {}
    for a, length, q in periodic_runs.runs_of(np.array(sum(texts, [])), of).tolist():
        got.setdefault(of[a], []).append((a - starts[of[a]], length, q))
    assert all(_runs(t) == got.get(i, []) for i, t in enumerate(texts))
    assert len(got) > 300


def test_frequency_splitting_leaves_only_what_may_be_in_a_run():
    word = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 8, 1, 2, 3, 1, 2, 3])
    at, segment = periodic_runs.split_by_frequency(word, np.zeros(16, int))
    assert at.tolist() == list(range(1, 9)) and set(segment) == {0}  # the last words are rare once 8 has split them off


def _expected_runs(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    dropped = {i for a, length, q in runs for i in range(a + q, a + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], _sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            _sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_query(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 9000]
    docs = _docs(spark, [tuple(r) for r in rows])
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.digest(docs).collect()}
    assert got == {r.doc_id: _expected_runs(r.doc_id, r.text) for r in rows}
    assert sum(v[0] > 0 for v in got.values()) > 5


def test_runs_nulls_ties_clashes_and_empty_tables(spark):
    texts = [None, "", " \n", "a a a a a a b b b b b b", "x " * 30_000, "a b " * 4, "a a " * 6 + "\x1c"]
    rows = [(i if i else None, t, "x", 1) for i, t in enumerate(texts)] * 2
    docs = _docs(spark, rows, "doc_id long, text string, __row string, runs int")
    got = periodic_runs.with_runs(docs)
    assert got.columns == ["doc_id", "text", "__row", "runs", "collapsed"]
    for r in got.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        assert [tuple(x) for x in r.runs] == (_runs(words) if len(words) < 1000 else [(0, 30_000, 1)])
    assert {r.collapsed for r in got.collect()} == {"", "a b", "x", "a a \x1c"}
    assert sorted(map(str, (tuple(r)[1:] for r in periodic_runs.digest(docs.where("length(text) < 100 or text is null")).collect()))) == \
        sorted(str(_expected_runs(i, t)) for i, t, *_ in rows if len(t or "") < 100)
    assert periodic_runs.digest(docs.limit(0)).count() == 0


# ---- spelling variants

def _counted(rows):
    n = Counter()
    for doc_id, text in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{r}".encode())
            if h % 97 == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            n[r] += len(r) >= 5
    return {w: c for w, c in n.items() if c >= 3}


def _variants(n):
    near = {w: set() for w in n}
    holes = {}
    for w in n:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), []).append(w)
            if (x := w[:i] + w[i + 1:]) in n:
                near[w].add(x)
                near[x].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= set(same) - {w}
    best = {w: min(s, key=lambda x: (-n[x], x)) for w, s in near.items() if s}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


@pytest.mark.parametrize("least", [3, 50, 10**9])
def test_variants_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", least)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    n = _counted(docs.select("doc_id", "text").collect())
    assert {tuple(r) for r in queries.QUERIES["op13_spelling"](spark, DATA).collect()} == _variants(n)


def test_variants_of_dense_words(spark):
    rng = random.Random(2)
    n = {"".join(rng.choice("abÿ") for _ in range(rng.randint(5, 8))): rng.randint(1, 60) for _ in range(900)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(words).collect()}
    assert got == _variants(n) and len(got) == len(n)
    assert any(r[1] and r[2] != r[1] for r in got)  # chains


def test_affected_grams_by_hand():
    frequent = {"^c", "co", "col", "ol", "lo", "ou", "our"}
    grams = spelling.grams_of("colour", frequent)
    assert grams == ["^co", "colo", "olo", "lou", "our$", "ur", "r$"]
    assert spelling.most_affected(grams, 6) == 4  # the second o
    assert len(spelling.listed("colour", dict.fromkeys(frequent, 99))) == 5


def test_gram_dictionary_is_bounded(spark):
    words = spark.createDataFrame([(f"{c}{d}{i:03d}".translate(str.maketrans("0123456789", "abcdefghij")), 1)
                                   for c in "klm" for d in "xyz" for i in range(500)], "word string, n long")
    for most in (5, 50, 500):
        found = spelling.frequent_grams(words, most)
        assert all(Counter(map(len, found))[k] < most for k in (2, 3, 4))


def test_spelling_nulls_ties_and_empty_tables(spark):
    rows = [(None, None), (1, ""), (None, "colour colour colour"), (2, "COLOR color Color " * 4), (2, "ÀÉÎÕÜ àéîõü " * 3), (2, "hello " * 50_000)] * 2
    docs = _docs(spark, [(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert {tuple(r) for r in spelling.digest(docs).collect()} == _variants(_counted(rows))
    assert spelling.digest(docs.limit(0)).count() == 0
    plain = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert plain == {"colour": 6, "color": 24, "ÀÉÎÕÜ": 6, "àéîõü": 6, "hello": 100_000}
