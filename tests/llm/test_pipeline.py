"""The pipeline's rows, stage by stage, against plain Python."""

import random
import re
from collections import Counter

import sentencepiece
from test_mix import WORD, walk

import corpus_pipeline
from sparklake.llm import quality_rules, source_mix
from sparklake.llm.pieces import default_model
from sparklake.session import scratch_path

# the columns of documents, and some that operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rank int, size long, bucket int, slot string"


def corpus(rng):
    def prose(n):
        return "".join(f"w{rng.randrange(400)}" + rng.choice([" ", " ", " ", "\n"]) for _ in range(n)).strip()

    texts = [prose(rng.randrange(60, 200)) for _ in range(150)]
    for t in texts[:12]:  # equal but for white space
        texts.append(t.replace(" ", "  ", 3) + "\n")
    for t in texts[12:40]:  # one word edited
        words = t.split(" ")
        words[len(words) // 2] = "edited"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t", "too short", "again and again " * 60, "### $$$ " * 80, prose(30_000), "ünïcödé 東京 😀 " + prose(90)]
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "en", "de"]), rng.choice(["a", "a", "b", None]), 1, None, i, 2, 3, "s") for i, t in enumerate(texts)]
    none = (None, prose(80), None, None, None, None, None, None, None, None)
    return [*rows, rows[5], rows[5], none, none]


def run(spark, rows, monkeypatch):
    root, stages = scratch_path(spark, "pipeline_test"), {}
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")

    def kept(df, name, save=corpus_pipeline.save):
        stages[name.removeprefix("pipeline_")] = out = save(df, name)
        return out
    monkeypatch.setattr(corpus_pipeline, "save", kept)
    last = corpus_pipeline.run(spark, root)
    return spark.read.parquet(f"{root}/documents.parquet"), stages, last


def test_pipeline_against_brute_force(spark, monkeypatch):
    rows = corpus(random.Random(11))
    docs, stages, last = run(spark, rows, monkeypatch)
    got = {name: [tuple(r) for r in df.collect()] for name, df in stages.items()}
    assert list(got) == [name for name, _ in corpus_pipeline.STAGES[:-1]]
    assert all(df.columns == docs.columns for df in stages.values())

    # quality rules: by the operator's verdicts, and by hand as far as the base rules go
    verdict = {}
    for r in quality_rules.digest(docs).collect():
        verdict.setdefault(r.doc_id, r.kept)
    want = Counter(r for r in rows if verdict[r[0]])
    assert Counter(got["quality_rules"]) == want and len(want) > 100
    for r in rows:
        words = WORD.findall(r[1] or "")
        threes = Counter(zip(words, words[1:], words[2:]))
        inside = {i + j for i in range(len(words) - 2) if threes[tuple(words[i:i + 3])] > 1 for j in range(3)}
        if len(words) < 50 or 100 * len(inside) > 50 * len(words):
            assert not verdict[r[0]]

    # exact dedup: the smallest id of each normalised text
    first = {}
    for r in sorted(got["quality_rules"], key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), r)
    assert Counter(got["exact_dedup"]) == Counter(first.values()) and len(first) < sum(want.values())

    # near join: one document, of the smallest id, of each component
    left = sorted(first.values(), key=lambda r: (r[0] is None, r[0] or 0))
    sets = []
    for r in left:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(r[1])]
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)})
    leader = list(range(len(left)))
    changed = True
    links = [(i, j) for i in range(len(left)) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(leader[i], leader[j])
            changed |= leader[i] != low or leader[j] != low
            leader[i] = leader[j] = low
    near = [r for i, r in enumerate(left) if leader[i] == i]
    assert Counter(got["near_join"]) == Counter(near) and len(near) < len(left)

    # mixing: each document as often as its words are taken, to the nearest whole
    taken, _, _, target, _, sizes = walk(near, source_mix.SLOTS, source_mix.MOST_BLOCK_WORDS, source_mix.BUCKET_ROWS)
    times = Counter({r: int(taken[i] / max(1, sizes[i]) + 0.5) for i, r in enumerate(near)})
    assert Counter(got["source_mix"]) == +times and max(times.values()) == 2

    # pieces: what the library gives
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    pieces = Counter()
    for r in got["source_mix"]:
        ids = library.encode(r[1], add_eos=True)
        pieces[r[0], r[2], r[3], tuple(ids), len(ids), library.decode(ids)] += 1
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids), r.n_tokens, r.text) for r in last.collect()) == pieces


def test_pipeline_of_an_empty_table(spark, monkeypatch):
    docs, stages, last = run(spark, [], monkeypatch)
    assert last.count() == 0 and {"doc_id", "text", "ids", "n_tokens"} <= set(last.columns)
    assert all(df.columns == docs.columns and df.count() == 0 for df in stages.values())
