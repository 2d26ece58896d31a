"""The mix, document by document, against a plain walk through the schedule."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from sparklake.llm import source_mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(rng, n, sources):
    rows = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([0, 3, 20, 60]))), "en", rng.choice(sources), 0)
            for i in range(n)]
    return rows + [(n, None, "en", "a", 0), (n + 1, "long " * 3000, "en", "b", 0), (n + 2, "one two three", "en", "tiny", 0)]


def walk(rows, slots_wanted, most_block, bucket_rows):
    """(taken, first slot) per row, word by word."""
    sizes = [len(WORD.findall(r[1] or "")) for r in rows]
    words = Counter()
    for r, n in zip(rows, sizes):
        words[r[3]] += n
    order = sorted((s for s in words if s is not None), key=str.encode) + ([None] if None in words else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes), set()
    while True:
        level = (total - sum(2 * words[s] for s in capped)) / max(1, sum(weight[s] for s in order if s not in capped))
        above = {s for s in order if s not in capped and level * weight[s] > 2 * words[s]}
        if not above:
            break
        capped |= above
    target = {s: float(2 * words[s]) if s in capped else level * weight[s] for s in order}
    all_words = -(-sum(sizes) * 150 // 100)
    block = max(1, min(most_block, all_words // slots_wanted))
    streams, buckets = defaultdict(list), max(1, len(rows) // bucket_rows)
    for i, r in enumerate(rows):
        text = hashlib.md5((r[1] or "").encode()).hexdigest()
        key = hashlib.md5(f"{'' if r[0] is None else r[0]}\x01{text}".encode()).hexdigest()
        if sizes[i]:
            streams[r[3]].append((int(key[:8], 16) % buckets, key, i))
    stream = {s: [i for _, _, i in sorted(v) for _ in range(sizes[i])] for s, v in streams.items()}
    edges, at = [], 0.0
    for s in order:
        edges.append((at, at + target[s], s))
        at += target[s]
    drawn = defaultdict(list)  # slots of each source
    for slot in range(-(-all_words // block)):
        point = slot * source_mix.GOLDEN - math.floor(slot * source_mix.GOLDEN)
        for lo, hi, s in edges:
            if lo / at <= point < hi / at:
                drawn[s].append(slot)
    taken, first = Counter(), {}
    as_drawn = set()
    for s in order:
        blocks = [stream[s][b:b + block] for b in range(0, len(stream.get(s, [])), block)] if s in stream else []
        plan = [(slot, w) for turn, slot in enumerate(drawn[s][:2 * len(blocks)]) for w in blocks[turn % len(blocks)]]
        if abs(len(plan) - target[s]) <= source_mix.SLACK * target[s]:
            as_drawn.add(s)
        elif blocks:  # to the target: cut, or filled by slots without a number
            every = [w for _ in range(2) for b in blocks for w in b]
            plan = (plan + [(None, w) for w in every[len(plan):]])[:int(math.floor(target[s] + 0.5))]
        for slot, w in plan:
            taken[w] += 1
            if slot is not None:
                first[w] = min(slot, first.get(w, slot))
    return taken, first, as_drawn, target, words, sizes


@pytest.mark.parametrize("slots, bucket_rows", [(1 << 18, 2000), (700, 20), (90, 7)])
def test_each_document_is_taken_as_the_schedule_says(spark, monkeypatch, slots, bucket_rows):
    monkeypatch.setattr(source_mix, "SLOTS", slots)
    monkeypatch.setattr(source_mix, "BUCKET_ROWS", bucket_rows)
    rows = table(random.Random(slots), 240, ["a", "b", "b", "b", "c", None])
    taken, first, as_drawn, target, words, sizes = walk(rows, slots, source_mix.MOST_BLOCK_WORDS, bucket_rows)
    got = {r.doc_id: r for r in source_mix.digest(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert as_drawn and len(got) == len(rows)
    for i, r in enumerate(rows):
        g = got[r[0]]
        assert (g.size, g.source_size, g.taken, g.first_slot) == (sizes[i], words[r[3]], taken[i], first.get(i)), r[0]
        assert g.target == pytest.approx(target[r[3]]) and g.taken <= 2 * g.size
    for s in words:
        whole = sum(taken[i] for i, r in enumerate(rows) if r[3] == s)
        assert abs(whole - target[s]) <= max(1, source_mix.SLACK * target[s])


def test_other_points_give_another_mix(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "SLOTS", 700)
    docs = spark.createDataFrame(table(random.Random(2), 240, ["a", "b", "b", "c"]), SCHEMA)
    rows = sorted(map(str, source_mix.digest(docs).drop("first_slot").collect()))
    monkeypatch.setattr(source_mix, "GOLDEN", 1e-6)
    assert sorted(map(str, source_mix.digest(docs).drop("first_slot").collect())) != rows
