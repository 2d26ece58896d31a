"""Token counts: unigram segmentation by dynamic programming on a trie of pre-tokens.

Pre-tokens are the parts of a text that no piece crosses; distinct ones go into a trie.  Each node holds the best score of the segmentations of its prefix and the
tokens of that best one, worked out once from the nodes above it, so pre-tokens that begin
alike share the work; a pre-token's count is that of its last node.  A document's count is the sum over its
pre-tokens (see ``pieces``).

Scores are the model's piece scores, read as unigram scores; a character without a piece scores
``UNKNOWN_BELOW`` less than the least piece and counts as its UTF-8 bytes (or one unknown).  Of
equal scores the longer last piece wins.  Texts stay where they are: nothing is shuffled.

Defined results: null, empty: no pre-tokens and no tokens; repeated rows count alike;
an empty table gives an empty result; texts are counted whole; extra columns are carried,
but those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructType

from sparklake.llm.common import ROW, field, packed, ship, unpacked
from sparklake.llm.pieces import Kept, Vocabulary, default_model, sliced

UNKNOWN_BELOW = 10.0
#: Pieces with a score at or below this are placeholders and don't set the unknown score.
PLACEHOLDER = -1e8
#: A worker starts a new trie beyond this many nodes.
MOST_NODES = 400_000
KEPT_PARTS = 200_000
CHARS = 0x110000


class ForwardTrie:
    """Token counts of pre-tokens from their trie; keeps the counts of those used lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.score = vocabulary, vocabulary.score
        self.unknown = min(s for s in self.score.values() if s > PLACEHOLDER) - UNKNOWN_BELOW
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.score.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.of_part = Kept(self.part_count, KEPT_PARTS)
        self.plant()

    def plant(self) -> None:
        self.child: dict[int, int] = {}  # by node * CHARS + code point
        self.best, self.tokens = [0.0], [0]  # by node; the root is the empty prefix

    def grow(self, word: str, path: list[int]) -> int:
        """Adds the nodes of ``word`` below ``path``, the nodes of its first prefixes; returns the last one."""
        best, tokens = self.best, self.tokens
        known = len(path) - 1
        ending: list[list[tuple[int, float]]] = [[] for _ in word]
        for last, piece in self.automaton.iter(word):  # of one end the longest first
            if last >= known:
                ending[last].append(piece)
        for depth in range(known + 1, len(word) + 1):
            top, count = None, 0
            for length, score in ending[depth - 1]:
                at = path[depth - length]
                if top is None or best[at] + score > top:
                    top, count = best[at] + score, tokens[at] + 1
            char = word[depth - 1]
            if char not in self.score:
                at = path[-1]
                if top is None or best[at] + self.unknown > top:
                    top, count = best[at] + self.unknown, tokens[at] + len(self.vocabulary.byte_ids(char))
            self.child[path[-1] * CHARS + ord(char)] = len(best)
            path.append(len(best))
            best.append(top)
            tokens.append(count)
        return path[-1]

    def part_count(self, word: str) -> int:
        if len(self.best) > MOST_NODES:
            self.plant()
        child, node, path = self.child, 0, [0]
        for c in word:
            node = child.get(node * CHARS + ord(c))
            if node is None:
                node = self.grow(word, path)
                break
            path.append(node)
        return self.tokens[node]

    def count(self, text: str) -> tuple[int, int]:
        """(pre-tokens, tokens) of a text."""
        parts = self.vocabulary.parts(text)
        return len(parts), sum(map(self.of_part.__getitem__, parts))


_made: dict[str, ForwardTrie] = {}


def counted(docs: DataFrame, model: str | None = None, carry_text: bool = True) -> DataFrame:
    """``docs`` with n_pre_tokens and n_tokens (longs)."""
    spark = docs.sparkSession
    ship(spark)
    model = model or default_model()
    shared = spark.sparkContext.broadcast((model, Vocabulary(model)))  # under 2 MB
    names = [c for c in docs.columns if c not in ("n_pre_tokens", "n_tokens") and (carry_text or c != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, vocabulary = shared.value
        if name not in _made:
            _made[name] = ForwardTrie(vocabulary)
        trie = _made[name]
        for b in sliced(batches):
            counts = [trie.count(text or "") for text in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(ROW), *(pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1))],
                names=[ROW, "n_pre_tokens", "n_tokens"])

    rows = docs.select(packed(docs.select(*names)), field(docs, "text").alias("text"))
    schema = StructType(list(rows.select(ROW).schema.fields)).add("n_pre_tokens", LongType()).add("n_tokens", LongType())
    return rows.mapInArrow(run, schema).select(*unpacked(docs, names), "n_pre_tokens", "n_tokens")


def digest(docs: DataFrame) -> DataFrame:
    return counted(docs.select("doc_id", "text"), carry_text=False)
