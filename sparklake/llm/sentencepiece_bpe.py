"""SentencePiece encoding and decoding: exact merge-type BPE by backtracking.

A sequence of pieces is the encoding of a text if, and only if, merging the text of each
adjacent pair anew gives that pair.  So the encoder takes the longest piece at each
position (all matches come from one Aho-Corasick pass), checks it against the piece
before, tries shorter ones, and steps back when none fits; a bitfield keeps the positions
that lead nowhere, as the encoding of a prefix is unique.

Merges never cross the cuts between parts of a text (see ``pieces``), so each distinct
part is encoded once per worker while it is kept; the number kept is bounded.

Defined results: null text counts as empty and gives only the end id; other columns are
carried; repeated rows are encoded alike; an empty table gives an empty result; texts are encoded whole.
Input columns named ids (or decoded, where asked for) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from sparklake.llm.common import ROW, field, packed, ship, unpacked
from sparklake.llm.pieces import MARK, Kept, Vocabulary, default_model, sliced

KEPT_PARTS = 200_000
KEPT_PAIRS = 100_000


def merged(symbols: list[str], score: dict[str, float]) -> list[str]:
    """Greedy merging: the best-scored adjacent pair first, the leftmost of equals."""
    symbols = list(symbols)
    while True:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            s = score.get(symbols[i] + symbols[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if at < 0:
            return symbols
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]


class Encoder:
    """Encodes a text part by part; keeps the ids of the parts used lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.score = vocabulary, vocabulary.score
        self.automaton = ahocorasick.Automaton()
        for piece in vocabulary.ids:
            # a piece that merging its own characters doesn't give is never in an encoding;
            # one character always stands for itself
            if len(piece) > 1 and len(merged(list(piece), self.score)) == 1:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.of_part = Kept(self.part_ids, KEPT_PARTS)

    def compatible(self, a: str, b: str) -> bool:
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        found = self.pairs[a, b] = merged(list(a + b), self.score) == [a, b]
        return found

    def split(self, word: str) -> list[str]:
        """The pieces of a part; characters that no piece has stand for themselves."""
        n = len(word)
        matches: list[list[int]] = [[] for _ in range(n + 1)]  # lengths over 1, the longest last
        for last, length in self.automaton.iter(word):
            matches[last - length + 1].append(length)
        failed: bytearray | None = None  # a bit for each position that leads nowhere
        known = self.pairs
        taken: list[str] = []
        tried: list[int] = []  # what is left to try in place of each piece taken
        at, before, left = 0, "", len(matches[0])  # left: so many matches, and one character
        while at < n:
            here = matches[at]
            while left >= 0:
                end = at + (here[left - 1] if left else 1)
                left -= 1
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    piece = word[at:end]
                    if not before:
                        break
                    fits = known.get((before, piece))
                    if self.compatible(before, piece) if fits is None else fits:
                        break
            else:  # nothing fits here: take the last piece back
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(taken.pop())
                left = tried.pop()
                before = taken[-1] if taken else ""
                continue
            taken.append(piece)
            tried.append(left)
            at, before, left = end, piece, len(matches[end])
        return taken

    def part_ids(self, part: str) -> tuple[int, ...]:
        found, known = [], self.vocabulary.ids
        for piece in self.split(part):
            i = known.get(piece)
            if i is None:
                found += self.vocabulary.byte_ids(piece)
            else:
                found.append(i)
        return tuple(found)

    def encode(self, text: str) -> list[int]:
        """Ids of the text, without an end id."""
        return list(chain.from_iterable(map(self.of_part.__getitem__, self.vocabulary.parts(text))))


def _utf8(raw: bytes) -> str:
    """Each byte that doesn't belong to a whole character becomes U+FFFD."""
    out = []
    while raw:
        try:
            return "".join(out) + raw.decode()
        except UnicodeDecodeError as e:
            out.append(raw[:e.start].decode() + "�")
            raw = raw[e.start + 1:]
    return "".join(out)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.text = list(vocabulary.pieces)
        for i in vocabulary.control:
            self.text[i] = ""
        self.text[vocabulary.unknown] = " ⁇ "  # as the library shows it
        self.marked = {i for p, i in vocabulary.ids.items() if p[0] == MARK}
        self.bytes = {i: b for b, i in vocabulary.byte_id.items()}

    def decode(self, ids: list[int]) -> str:
        text, table = self.text, self.bytes
        if table.keys().isdisjoint(ids):
            out = "".join([text[i] for i in ids])
        else:
            parts, raw = [], bytearray()
            for i in ids:
                if i in table:
                    raw.append(table[i])
                    continue
                if raw:
                    parts.append(_utf8(bytes(raw)))
                    raw.clear()
                parts.append(text[i])
            out = "".join(parts) + _utf8(bytes(raw))
        first = next((i for i in ids if i in table or text[i]), -1)
        return out[1:] if first in self.marked else out


_made: dict[str, tuple[Encoder, Decoder]] = {}


def _tools(shared) -> tuple[Encoder, Decoder]:
    """One encoder and decoder a worker, of the vocabulary that the driver has read."""
    model, vocabulary = shared.value
    if model not in _made:
        _made[model] = Encoder(vocabulary), Decoder(vocabulary)
    return _made[model]


def _shared(docs: DataFrame, model: str | None):
    ship(docs.sparkSession)
    model = model or default_model()
    return docs.sparkSession.sparkContext.broadcast((model, Vocabulary(model)))  # under 2 MB


def encode(docs: DataFrame, model: str | None = None, carry_text: bool = True, decoded: bool = False) -> DataFrame:
    """``docs`` with ids (array of int): the ids of ``text`` and the end id.

    ``decoded`` adds what the ids decode to, in the same pass and Python worker.
    """
    shared = _shared(docs, model)
    new = ["ids", "decoded"] if decoded else ["ids"]
    names = [c for c in docs.columns if c not in new and (carry_text or c != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(shared)
        end = encoder.vocabulary.end
        for b in sliced(batches):
            flat, ends, texts = [], [0], []
            for text in b.column("text").to_pylist():
                flat += encoder.encode(text or "")
                flat.append(end)
                if decoded:
                    texts.append(decoder.decode(flat[ends[-1]:]))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(ROW), ids, *([pa.array(texts, pa.string())] if decoded else [])],
                                             names=[ROW, *new])

    rows = docs.select(packed(docs.select(*names)), field(docs, "text").alias("text"))
    schema = rows.select(ROW).schema.add("ids", ArrayType(IntegerType()))
    schema = schema.add("decoded", StringType()) if decoded else schema
    return rows.mapInArrow(run, schema).select(*unpacked(docs, names), *new)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with decoded: the text of ids (null ids: empty text)."""
    shared = _shared(encoded, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(shared)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                s = b.slice(at, 500)
                ids = s.column("ids")
                flat = ids.flatten().to_numpy(zero_copy_only=False).tolist()
                sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                texts = [decoder.decode(flat[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*s.columns, pa.array(texts, pa.string())], names=[*s.schema.names, "decoded"])

    rows = encoded.drop("decoded")
    schema = StructType(list(rows.schema.fields)).add("decoded", StringType())
    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    both = encode(docs.select("doc_id", "text"), carry_text=False, decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
