"""Word BPE encoding and decoding: batched numpy merge rounds.

The vocabulary lower-cases, drops white space and marks word ends.  White space bounds every
pre-token, so a text falls into chunks, and a chunk into words, that are encoded on their own; the ids of
chunks used lately are kept by each worker, up to a bound.  All words that are new in a slice of texts
are merged together: their symbols stand in one flat array, each round looks every changed pair up by
binary search in the sorted pair keys, takes the lowest-ranked pair of every word, and merges all its places from
the left (one place a round if some merge makes a symbol that an earlier-ranked merge uses; see ``in_order``).

Defined results: null text counts as empty and has no ids; null ids decode to empty text, unknown ids
to nothing; other columns are carried; repeated rows are encoded alike; an empty table gives an empty result;
texts are encoded whole, however long a text or a word is.  Input columns named like a result are replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import path
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructType
from tokenizers import Regex, normalizers, pre_tokenizers

from sparklake.llm.common import ROW, field, packed, ship, unpacked
from sparklake.llm.pieces import sliced

#: White space of the library's patterns; Python's own has four control characters more.
SPACES = "\t-\r \x85\xa0  -     　"
EXTRA_SPACES = "\x1c\x1d\x1e\x1f"
CHUNK = regex.compile(f"[^{SPACES}]+")
#: The forms of the vocabulary file that this module works like.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
#: The same for ASCII text.
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
#: Bytes of chunks and their ids that a worker keeps between slices, at most twice; of a dictionary's entry.
KEPT_BYTES, ENTRY_BYTES = 64 << 20, 150
#: Symbols that are merged together.
BATCH_SYMBOLS = 1 << 20
NONE = np.int32(2**31 - 1)


def default_vocabulary() -> str:
    return path("word_bpe_49k.json")


def byte_chars() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself where it prints,
    else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Vocabulary:
    """What the file says, as arrays.  Small enough to ship."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        added = spec["added_tokens"]
        if (model["type"] != "BPE" or spec["normalizer"].get("normalizers") != NORMALIZERS or spec["decoder"]
                or cut["pattern"]["Regex"] != WORD_PATTERN or model["unk_token"] or model["ignore_merges"]
                or any(t["content"].isalpha() or t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)):
            raise ValueError(f"{file} is no vocabulary of words as this encoder knows them")
        ids = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in added}
        self.token = {i: t for t, i in chain(ids.items(), self.special.items())}
        self.first = np.array([ids[c] for c in byte_chars()], np.int32)  # by byte
        self.last = np.array([ids[c + end] for c in byte_chars()], np.int32)
        self.size = len(ids)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.made = np.array([ids[a + b] for a, b in pairs], np.int32)  # by rank
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        born = np.full(self.size, -1)
        born[self.made[::-1]] = np.arange(len(pairs))[::-1]  # rank of the first merge that makes a symbol
        last_born = np.full(self.size, -1)
        last_born[self.made] = np.arange(len(pairs))
        #: no merge makes a symbol that a merge of lower rank uses
        self.in_order = bool((np.maximum(last_born[left], last_born[right]) < np.arange(len(pairs))).all()
                             and (born == last_born).all())


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.plain = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.cut = pre_tokenizers.Split(Regex(WORD_PATTERN), "removed", invert=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept_bytes = 0

    def ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pairs that begin at ``at``; NONE where no merge takes one."""
        out = np.full(at.size, NONE)
        pair = at[at + 1 < symbols.size]
        whole = word[pair] == word[pair + 1]
        pair = pair[whole]
        key = symbols[pair].astype(np.int64) * self.v.size + symbols[pair + 1]
        place = np.minimum(np.searchsorted(self.v.keys, key), self.v.keys.size - 1)
        found = self.v.keys[place] == key
        out[np.flatnonzero(at + 1 < symbols.size)[whole]] = np.where(found, self.v.rank[place], NONE)
        return out

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and the number of each word's."""
        word = np.repeat(np.arange(sizes.size, dtype=np.int32), sizes)
        rank = self.ranks(symbols, word, np.arange(symbols.size))
        done_symbols, done_words = [], []
        while symbols.size:
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            counts = np.diff(np.append(starts, symbols.size))
            least = np.repeat(np.minimum.reduceat(rank, starts), counts)
            left = least != NONE
            if not left.all():
                done_symbols.append(symbols[~left])
                done_words.append(word[~left])
                symbols, word, rank, least = symbols[left], word[left], rank[left], least[left]
            at = np.flatnonzero(rank == least)
            if not at.size:
                break
            if self.v.in_order:
                number = np.arange(at.size)
                begins = np.concatenate([[True], np.diff(at) != 1])
                since = number - np.maximum.accumulate(np.where(begins, number, 0))
                at = at[since % 2 == 0]  # of touching places every second, from the left
            else:
                at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            symbols[at] = self.v.made[rank[at]]
            stays = np.ones(symbols.size, bool)
            stays[at + 1] = False
            symbols, word, rank = symbols[stays], word[stays], rank[stays]
            at = at - np.arange(at.size)
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = self.ranks(symbols, word, changed)
        if not done_words:
            return symbols, np.zeros(sizes.size, np.int64)
        words = np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(words, minlength=sizes.size)

    def words(self, chunk: str) -> list[str]:
        """Words of a chunk in the vocabulary's normal form, by the tables of characters of the tokenizers library."""
        return [w for w, _ in self.cut.pre_tokenize_str(self.plain.normalize_str(chunk))]

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        out: list[bytes] = []
        raw = [w.encode() for w in words]
        at = 0
        while at < len(raw):
            end, total = at, 0
            while end < len(raw) and (end == at or total + len(raw[end]) <= BATCH_SYMBOLS):
                total += len(raw[end])
                end += 1
            sizes = np.array([len(w) for w in raw[at:end]])
            flat = np.frombuffer(b"".join(raw[at:end]), np.uint8)
            symbols = self.v.first[flat]
            ends = np.cumsum(sizes) - 1
            symbols[ends] = self.v.last[flat[ends]]
            ids, counts = self.merged(symbols, sizes)
            data = ids.astype("<u4").tobytes()
            cuts = np.concatenate([[0], np.cumsum(counts) * 4]).tolist()
            out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
            at = end
        return out

    def learn(self, chunks: Iterable[str]) -> None:
        """Keeps the ids of ``chunks``, which are new."""
        parts: list[tuple[str, list[str | bytes]]] = []
        for c in chunks:
            if c.isascii() and c.isalpha():
                parts.append((c, [c.lower()]))
                continue
            pieces: list[str | bytes] = []
            for i, piece in enumerate(self.special.split(c) if self.special else [c]):
                if i % 2:
                    pieces.append(self.v.special[piece].to_bytes(4, "little"))
                elif piece:
                    pieces += ASCII_WORD.findall(piece.lower()) if piece.isascii() else self.words(piece)
            parts.append((c, pieces))
        ids: dict[str | bytes, bytes] = dict.fromkeys(chain.from_iterable(p for _, p in parts))
        new = [p for p in ids if isinstance(p, str)]
        ids |= zip(ids, ids)  # a special token's id stands for itself
        ids |= zip(new, self.of_words(new))
        kept, total = self.kept, 0
        for c, pieces in parts:
            found = kept[c] = ids[pieces[0]] if len(pieces) == 1 else b"".join(map(ids.__getitem__, pieces))
            total += len(c) + len(found)
        self.kept_bytes += total + ENTRY_BYTES * len(parts)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.kept_bytes > KEPT_BYTES:
            self.older, self.kept, self.kept_bytes = self.kept, {}, 0
        chunks = [chunks_of(t) if t else [] for t in texts]
        missing = set(chain.from_iterable(chunks)) - self.kept.keys()
        again = missing & self.older.keys()
        self.kept.update((c, self.older[c]) for c in again)  # what was used lately stays
        self.kept_bytes += sum(len(c) + len(self.older[c]) + ENTRY_BYTES for c in again)
        self.learn(missing - again)
        known = self.kept.__getitem__
        return [b"".join(map(known, c)) for c in chunks]


def chunks_of(text: str) -> list[str]:
    """What stands between white space."""
    return CHUNK.findall(text) if any(c in text for c in EXTRA_SPACES) else text.split()


class Decoder:
    """The tokens' texts joined by spaces, as the library does for a vocabulary without a decoder."""

    def __init__(self, vocabulary: Vocabulary):
        self.token = [vocabulary.token.get(i) for i in range(max(vocabulary.token) + 1)]
        self.full = all(t is not None for t in self.token)

    def decode(self, ids: list[int]) -> str:
        if self.full and (not ids or 0 <= min(ids) <= max(ids) < len(self.token)):
            return " ".join(map(self.token.__getitem__, ids))
        return " ".join(t for i in ids if 0 <= i < len(self.token) and (t := self.token[i]) is not None)


_made: dict[str, tuple[Encoder, Decoder]] = {}


def _tools(shared) -> tuple[Encoder, Decoder]:
    """One encoder and decoder a worker, of the vocabulary that the driver has read."""
    name, vocabulary = shared.value
    if name not in _made:
        _made[name] = Encoder(vocabulary), Decoder(vocabulary)
    return _made[name]


def _shared(docs: DataFrame, file: str | None):
    ship(docs.sparkSession)
    file = file or default_vocabulary()
    return docs.sparkSession.sparkContext.broadcast((file, Vocabulary(file)))  # under 3 MB


def encode(docs: DataFrame, file: str | None = None, *, carry_text: bool = True, decoded: bool = False,
           as_bytes: bool = False) -> DataFrame:
    """``docs`` with ids (array of int): the ids of ``text``, without added ones.

    ``as_bytes`` gives ids as little-endian unsigned 32-bit integers in one binary, as token files hold
    them.  ``decoded`` adds what the ids decode to, in the same pass.
    """
    shared = _shared(docs, file)
    new = ["ids", "decoded"] if decoded else ["ids"]
    names = [c for c in docs.columns if c not in new and (carry_text or c != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(shared)
        for b in sliced(batches):
            ids = encoder.encode_batch(b.column("text").to_pylist())
            columns = [b.column(ROW)]
            if as_bytes:
                columns.append(pa.array(ids, pa.binary()))
            else:
                ends = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            if decoded:
                columns.append(pa.array([decoder.decode(np.frombuffer(i, "<u4").tolist()) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[ROW, *new])

    rows = docs.select(packed(docs.select(*names)), field(docs, "text").alias("text"))
    schema = StructType(list(rows.select(ROW).schema.fields)).add("ids", BinaryType() if as_bytes else ArrayType(IntegerType()))
    schema = schema.add("decoded", StringType()) if decoded else schema
    return rows.mapInArrow(run, schema).select(*unpacked(docs, names), *new)


def decode(encoded: DataFrame, file: str | None = None) -> DataFrame:
    """``encoded`` with decoded: the text of ids, an array of int."""
    shared = _shared(encoded, file)
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(shared)
        for b in batches:
            texts = [decoder.decode([i for i in ids or [] if i is not None]) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(ROW), pa.array(texts, pa.string())], names=[ROW, "decoded"])

    rows = encoded.select(packed(encoded.select(*names)), F.col("ids"))
    schema = StructType(list(rows.select(ROW).schema.fields)).add("decoded", StringType())
    return rows.mapInArrow(run, schema).select(*unpacked(encoded, names), "decoded")


def digest(docs: DataFrame) -> DataFrame:
    both = encode(docs.select("doc_id", "text"), carry_text=False, decoded=True, as_bytes=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
