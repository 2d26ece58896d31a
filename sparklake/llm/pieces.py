"""Vocabulary of a SentencePiece BPE model, and the cuts of a text that its pieces never cross."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from public_tokenizers import path

#: SentencePiece writes a space as this mark, in pieces and texts; one leads the text.  Here
#: both stand as a space, which keeps most strings at one byte a character.
SPACE_MARK = "▁"
MARK = " "
PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}]*")
#: Text bytes that are worked on at a time in a Python worker (a longer text is whole, on its own).
SLICE_BYTES = 1 << 20


def default_model() -> str:
    return path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces by id: text, score, and which are bytes or control symbols.  Small enough to ship."""

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i).replace(SPACE_MARK, MARK) for i in range(n)]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a space mark after other characters: merges cross pre-tokens")

        # Letters, and all other characters, never share a piece in such vocabularies: a text can
        # be cut between them as well as before a run of marks.
        odd = "".join(sorted({c for p in self.ids for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
        other = f"[^\\w{MARK}]|[\\d_{odd}]"
        self.part = re.compile(f"{MARK}*[^\\W\\d_{odd}]+|{MARK}*(?:{other})+|{MARK}+")
        if not all(map(self.part.fullmatch, self.ids)):
            self.part = PRE_TOKEN

    def parts(self, text: str) -> list[str]:
        """The text with its leading mark, cut where no piece goes across; no text: nothing."""
        return self.part.findall(MARK + text.replace(SPACE_MARK, MARK)) if text else []

    def byte_ids(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode()] if self.byte_id else [self.unknown]


class Kept(dict):
    """Results by key, worked out where missing; holds the last ``most`` or up to twice as many."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most = work, most
        self.older: dict = {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
        if len(self) >= self.most:  # what was used lately stays
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES of the text column."""
    for b in batches:
        col, at, size = b.column(column), 0, 0
        for i in range(b.num_rows):
            size += col[i].as_buffer().size if col[i].is_valid else 0
            if size >= SLICE_BYTES:
                yield b.slice(at, i + 1 - at)
                at, size = i + 1, 0
        if at < b.num_rows or not b.num_rows:
            yield b.slice(at)
