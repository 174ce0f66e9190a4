"""Whole texts to token ids with a public tokenizer, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import slices

#: Pieces a worker remembers, and the length in bytes up to which it remembers one.
REMEMBER, LONGEST = 500_000, 200

_MARK = "\x01"
# Byte-level entries show a byte as a printable character: itself where it is one in Latin-1, else the next free one from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
_BYTES = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
# White space of any kind.
_SPACE = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class PieceEncoder:
    """Token ids of whole texts, put together from the ids of their pieces.

    A subclass says where a text may be cut without changing its ids (`_marked`)
    and how a piece is encoded (`_plain`). Cutting, coding and putting together
    are done for a whole slice of texts at once; Python sees distinct pieces only.
    """

    def __init__(self, width: type, remember: int = REMEMBER):
        self.width, self.remember = width, remember
        self._index: dict[str, int] = {}
        self._ids, self._used, self._kept = np.zeros(1 << 20, width), 0, 0
        self._start, self._count = np.zeros(remember + 1, np.int64), np.zeros(remember + 1, np.int64)
        self.entries = self._bytes_of()
        self.sizes = np.array([len(e) for e in self.entries], np.int64)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _bytes_of(self) -> list[bytes]:
        """The bytes that each id stands for."""
        raise NotImplementedError

    def _apart(self, texts: pa.Array) -> pa.Array:
        """Texts that are encoded whole."""
        return pc.match_substring(texts, _MARK)

    def _marked(self, texts: pa.Array) -> pa.Array:
        """The texts with a mark at each cut."""
        raise NotImplementedError

    def __call__(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return np.empty(0, self.width), np.zeros(0, np.int64)
        apart = self._apart(texts)
        whole = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        pieces = pc.split_pattern(self._marked(pc.if_else(apart, pa.scalar("", pa.large_string()), texts) if len(whole) else texts), _MARK)
        ends = np.cumsum(pc.list_value_length(pieces).to_numpy().astype(np.int64))
        coded = pieces.flatten().dictionary_encode()
        spot = coded.indices.to_numpy().astype(np.int64)
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(whole):  # such a text left one empty piece, which stands for it
            spot[ends[whole] - 1] = len(known) + np.arange(len(whole))
            known += texts.take(pa.array(whole)).to_pylist()
        start, count = self._found(known)
        each = count[spot]
        total = np.cumsum(each)
        where = np.repeat(start[spot] - (total - each), each) + np.arange(total[-1])
        ids = self._ids[where]
        self._used = self._kept  # ids of pieces that are not remembered are let go
        return ids, np.diff(np.r_[0, total[ends - 1]])

    def _found(self, known: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids start in the store, and how many they are."""
        at = np.fromiter(map(self._index.get, known, repeat(-1)), np.int64, len(known))
        start, count = self._start[at], self._count[at]
        new = np.flatnonzero(at < 0).tolist()
        short = [i for i in new if len(known[i]) <= LONGEST]
        kept = short[: self.remember - len(self._index)]  # these come first in the store
        for some, keep in ((kept, True), (short[len(kept) :] + [i for i in new if len(known[i]) > LONGEST], False)):
            joined = [i for i in some if known[i][:1] in (" ", "\n") and not known[i][-1].isspace()]
            alone = sorted(set(some).difference(joined))
            for rows, ids_of in ((joined, self._joined), (alone, self._each)):
                for first in range(0, len(rows), 16384):
                    part = rows[first : first + 16384]
                    pieces = [known[i] for i in part]
                    ids, counts = ids_of(pieces)
                    if self._used + len(ids) > len(self._ids):
                        self._ids = np.concatenate([self._ids, np.zeros(len(self._ids) + len(ids), self.width)])
                    self._ids[self._used : self._used + len(ids)] = ids
                    start[part], count[part] = self._used + np.cumsum(counts) - counts, counts
                    self._used += len(ids)
                    if keep:
                        slot = len(self._index)
                        self._start[slot : slot + len(part)], self._count[slot : slot + len(part)] = start[part], counts
                        self._index.update(zip(pieces, range(slot, slot + len(part))))
                        self._kept = self._used
        return start, count

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in a row, and how many each has."""
        found = self._plain(pieces)
        return np.array([i for ids in found for i in ids], self.width), np.array([len(ids) for ids in found], np.int64)

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `_each`, for pieces that may stand one after the other: encoded as one text and told apart by their bytes."""
        ids = np.array(self._plain(["".join(pieces)])[0], self.width)
        bounds = np.cumsum([len(p.encode()) for p in pieces])
        ends = np.cumsum(self.sizes[ids])
        reached = np.searchsorted(ends, bounds, "right")
        if reached[0] and np.array_equal(ends[reached - 1], bounds) and reached[-1] == len(ids):
            return ids, np.diff(np.r_[0, reached])
        return self._each(pieces)


class Encoder(PieceEncoder):
    """Ids by a tokenizer file.

    A byte-level tokenizer that cuts words by pattern always has a cut where
    white space follows other text. A tokenizer of another kind, or a text with
    one of its special strings, is encoded whole; with `plain`, special strings
    are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False, remember: int = REMEMBER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cut = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and not parts.get("normalizer") and not parts.get("truncation") and not parts.get("padding")
        )
        self.special = [] if plain else [t["content"] for t in parts.get("added_tokens", [])]
        super().__init__(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32, remember)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes_of(self) -> list[bytes]:
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        return [bytes(_BYTES[c] for c in name) if all(c in _BYTES for c in name) else name.encode() for name in names]

    def _apart(self, texts: pa.Array) -> pa.Array:
        if not self.by_piece:
            return pa.array(np.ones(len(texts), bool))
        apart = super()._apart(texts)
        for special in self.special:
            apart = pc.or_(apart, pc.match_substring(texts, special))
        return apart

    def _marked(self, texts: pa.Array) -> pa.Array:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", _MARK + "\n")
        odd = pc.match_substring_regex(texts, _SPACE + r"[ \n]")  # several in a row: one cut, before the first
        if pc.any(odd).as_py():
            marked = pc.replace_with_mask(marked, odd, pc.replace_substring_regex(texts.filter(odd), f"({_SPACE}+)", _MARK + r"\1"))
        return marked


class PieceModel(PieceEncoder):
    """Ids of texts that begin with a blank, by a sentence-piece model that puts one there itself.

    No entry of such a model has its blank mark behind another character, so
    nothing is merged across the start of a run of blanks: texts are cut there.
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.by_piece = not any("▁" in e.lstrip("▁") for e in entries)
        self._blank = [self.model.piece_to_id("▁")]
        super().__init__(np.uint16 if len(entries) <= 1 << 16 else np.uint32, remember)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        ids = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [self._blank if t == " " else found for t, found in zip(texts, ids)]

    def _bytes_of(self) -> list[bytes]:
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        return [bytes([int(n[3:-1], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def _apart(self, texts: pa.Array) -> pa.Array:
        # The blank mark itself counts as a blank.
        return pc.or_(super()._apart(texts), pc.match_substring(texts, "▁")) if self.by_piece else pa.array(np.ones(len(texts), bool))

    def _marked(self, texts: pa.Array) -> pa.Array:
        marked = pc.replace_substring(texts, " ", _MARK + " ")
        odd = pc.match_substring(texts, "  ")
        if pc.any(odd).as_py():
            marked = pc.replace_with_mask(marked, odd, pc.replace_substring_regex(texts.filter(odd), "( +)", _MARK + r"\1"))
        return marked


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder per worker, kept between tasks."""
    return Encoder(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(batch, texts) with about `most` bytes of text each; null is empty."""
    for batch in slices(batches, column, most):
        yield batch, pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)
