"""Tokenizers of the installed libraries, which encode each different word once.

Where a tokenizer never joins what stands on both sides of a place, the ids of a text are
those of its pieces between such places, one after the other. Pieces repeat, so texts are
cut, and pieces told apart, in Arrow arrays, and the ids of pieces are kept in a memory of
bounded size; every text is encoded whole. Pieces without blanks are given to the library
many at a time, where the ids tell at which of them a piece begins or ends. Files
are named by path, a parameter of whoever calls; a worker loads each once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HELD_BYTES = 64_000_000  # of the pieces in memory and their ids
WORDS_JOINED = 1000  # pieces given to the library as one text
SLICE_BYTES = 8_000_000  # of the texts encoded at a time

#: White space, a superset of what any of the tokenizers takes for it.
_WHITE = r"\s\v\x{1c}-\x{1f}\x{85}\p{Z}"
_ODD = f"[{_WHITE}] | [{_WHITE}]|^[{_WHITE}]|[{_WHITE}]$"
#: ASCII marks apart from apostrophes, and from what special tokens are written with.
_MARKS = r"[!-&(-/:;=?@\[-`{}~]"
_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")


class Rules(NamedTuple):
    """What the encoder must know of a tokenizer."""

    encode: Callable[[list[str]], list[list[int]]]  # ids of each of several texts
    join: Callable[[list[str]], str]  # a text made of pieces, between which no id stretches
    begins: np.ndarray  # for each id, whether a piece begins with it
    ends: np.ndarray | None  # or whether one ends with it
    plain: str  # pattern of the pieces that may be joined
    cut: Callable[[pa.Array], pa.Array]  # texts -> lists of pieces
    same: Callable[[pa.Array], pa.Array] | None = None  # pieces -> pieces with the same ids


def public_path(name: str) -> str:
    """Place of a file of the installed vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def by_single_spaces(texts: pa.Array) -> pa.Array:
    """Pieces of space and text that start at single spaces between words, without that space."""
    odd = pc.match_substring_regex(texts, _ODD)
    easy = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    hard = [[p[1:] for p in _BEFORE_WORD.split(" " + t)] for t in texts.filter(odd).to_pylist()]
    if not hard:
        return easy
    both = pa.concat_arrays([easy, pa.array(hard, easy.type)])
    at = np.empty(len(texts), np.int64)
    odd = np.asarray(odd)
    at[~odd], at[odd] = np.arange(len(easy)), np.arange(len(easy), len(texts))
    return both.take(pa.array(at))


def by_blanks(texts: pa.Array) -> pa.Array:
    """Pieces between blanks, tabs and line ends, for tokenizers that drop white space.

    Marks that stand between a letter and white space are a piece of their own, as they are
    a word of their own.
    """
    parted = pc.replace_substring_regex(texts, rf"(\pL)({_MARKS}+)([ \n\t\r]|$)", r"\1 \2\3")
    return pc.split_pattern(pc.replace_substring_regex(parted, r"[\n\t\r]", " "), " ")


def lowered(pieces: pa.Array) -> pa.Array:
    """ASCII letters in lower case in pieces of nothing else, for tokenizers that lower case."""
    return pc.if_else(pc.match_substring_regex(pieces, "^[A-Za-z]+$"), pc.ascii_lower(pieces), pieces)


def whole(texts: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.arange(len(texts) + 1)), texts)


def _lists(sizes: list[np.ndarray], values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *values]), pa.int32())
    )


class Encoder:
    """Ids of texts."""

    def __init__(self, rules: Rules, held_bytes: int = HELD_BYTES) -> None:
        self._rules, self._held_bytes = rules, held_bytes
        self._forget()

    def _forget(self) -> None:
        self._pieces = pa.array([], pa.large_string())
        self._ids = _lists([], [])

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text as 32-bit integers; none for a null."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        cut = self._rules.cut(texts)
        told = cut.flatten().dictionary_encode()
        pieces = told.dictionary
        known = pc.index_in(pieces, value_set=self._pieces)
        new = pieces.filter(known.is_null())
        all_ids = pa.concat_arrays([self._ids, self._encoded(new)])
        at = np.asarray(known.fill_null(0)).astype(np.int64)
        at[np.asarray(known.is_null())] = len(self._ids) + np.arange(len(new))
        self._pieces, self._ids = pa.concat_arrays([self._pieces, new]), all_ids
        if self._pieces.nbytes + self._ids.nbytes > self._held_bytes:
            self._forget()
        found = all_ids.take(pa.array(at[np.asarray(told.indices)]))
        offsets = np.asarray(found.offsets)[np.asarray(cut.offsets)]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found.values)

    def _encoded(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of each of different pieces."""
        rules = self._rules
        if rules.same:
            told = rules.same(pieces).dictionary_encode()
            return self._by_library(told.dictionary).take(told.indices)
        return self._by_library(pieces)

    def _by_library(self, pieces: pa.Array) -> pa.ListArray:
        rules = self._rules
        plain = np.asarray(pc.match_substring_regex(pieces, rules.plain))
        order, sizes, values = [], [], []
        at = np.flatnonzero(plain)
        alone = [np.flatnonzero(~plain)]
        for first in range(0, len(at), WORDS_JOINED):
            some = at[first : first + WORDS_JOINED]
            ids = np.array(rules.encode([rules.join(pieces.take(pa.array(some)).to_pylist())])[0], np.int32)
            if rules.ends is None:
                cuts = np.append(np.flatnonzero(rules.begins[ids]), len(ids))
            else:
                cuts = np.concatenate(([0], np.flatnonzero(rules.ends[ids]) + 1))
            if len(cuts) == len(some) + 1 and cuts[0] == 0 and cuts[-1] == len(ids):
                order.append(some)
                sizes.append(np.diff(cuts))
                values.append(ids)
            else:
                alone.append(some)
        rest = np.concatenate(alone)
        found = rules.encode([rules.join([p]) for p in pieces.take(pa.array(rest)).to_pylist()])
        order.append(rest)
        sizes.append(np.array([len(x) for x in found], np.int64))
        values += [np.array(x, np.int32) for x in found]
        back = np.empty(len(pieces), np.int64)
        back[np.concatenate(order)] = np.arange(len(pieces))
        return _lists(sizes, values).take(pa.array(back))


@lru_cache(maxsize=4)
def bpe_words(path: str) -> Encoder:
    """A tokenizer that drops white space, lower cases, and marks the ends of words."""
    tokenizer = _tokenizer(path)
    ends = _flags(tokenizer, lambda said: said.endswith("</w>"))
    return Encoder(
        Rules(_ids_of(tokenizer), " ".join, ~ends, ends, r"^\pL+$", by_blanks, lowered)
    )


@lru_cache(maxsize=4)
def bpe_bytes(path: str) -> Encoder:
    """Byte-level ids of space and text; special tokens' strings are plain text."""
    tokenizer = _tokenizer(path)
    tokenizer.encode_special_tokens = True
    begins = np.array([entry.startswith(b" ") for entry in byte_entries(path)])
    return Encoder(
        Rules(_ids_of(tokenizer), lambda ps: " " + " ".join(ps), begins, None, _plain(" "), by_single_spaces)
    )


@lru_cache(maxsize=4)
def bpe_pieces(path: str) -> Encoder:
    """Ids of a sentence-piece model, which itself puts a space before a text."""
    model = _model(path)
    entries = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    stretches = any("▁" in entry.lstrip("▁") for entry in entries)
    return Encoder(
        Rules(
            lambda texts: model.encode(texts, num_threads=1),
            " ".join,
            np.array([entry.startswith("▁") for entry in entries]),
            None,
            "^$" if stretches else _plain(" ▁"),
            whole if stretches else by_single_spaces,
        )
    )


def byte_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    tokenizer = _tokenizer(path)
    # Printable bytes stand for themselves, the others for 256, 257, ... in order.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    entries = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for said, i in tokenizer.get_vocab(with_added_tokens=True).items():
        entries[i] = bytes(of[c] for c in said) if all(c in of for c in said) else said.encode()
    return entries


def piece_entries(path: str) -> list[bytes]:
    """The bytes of each id of a sentence-piece model."""
    model = _model(path)
    entries = []
    for i in range(model.get_piece_size()):
        said = model.id_to_piece(i)
        entries.append(bytes([int(said[1:-1], 16)]) if model.is_byte(i) else said.replace("▁", " ").encode())
    return entries


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> list[slice]:
    """Runs of neighbouring texts of ``most`` bytes together at most, or of one text."""
    out, first, total = [], 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and total + size > most:
            out.append(slice(first, i))
            first, total = i, 0
        total += size
    if first < len(texts):
        out.append(slice(first, len(texts)))
    return out


def _plain(without: str) -> str:
    """Pattern of pieces that hold none of some characters and no white space at their ends."""
    inner = f"[^{without}]"
    edge = f"[^{without}{_WHITE}]"
    return f"(?s)^{edge}({inner}*{edge})?$"


def _flags(tokenizer, test: Callable[[str], bool]) -> np.ndarray:
    flags = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
    flags[[i for said, i in tokenizer.get_vocab(with_added_tokens=True).items() if test(said)]] = True
    return flags


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _ids_of(tokenizer) -> Callable[[list[str]], list[list[int]]]:
    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode
