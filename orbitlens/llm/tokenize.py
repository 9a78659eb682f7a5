"""Token ids of whole Arrow text columns with a public byte-level BPE vocabulary.

The vocabulary's splitting pattern is applied to a slice of documents at once: characters get a
class (letter, number, space, other) from a table, and piece bounds follow from class changes.
Each distinct piece is encoded once per slice, and its ids are put in place for all occurrences.
Documents with characters whose class differs between Unicode 3.2 and today's tables (or that are
newer) are left to the tokenizer itself, as libraries may disagree on them.
"""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

LETTER, NUMBER, SPACE, OTHER, UNSURE = 0, 1, 2, 3, 4
#: bytes of a piece that the fast encoder gets at most
LONG = 1000
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of every code point."""
    def kind(category: str) -> int:
        return {"L": LETTER, "N": NUMBER, "C": UNSURE if category == "Cn" else OTHER}.get(category[0], OTHER)

    old = unicodedata.ucd_3_2_0
    table = np.full(0x110000, UNSURE, np.uint8)
    for c in range(0x110000):
        now = kind(unicodedata.category(chr(c)))
        if now == kind(old.category(chr(c))):
            table[c] = now
    table[_WHITE] = SPACE
    table[0x180E] = UNSURE
    return table


@dataclass(frozen=True)
class Vocabulary:
    """Paths of one vocabulary as ranks (tiktoken) and as a tokenizer file, with its splitting pattern."""

    ranks: str
    pattern: str
    tokenizer: str

    @staticmethod
    def byte_bpe_50k() -> Vocabulary:
        import public_tokenizers

        return Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary):
    """The fast encoder of short pieces."""
    import tiktoken

    with open(vocabulary.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def reference(vocabulary: Vocabulary):
    """The tokenizer as loaded from its file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary.tokenizer)


@lru_cache(maxsize=2)
def added_tokens(vocabulary: Vocabulary) -> dict[bytes, int]:
    """Texts of added tokens and their ids; tokens that take in what is around them are not supported."""
    with open(vocabulary.tokenizer, encoding="utf-8") as f:
        listed = json.load(f)["added_tokens"]
    if any(t[flag] for t in listed for flag in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{vocabulary.tokenizer} has added tokens that change the text around them")
    return {t["content"].encode(): t["id"] for t in listed}


def id_type(vocabulary: Vocabulary) -> type:
    """The narrowest of 16 and 32 bits that holds all ids."""
    return np.uint16 if reference(vocabulary).get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32


def _contractions(text: np.ndarray, kinds: np.ndarray, first: np.ndarray, start: np.ndarray, bound: np.ndarray) -> None:
    """An apostrophe at the start of a piece takes s, t, m, d, re, ve or ll behind it."""
    n = len(text)
    at = np.flatnonzero(text == 39)
    before = np.where(at > 0, text[at - 1], 0)
    alone = first[at] | (before != 32)
    at = at[start[at] & alone & (at + 1 < n)]
    if not len(at):
        return

    def same(i, c):
        ok = i < n
        return ok & (text[np.minimum(i, n - 1)] == ord(c)) & ~first[np.minimum(i, n - 1)]

    one = same(at + 1, "s") | same(at + 1, "t") | same(at + 1, "m") | same(at + 1, "d")
    two = ((same(at + 1, "r") | same(at + 1, "v")) & same(at + 2, "e")) | (same(at + 1, "l") & same(at + 2, "l"))
    for where, size in ((at[one], 2), (at[~one & two], 3)):
        bound[where + 1] = False
        after = where + size
        bound[after[after < n]] = True


def piece_bounds(text: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Start positions of the pieces of code points ``text``; ``first`` marks the first of each document."""
    kinds = table[text]
    n = len(text)
    start = np.ones(n, bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | first[1:]
    space = kinds == SPACE
    bound = start.copy()
    runs = np.flatnonzero(start)
    if len(runs):
        # the last space of a run goes to what follows in the document: joined if it is a blank, else on its own
        last = np.append(runs[1:], n) - 1
        follows = np.append(~first[runs[1:]], False)
        of_space = space[runs] & follows
        last, head = last[of_space], runs[of_space]
        bound[last] = True
        blank = text[last] == 32
        bound[(last + 1)[blank]] = False
        del head
    _contractions(text, kinds, first, start, bound)
    return np.flatnonzero(bound)


def _added(data: np.ndarray, bounds: np.ndarray, tokens: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, id) of the added tokens inside one document each, leftmost and longest first."""
    found = []
    if tokens:
        text = data.tobytes()
        if any(t in text for t in tokens):
            pattern = re.compile(b"|".join(re.escape(t) for t in sorted(tokens, key=len, reverse=True)))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                found += [(m.start(), m.end(), tokens[m.group()]) for m in pattern.finditer(text, lo, hi)]
    columns = np.array(found, np.int64).reshape(-1, 3)
    return columns[:, 0], columns[:, 1], columns[:, 2]


def encode(data: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids as uint16 or uint32, id bounds of the documents) of a slice of UTF-8 texts."""
    at, end, token = _added(data, bounds, added_tokens(vocabulary))
    if not len(at):
        return _encode_plain(data, bounds, vocabulary)
    # the parts before, between and after added tokens, and the tokens themselves, as texts of their own
    cuts = np.concatenate([bounds, at, end])
    cuts = cuts[np.argsort(cuts, kind="stable")]
    special = np.searchsorted(cuts, at, "right") - 1
    blank = np.ones(len(data), bool)
    for a, b in zip(at.tolist(), end.tolist()):
        blank[a:b] = False
    kept = np.concatenate([[0], np.cumsum(blank)])  # the texts without the tokens, which leave empty parts behind
    ids, cut = _encode_plain(data[blank], kept[cuts], vocabulary)
    sizes = np.diff(cut)
    ids = np.insert(ids, cut[special], token.astype(ids.dtype))
    sizes[special] += 1
    total = np.concatenate([[0], np.cumsum(sizes)])
    return ids, total[np.searchsorted(cuts, bounds, "left")]


def _encode_plain(data: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    enc, whole, kind = encoder(vocabulary), reference(vocabulary), id_type(vocabulary)
    n_docs = len(bounds) - 1
    if not len(data):
        return np.empty(0, kind), np.zeros(n_docs + 1, np.int64)
    table = char_classes()
    text = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each character
    char_bounds = np.searchsorted(lead, bounds)
    first = np.zeros(len(text), bool)
    first[char_bounds[:-1][np.diff(char_bounds) > 0]] = True
    at = piece_bounds(text, first, table)
    owner = np.searchsorted(char_bounds, at, "right") - 1
    unsure = np.zeros(n_docs, bool)
    odd = np.flatnonzero(table[text] == UNSURE)
    if len(odd):
        unsure[np.searchsorted(char_bounds, odd, "right") - 1] = True
        stay = ~unsure[owner] | first[at]  # a document left to the tokenizer counts as one piece
        at, owner = at[stay], owner[stay]
    offsets = np.append(lead[at], len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
    coded = pieces.dictionary_encode()
    # a document left to the tokenizer is one piece; so is a run of one class, which it would not split either
    left = np.zeros(len(coded.dictionary), bool)
    left[coded.indices.to_numpy()[unsure[owner]]] = True
    ids = [whole.encode(x.decode(), add_special_tokens=False).ids if alone or len(x) > LONG else enc.encode_ordinary(x.decode())
           for x, alone in zip(coded.dictionary.to_pylist(), left.tolist())]
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.array([i for x in ids for i in x], kind)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    codes = coded.indices.to_numpy()
    out_sizes = sizes[codes]
    ends = np.cumsum(out_sizes)
    source = np.repeat(begin[codes] - (ends - out_sizes), out_sizes) + np.arange(ends[-1] if len(ends) else 0)
    per_doc = np.zeros(n_docs + 1, np.int64)
    np.add.at(per_doc, owner + 1, out_sizes)
    return flat[source], np.cumsum(per_doc)
