"""Tokenizing texts by memoised pieces.

The public tokenizers split a text into pieces that are encoded on their own, so a piece that was seen before need not
be encoded again. Texts are split where the tokenizer's own pre-tokenizer always splits, distinct pieces are encoded
once per worker process (up to MOST of them, then the memo starts anew), and their ids are gathered back; the ids are those
of encoding the whole text."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .base import ragged

MOST = 800_000
# Letters and digits that stay letters and digits in every normal form, whatever stands beside them. Others (U+0130, whose
# lower case ends in a combining mark, or letters that normal forms take apart) can join the signs after them.
_STABLE = (
    r"0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"  # Latin
    r"\x{391}-\x{3A1}\x{3A3}-\x{3A9}\x{3AC}-\x{3CE}\x{400}-\x{481}\x{48A}-\x{52F}"  # Greek, Cyrillic
    r"\x{5D0}-\x{5EA}\x{621}-\x{63A}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}"
)
#: Where a piece always ends: such a letter or digit before a sign that is in no contraction and no special token.
_EDGE = rf"([{_STABLE}])([!\"#$%&()*+,\-./:;=?@\[\]^_{{}}~])"
_MEMO: dict[tuple[str, bool], Pieces] = {}


def tokenizer(name: str):
    """The public tokenizer `name`, in a task or on the driver."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))


def let_go() -> None:
    """Free the pieces that this process keeps: operators that don't encode call it, as a worker goes from one to another."""
    _MEMO.clear()


class Pieces:
    """Token ids of pieces, and the characters at which tokens start and end in their piece."""

    def __init__(self, name: str, offsets: bool = False):
        self.tok, self.offsets = tokenizer(name), offsets
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.begin, self.end, self.counts = (np.zeros(0, np.int32) for _ in range(4))
        self.first = np.zeros(0, np.int64)

    @classmethod
    def of(cls, name: str, offsets: bool = False) -> Pieces:
        """The pieces that this process keeps for a tokenizer, across tasks."""
        return _MEMO[name, offsets] if (name, offsets) in _MEMO else _MEMO.setdefault((name, offsets), cls(name, offsets))

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces in the tables, after encoding those that are new."""
        if len(self.known) > MOST:
            self.clear()
        found = list(map(self.known.get, pieces))
        new = [p for p, at in zip(pieces, found, strict=True) if at is None]  # pieces are distinct
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            got = (self.tok.encode_batch if self.offsets else self.tok.encode_batch_fast)(part, add_special_tokens=False)
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part)), strict=True))
            self.counts = np.concatenate([self.counts, np.fromiter(map(len, got), np.int32, len(got))])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(x.ids for x in got), np.int32)])
            if self.offsets:
                at = np.array([o for x in got for o in x.offsets], np.int32).reshape(-1, 2)
                self.begin, self.end = np.concatenate([self.begin, at[:, 0]]), np.concatenate([self.end, at[:, 1]])
        if new:
            self.first = np.cumsum(self.counts, dtype=np.int64) - self.counts
            after = iter(map(self.known.__getitem__, new))
            found = [next(after) if at is None else at for at in found]
        return np.fromiter(found, np.int64, len(pieces))


def encode_words(texts: pa.Array, cache: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many texts one after another, and the number of each text's ids. For tokenizers that drop white space and
    part letters and digits from signs."""
    split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.fill_null(texts, ""), _EDGE, r"\1 \2"))
    coded = pc.dictionary_encode(split.flatten())
    coded = coded if isinstance(coded, pa.DictionaryArray) else coded.combine_chunks()
    where = cache.look_up(coded.dictionary.to_pylist())
    # a table of these words alone: small enough to stay in a processor's cache
    counts = cache.counts[where]
    own = cache.ids[ragged(cache.first[where], counts)]
    first = np.cumsum(counts, dtype=np.int64) - counts
    at = coded.indices.to_numpy(zero_copy_only=False)
    n = counts[at]
    ids = own[ragged(first[at], n)]
    offsets = split.offsets.to_numpy()
    upto = np.concatenate([[0], np.cumsum(n)])
    return ids, upto[offsets[1:] - offsets[0]] - upto[offsets[:-1] - offsets[0]]


def _plain(text: str) -> bool:
    """Whether a piece starts at every space of the text and at no other place that matters."""
    if text[:1] == " " or text[-1:] == " " or "<|" in text or any(x in text for x in ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")):
        return False
    return text.isascii() and not any(x in text for x in "\v\f\x1c\x1d\x1e\x1f") or not any(x.isspace() and x not in " \n\t\r" for x in set(text))


def encode_spans(texts: list[str], cache: Pieces) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, first and end characters of the tokens of each text. For byte-level tokenizers, whose pieces start at a space.

    A single space between two other characters always starts a piece. Texts with other runs of white space at a space
    are encoded as they are."""
    plain = [bool(t) and _plain(t) for t in texts]
    split = pc.split_pattern(pa.array([t if p else "" for t, p in zip(texts, plain, strict=True)], pa.string()), " ")
    at = split.offsets.to_numpy()
    # all but the first word of a text have their space before them
    spaced = np.full(at[-1], True)
    spaced[at[:-1]] = False
    flat = pc.binary_join_element_wise(pa.array(np.where(spaced, " ", ""), pa.string()), split.flatten(), "")
    coded = pc.dictionary_encode(flat)
    where = cache.look_up(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    n = cache.counts[where].astype(np.int64)
    take = ragged(cache.first[where], n)
    size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(size) - size
    base = np.repeat(begins - np.repeat(begins[at[:-1]], np.diff(at)), n)
    ids, begin, end = cache.ids[take], cache.begin[take] + base, cache.end[take] + base
    upto = np.concatenate([[0], np.cumsum(n)])[at]
    out = []
    for k, text in enumerate(texts):
        if plain[k] or not text:
            part = slice(upto[k], upto[k + 1])
            out.append((ids[part], begin[part], end[part]))
        else:
            e = cache.tok.encode(text, add_special_tokens=False)
            o = np.array(e.offsets, np.int64).reshape(-1, 2)
            out.append((np.array(e.ids, np.int64), o[:, 0], o[:, 1]))
    return out
