"""Ids of a byte-level BPE vocabulary, equal to those of the ``tokenizers``
library, from a bounded cache of the distinct words each worker meets.

A text is cut before each single space between two words; no
pre-token reaches across such a cut, so the units can be encoded alone.  Units
of Latin letters go to ``tiktoken`` (same ranks, several times faster);
units with other characters, and whole texts with a special token or Unicode
white space, go to ``tokenizers`` itself, whose character tables decide there.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from meterlens.llm.util import as_text

BYTE_BPE = "byte_bpe_50k"
#: Distinct units a worker remembers before it starts anew.
CACHE_UNITS = 700_000

_UNIT = re.compile(rb"[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
_WIDE_WHITE = r"[\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}\x{3000}\x{feff}]"
#: White space that a split on spaces and lines can't express.
_UNEVEN = r"^[ \n]|[ \n]\z|  | \n|\n |\n\n|[\t\r\x0b\x0c]"
_AROUND = (b" ", b"\n\n", b"\t", b"\r", b"\x0b", b"\x0c")
_WIDE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u3000\ufeff]")
_LATIN = re.compile("[\x20-\x7e\t-\r¡-ɏ]*")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_PACK = [struct.Struct(f"<{n}H").pack for n in range(64)]


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < 64 else array("H", ids).tobytes()


class _Cache(dict):
    """unit -> ids; unknown units are encoded, short ones remembered."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, unit: bytes) -> bytes:
        ids = self.encode(unit)
        if len(unit) <= 64:
            self[unit] = ids
        return ids

    def trim(self) -> None:
        if len(self) > CACHE_UNITS:
            self.clear()


class ByteBpe:
    """``json_path`` and ``ranks_path`` hold one vocabulary in two formats."""

    def __init__(self, json_path: str, ranks_path: str) -> None:
        import public_tokenizers
        self.full = Tokenizer.from_file(json_path)
        self.full.no_padding()
        self.full.no_truncation()
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})._core_bpe
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.odd = "|".join([_UNEVEN, _WIDE_WHITE, *map(re.escape, self.special)])
        self.spaced = _Cache(lambda u: self.unit(b" ", u))  # key without its leading space
        self.plain = _Cache(lambda u: self.unit(b"", u))

    def unit(self, prefix: bytes, unit: bytes) -> bytes:
        """uint16 ids of ``prefix`` and a unit."""
        if unit.isalpha():  # ASCII letters are one pre-token
            return _packed(self.fast.encode_single_piece(prefix + unit))
        if b"\n" in unit and unit[0] != 10 and unit[-1] != 10 and not any(u in unit for u in _AROUND):
            first, *rest = unit.split(b"\n")  # each single line end is a pre-token of its own
            line = self.plain[b"\n"]
            return (self.spaced if prefix else self.plain)[first] + b"".join(line + self.plain[r] for r in rest)
        core = unit.rstrip(b".,!?;:")
        text = core.decode("utf-8", "replace")
        if core and _LETTERS.fullmatch(text):
            if len(core) < len(unit):  # letters, then a pre-token of punctuation
                return (self.spaced if prefix else self.plain)[core] + self.plain[unit[len(core):]]
            return _packed(self.fast.encode_single_piece(prefix + unit))
        text = unit.decode("utf-8", "replace")
        if _LATIN.fullmatch(text):
            return _packed(self.fast.encode_ordinary(prefix.decode() + text))
        return self.whole(prefix.decode() + text)

    def whole(self, text: str) -> bytes:
        return _packed(self.full.encode(text, add_special_tokens=False).ids)

    def spaced_words(self, words: list[bytes]) -> list[bytes]:
        """uint16 ids of each word behind a single space."""
        self.trim()
        return list(map(self.spaced.__getitem__, words))

    def trim(self) -> None:
        self.spaced.trim()
        self.plain.trim()

    def encode_column(self, column: pa.Array) -> list[bytes]:
        """uint16 ids of each whole text (null: none), as bytes."""
        self.trim()
        text = as_text(column)
        odd = pc.match_substring_regex(text, self.odd).to_numpy(zero_copy_only=False)
        even = pc.if_else(pa.array(odd), "", text) if odd.any() else text
        lists = pc.split_pattern(even, " ")
        starts = lists.offsets.to_numpy()
        first = np.zeros(len(lists.values), dtype=bool)
        first[starts[:-1]] = True  # a text's first unit has no space before it
        out = self._joined(lists.values, first, starts)
        for i in np.flatnonzero(odd):
            out[i] = self.encode(text[int(i)].as_py())
        return out

    def _joined(self, units: pa.Array, first: np.ndarray, starts: np.ndarray) -> list[bytes]:
        coded = units.dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        heads = units.filter(pa.array(first)).dictionary_encode()
        plain = [self.plain[u] if u else b"" for u in heads.dictionary.cast(pa.binary()).to_pylist()]
        spaced = list(map(self.spaced.__getitem__, words))
        at = coded.indices.to_numpy().astype(np.int64)
        at[first] = len(words) + heads.indices.to_numpy()
        ids = pa.array(spaced + plain, pa.binary()).take(pa.array(at))
        _, offsets, data = ids.buffers()
        data = memoryview(data) if data is not None else memoryview(b"")
        ends = np.frombuffer(offsets, np.int32)[starts + ids.offset]
        return [bytes(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, text: str) -> bytes:
        """uint16 ids of one text with any white space."""
        if any(s in text for s in self.special) or _WIDE.search(text):
            return self.whole(text)
        return b"".join(map(self.plain.__getitem__, _UNIT.findall(text.encode())))


@lru_cache(maxsize=4)
def byte_bpe(json_path: str, ranks_path: str) -> ByteBpe:
    """One encoder per Python worker; files come with the installed package."""
    return ByteBpe(json_path, ranks_path)
