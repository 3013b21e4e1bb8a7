"""Byte-level BPE: a streaming encoder with bounded lookahead, and an incremental decoder.

Encoding reads a pre-token's bytes once, from left to right, through the transducer of the merge list. Tokens leave
as soon as no continuation can change them. The merge list's sufficient lookahead, computed once, bounds how far
that lies behind the reading position. A text is read block by block: before a space that follows another character
a pre-token always ends, so blocks of some 65,536 characters are cut there. Beside the text itself a task holds one block, or
the longest stretch without such a space, whatever the text's length. Decoding turns ids into bytes and
bytes into text through an incremental UTF-8 machine that holds at most one unfinished character.

A null text is empty: no ids, and the digests of the empty string. Each row stands for itself: repeated rows and
ids, and rows without an id, give one row each. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import codecs
import contextlib
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
from pyspark.sql import DataFrame

from .common import columns_of, map_texts, texts_of
from .transducer import Machine, Merges

#: Words whose result a task keeps, twice: the latest ones, and those of the round before, from which used ones come back.
REMEMBER = 1 << 16
#: As many as that where nothing else shares the task's memory.
REMEMBER_MORE = 1 << 18
#: Texts whose ids a task holds at once.
ROWS = 256
SHORT = 48
BLOCK = 1 << 16
#: Fixed values of the vocabulary format: the bytes that stand for themselves, and the pattern of pre-tokens.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
PRE_TOKENS = r"'(?:[stmd]|re|ve|ll)| ?{L}+| ?{N}+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+"
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    plain, out, spare = set(PLAIN_BYTES), [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


@lru_cache(maxsize=3)
def pre_tokens(last: int = sys.maxunicode) -> re.Pattern:
    """The pre-token pattern with letters and numbers as ranges of their Unicode classes, for texts up to a code point.

    Short ranges match faster, and most texts need only the first planes.
    """

    def ranges(kind: str) -> str:
        found: list[list[int]] = []
        for c in range(last + 1):
            if unicodedata.category(chr(c))[0] == kind:
                if found and found[-1][1] == c - 1:
                    found[-1][1] = c
                else:
                    found.append([c, c])
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)

    letters, numbers = ranges("L"), ranges("N")
    pattern = PRE_TOKENS.replace("{L}", f"[{letters}]").replace("{N}", f"[{numbers}]")
    return re.compile(pattern.replace("{l}", letters).replace("{n}", numbers).replace("{s}", WHITE_SPACE))


#: A space that starts a pre-token, whatever follows.
START = re.compile(f"(?<=[^{WHITE_SPACE}]) ")


def blocks_of(text: str, start: int, end: int, size: int = BLOCK) -> Iterator[str]:
    """The stretch of a text in blocks that no pre-token crosses."""
    while end - start > size and (cut := START.search(text, start + size, end)):
        yield text[start : cut.start()]
        start = cut.start()
    if start < end:
        yield text[start:end]


def words_of(text: str) -> list[str]:
    """Pre-tokens of a block."""
    for last, coding, width in ((0xFF, "latin-1", 1), (0xFFFF, "utf-16-le", 2)):
        with contextlib.suppress(UnicodeEncodeError):
            if len(text.encode(coding)) == width * len(text):
                return pre_tokens(last).findall(text)
    return pre_tokens().findall(text)


class ByteCodec:
    def __init__(self, path: str, remember: int = REMEMBER):
        self.remember = remember
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.rules = Merges({a + b: r for r, (a, b) in enumerate(pairs)}, {a + b: len(a) for a, b in pairs}, byte_symbols())
        if len(self.rules.ranks) != len(pairs):
            raise ValueError("two merges form one piece")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        symbols = byte_symbols()
        self.symbols = str.maketrans({chr(b): s for b, s in enumerate(symbols)})
        back = {s: b for b, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(back[s] for s in p) for p, i in self.vocab.items()} | {i: p.encode() for p, i in self.special.items()}
        self.id_of = [0, *(self.vocab[p] for p in self.rules.names[1:])]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @property
    def lookahead(self) -> int:
        if not hasattr(self, "_lookahead"):
            self._lookahead = self.rules.sufficient_lookahead()
        return self._lookahead

    def ids(self, pieces: list[int]) -> bytes:
        return pack(f"<{len(pieces)}I", *map(self.id_of.__getitem__, pieces))

    def stream(self, data: bytes) -> Iterator[bytes]:
        """Ids (little-endian, 32 bits) of one pre-token, as soon as they are stable."""
        machine = Machine(self.rules)
        step = max(256, self.lookahead)
        for i in range(0, len(data), step):
            machine.read(data[i : i + step].decode("latin-1").translate(self.symbols))
            yield self.ids(machine.stable())
        yield self.ids(machine.finish())

    def word(self, text: str) -> bytes:
        out = self.older.get(text)
        if out is None:
            data = text.encode("utf-8", "replace")
            if len(data) > SHORT:
                return b"".join(self.stream(data))
            machine = Machine(self.rules)
            machine.read(data.decode("latin-1").translate(self.symbols))
            out = self.ids(machine.finish())
        if len(self.known) >= self.remember:
            self.older = dict(self.known)
            self.known.clear()
        self.known[text] = out
        return out

    def encode(self, text: str) -> Iterator[bytes]:
        """Blocks of ids of a whole text; special strings inside count as their token."""
        start = 0
        for special in self.cut.finditer(text) if self.cut else ():
            yield from self.plain(text, start, special.start())
            yield pack("<I", self.special[special.group()])
            start = special.end()
        yield from self.plain(text, start, len(text))

    def plain(self, text: str, start: int, end: int) -> Iterator[bytes]:
        """Blocks of ids of a stretch without special strings."""
        get = self.known.get
        for block in blocks_of(text, start, end):
            yield b"".join([get(w) or self.word(w) for w in words_of(block)])

    def decode(self, blocks: Iterable[bytes]) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        of = self.bytes_of.__getitem__
        for ids in blocks:
            yield machine.decode(b"".join(map(of, np.frombuffer(ids, "<u4").tolist())))
        yield machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def codec(path: str, remember: int = REMEMBER) -> ByteCodec:
    return ByteCodec(path, remember)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded again."""

    def make():
        coder = codec(path, REMEMBER_MORE)

        def work(texts: list[str]) -> list[list]:
            counts, ids_digests, text_digests = [], [], []
            for text in texts:
                n, ids_digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()

                def seen():
                    nonlocal n
                    for ids in coder.encode(text):
                        n += len(ids) // 4
                        ids_digest.update(ids)
                        yield ids

                for piece in coder.decode(seen()):
                    text_digest.update(piece.encode("utf-8"))
                counts.append(n)
                ids_digests.append(ids_digest.hexdigest())
                text_digests.append(text_digest.hexdigest())
            return [counts, ids_digests, text_digests]

        return work

    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids themselves."""

    def make():
        coder = codec(path)
        return lambda texts: [[np.frombuffer(b"".join(coder.encode(t)), "<u4").astype("int32") for t in texts]]

    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, ids array<int>", make)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; null ids are an empty text."""
    def make():
        coder = codec(path)
        return lambda lists: [["".join(coder.decode([np.asarray(x or [], "<u4").tobytes()])) for x in lists]]

    return map_texts(columns_of(encoded, id_col, ids_col), "doc_id long, text string", make)


def encoded_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) per row."""

    def make():
        coder = codec(path)

        def work(texts: list[str]) -> list[list]:
            ids = [b"".join(coder.encode(t)) for t in texts]
            back = [hashlib.sha256("".join(coder.decode([i])).encode("utf-8")).hexdigest() for i in ids]
            return [[len(i) // 4 for i in ids], [np.frombuffer(i, "<u4").astype("int32") for i in ids], [hashlib.sha256(i).hexdigest() for i in ids], back]

        return work

    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string", make, rows=ROWS)
