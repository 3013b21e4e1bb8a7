"""Token counts through a compiled finite-state tokenizer.

The vocabulary is compiled into a deterministic transducer over characters whose transitions carry the change
in the number of emitted tokens. At a word start the machine is back in one and the same state whatever came
before, as no piece has a space mark after another character; the compiler checks that. So a chunk's state map
needs only three parts: the stretch before its first word start (its effect depends on the entry state), the
tokens of the whole words inside, and the stretch after its last word start (which fixes the exit state). Such
maps compose associatively, and a scan over the chunk maps gives the counts of the whole text.

Nulls and empty texts have no bytes and no tokens. Each row stands for itself: repeated rows and ids, and rows
without an id, give one row each. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from typing import NamedTuple

import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, texts_of
from .transducer import Machine, Merges

SPACE = "▁"
CHUNK = 1 << 16
#: Words whose count a task keeps; with more, it starts anew.
REMEMBER = 1 << 17


class ChunkMap(NamedTuple):
    """Effect of a chunk: ``tail`` is None while the chunk has no word start inside."""

    head: str
    tokens: int
    tail: str | None


class CountingTokenizer:
    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        usual = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = sorted(usual, key=lambda i: (-model.get_score(i), i))
        words = [model.id_to_piece(i) for i in pieces]
        if any(SPACE in p.lstrip(SPACE) for p in words):
            raise ValueError("a piece has a space mark inside: words are not independent in this vocabulary")
        self.single = {p for p in words if len(p) == 1}
        long = "".join(p for p in words if len(p) > 1)
        self.rules = Merges({p: r for r, p in enumerate(words)})
        alone = "".join(c for c in "\n" if c not in long)
        self.words = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        self.known: dict[str, int] = {}

    def weigh(self, character: str) -> int:
        """Tokens of a character by itself: one, or its bytes where the vocabulary lacks it."""
        return 1 if character in self.single else len(character.encode("utf-8", "replace"))

    def word(self, text: str) -> int:
        """Tokens between two returns to the start state."""
        n = self.known.get(text)
        if n is None:
            machine = Machine(self.rules, self.weigh)
            n = 0
            for i in range(0, len(text), 4096):
                n += machine.read(text[i : i + 4096])
                if len(text) > 4096:
                    machine.stable()
            if len(text) <= 64:
                if len(self.known) >= REMEMBER:
                    self.known.clear()
                self.known[text] = n
        return n

    def chunk(self, text: str) -> ChunkMap:
        return self._map(self.words.findall(text))

    def _map(self, words: list[str], tokens: int = 0) -> ChunkMap:
        if len(words) < 2:
            return ChunkMap(words[0] if words else "", tokens, None)
        get = self.known.get
        for w in words[1:-1]:
            n = get(w)
            tokens += self.word(w) if n is None else n
        return ChunkMap(words[0], tokens, words[-1])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First a, then b."""
        between = self.words.findall((a.head if a.tail is None else a.tail) + b.head)
        left = [a.head] if a.tail is not None else []
        right = [b.tail] if b.tail is not None else []
        return self._map([*left, *between, *right], a.tokens + b.tokens)

    def total(self, m: ChunkMap) -> int:
        return m.tokens + sum(map(self.word, filter(None, (m.head, m.tail))))

    def count(self, text: str, size: int = CHUNK) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        maps = [self.chunk(marked[i : i + size]) for i in range(0, len(marked), size)]
        while len(maps) > 1:  # pairs of neighbours, level by level: the scan's reduction
            maps = [reduce(self.compose, maps[i : i + 2]) for i in range(0, len(maps), 2)]
        return self.total(maps[0])


@lru_cache(maxsize=2)
def compiled(model_path: str) -> CountingTokenizer:
    return CountingTokenizer(model_path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row, without begin, end or special tokens."""

    def make():
        tokenizer = compiled(model_path)
        return lambda texts: [[tokenizer.count(t) for t in texts]]

    rows = texts_of(docs, id_col, text_col).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = map_texts(rows, "doc_id long, n_bytes long, n_tokens long", make, carry=2)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
