"""Tokenizers against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tonearm.llm import bpe_codec, token_counts
from tonearm.llm.transducer import Machine

LETTERS = "ab the  tion\n\té▁ ßñ\u200b\xa0你😀.,'0123456789<s>aaaa  ½²Ⅷ٣\x1c\x85\u3000\r"
HARD = ["", " ", "a" * 5000, "ab" * 3000, " " * 3001, "ationation" * 800, "x" * 70 + "😀" * 50, "=" * 3000, "é" * 999]


def test_blocks_change_no_pre_token():
    rng = random.Random(3)
    texts = ["".join(rng.choice(LETTERS + "     ") for _ in range(rng.randint(0, 300))) for _ in range(300)] + [" " * 50, "x" * 50, "a  b   c " * 20, ""]
    for text in texts:
        for size in (1, 7, 40):
            blocks = list(bpe_codec.blocks_of(text, 0, len(text), size))
            assert "".join(blocks) == text
            assert [w for b in blocks for w in bpe_codec.words_of(b)] == bpe_codec.words_of(text), text


def test_memory_does_not_grow_with_the_text():
    import tracemalloc

    coder, part = bpe_codec.ByteCodec(P.path("byte_bpe_50k.json")), "some plain words, 12 of them; naïve <|endoftext|> and more. " * 1000
    peaks = []
    for times in (4, 40):
        text = part * times
        sum(map(len, coder.encode(part)))
        tracemalloc.start()
        assert sum(len(t) for t in coder.decode(coder.encode(text))) == len(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 30e6


def random_texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("size", [1 << 16, 5, 1])
def test_counts_match_the_library_for_any_chunks(size):
    own, library = token_counts.compiled(P.path("piece_bpe_32k.model")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for text in random_texts(400) + HARD * (size > 5):
        assert own.count(text, size) == len(library.encode(text)), text


def test_ids_and_text_match_the_library():
    own, library = bpe_codec.codec(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for text in [t + x for t in random_texts(400) for x in ("", "<|endoftext|> it's we're")] + HARD:
        blocks = list(own.encode(text))
        ids = np.frombuffer(b"".join(blocks), "<u4").tolist()
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert "".join(own.decode(blocks)) == library.decode(want, skip_special_tokens=False)


def test_pending_tokens_stay_within_the_sufficient_lookahead():
    own = bpe_codec.codec(P.path("byte_bpe_50k.json"))
    rng, bound = random.Random(3), own.lookahead + own.rules.longest
    for alphabet in ("ab", "=-", "theinga", "0123456789"):
        machine = Machine(own.rules)
        for _ in range(600):
            machine.read(rng.choice(alphabet))
            machine.stable()
            assert len(machine.last) - 1 <= bound


def test_queries_over_odd_rows(odd_docs, no_docs):
    sp, hf = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.select("doc_id", "text").collect())
    counted = token_counts.token_counts(odd_docs, P.path("piece_bpe_32k.model"), limit=5).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counted) == sorted((a, b, len(t.encode()), len(sp.encode(t))) for a, b, t in texts)
    assert all(r.over_limit == (r.n_tokens > 5) for r in counted)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    coded = bpe_codec.round_trip(odd_docs, P.path("byte_bpe_50k.json")).collect()
    want = [(a, b, sha(np.array(hf.encode(t, add_special_tokens=False).ids, "<u4").tobytes()), sha(t.encode())) for a, b, t in texts]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_sha256, r.decoded_sha256) for r in coded) == sorted(want)
    assert bpe_codec.decode_ids(bpe_codec.encode_ids(odd_docs, P.path("byte_bpe_50k.json")), P.path("byte_bpe_50k.json")).count() == len(texts)
    for empty in (token_counts.token_counts(no_docs, P.path("piece_bpe_32k.model")), bpe_codec.round_trip(no_docs, P.path("byte_bpe_50k.json"))):
        assert empty.count() == 0
