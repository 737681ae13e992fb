"""Token counts and SentencePiece ids against the public libraries."""

import random

import public_tokenizers as public
import pytest
import sentencepiece
from llm_fixtures import ODD, empty, frame, invented
from tokenizers import Tokenizer

from ledgerpulse.llm import pieces, sentence_pieces, token_counts

BPE, MODEL = str(public.path("word_bpe_49k.json")), str(public.path("piece_bpe_32k.model"))
STRANGE = ["İstanbul ΣΑΣ é <|startoftext|>x<|endoftext|> <|STARTOFTEXT|> don't I'll 123 ٣", "a\x1cb \x85 　b",
           "aaaaaaaaaaaaaaaa hahahahaha !!!!!!", "😀😀 ﬁ ① 𝔘𝔫 日本語 한국어", "  two  blanks \n x \n\n", "<s> <0x0A> <unk>"]


def test_counts_equal_the_library(spark):
    rows = invented(60) + list(enumerate(STRANGE, 5000)) + ODD
    got = token_counts.token_counts(frame(spark, rows, "n_tokens"), BPE).collect()
    library = Tokenizer.from_file(BPE)
    want = sorted((str(i), len(library.encode(t or "", add_special_tokens=False).ids), len((t or "").encode()))
                  for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_bytes"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert token_counts.token_counts(empty(spark), BPE).count() == 0


def test_ids_equal_the_library_and_come_back(spark):
    rows = invented(40) + list(enumerate(STRANGE, 5000)) + ODD
    encoded = sentence_pieces.encode(frame(spark, rows, "ids"), MODEL, chunk=300)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted((str(i), library.encode(t or "")) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in encoded.collect()) == want
    back = sentence_pieces.decode(encoded, MODEL).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert sentence_pieces.encode(empty(spark), MODEL).count() == 0


@pytest.mark.parametrize("size", [36, 100])
def test_chunked_paths(size):
    model, library = pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(size)
    for _ in range(150):
        s = pieces.escaped("".join(rng.choice("abcdeth .,\nér1=") for _ in range(rng.randint(150, 400))))
        cuts = [*range(0, len(s) - size // 2, size), len(s)]
        low = [max(0, c - model.longest) for c in cuts[:-1]]
        parts = [(s[a:c + model.longest], b - a, c - a) for a, b, c in zip(low, cuts, cuts[1:], strict=False)]
        last = len(parts) - 1
        found = [model.transfer(w, h, t, k == 0, k == last) for k, (w, h, t) in enumerate(parts)]
        path, ids = sentence_pieces.chosen_states(found), []
        for k, (w, h, t) in enumerate(parts):
            before, _, end = model.states(w, h)[path[k]] if k else (-1, 0, 0)
            stop = t if k == last else t + model.states(w, t)[path[k + 1]][2]
            ids += model.chunk_ids(w, h + end, before, stop).tolist()
        assert ids == library.encode(s[1:].replace(pieces.BLANK, " "))


def test_products_are_associative():
    import numpy as np
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(-5, 5, (4, 4)).astype(float) for _ in range(3))
    left, right = pieces.product(pieces.product(a, b), c), pieces.product(a, pieces.product(b, c))
    assert (left == right).all()
