"""Token ids from columns of texts: those of the plain call, with each distinct piece given to the model once."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tracklens.llm import packing, tokenfiles

ODD = [
    "", "a b", " a", "a ", "a  b", " ", "  ", "\n", "a\n b", None, "it's 's I'LL don''t 'tis x's, ''s '' '", "_x_ 12 345,6 1a2b ab12_c",
    "<|endoftext|>b", "a<|endoftext|>b c", "x <| y <|endoftext", "ﬁ naïve ŉa İ ıx ĲŸŽž ß ẞ straße×2÷3 é ª º ² ǆ Ǆ ȡ ɏ", "tab\tx\x0by\x0cz\rq",
    "x a\nb", "x a\n\nb", "x a\n", "x a\n y", "x a\n\n y", "x a.\n's b\nc\n\td \ne", "q \nr s\n", " \n\n", "x é\nü",
    "a\x1cb\x1fc\x85d\xa0e f　g \x1c a x \xa0 y", "ΑΣ ας 日本 한국", "\x00a \x7f ​ b\x01", "😀 👍🏽 'll", "a…b – “c” (word) e-mail@x.org",
]


def encoder_of(name):
    if name == "packing":
        return packing, packing.Encoder(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path()), 1
    made = tokenfiles.ChunkEncoder(tokenfiles.tokenizer_path(), 0)
    return tokenfiles, made, Tokenizer.from_file(tokenfiles.tokenizer_path()), 0


@pytest.mark.parametrize("name", ["packing", "tokenfiles"])
def test_columns_encode_like_the_plain_call(name):
    _, encoder, plain, end = encoder_of(name)
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, end] for t in ODD]
    texts = pa.array(["before", *ODD], pa.string())
    for got, ids in ((encoder.encode(texts.slice(1)), want), (encoder.encode(texts.slice(3, 5)), want[2:7])):
        assert [np.frombuffer(g.as_py(), "<u2").tolist() for g in got] == ids
    assert len(encoder.encode(texts.slice(0, 0))) == 0


@pytest.mark.parametrize("name", ["packing", "tokenfiles"])
def test_each_piece_goes_to_the_model_once(name, monkeypatch):
    module, encoder, _, _ = encoder_of(name)
    given, spelled = [], module.spelled
    monkeypatch.setattr(module, "spelled", lambda model, words, *rest: given.append(words) or spelled(model, words, *rest))
    encoder.encode(pa.array([f"x word, word. (word) word;word {mark} don't 'word'" for mark in ["", "!", "word!"] * 5]))
    words = [w for part in given for w in part]
    assert len(words) == len(set(words)) and len(words) < 25
    assert sum(w.strip("Ġ") == "word" for w in words) == len({w for w in words if w.strip("Ġ") == "word"}) <= 2
