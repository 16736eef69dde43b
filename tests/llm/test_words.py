import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspan.llm import words
from quillspan.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["a b  c", None, "", "\n x\ty ", "zz", "é b ü", "<|endoftext|>a.B", "x<|startoftext|> y", "don't 'Tis rock''s $'s a'5 '", "İ, É.ẖ H̱e ẞ;ß é́x é, 12a3.4 a²b ½x", "日本語テキスト。abc", "ſ's K's ʼs ǅx. ×÷ a×b"]


def test_words_are_those_of_the_pattern():
    w = words.Words(*words.text_bytes(pa.array(TEXTS)))
    expected = [WORD.findall(t or "") for t in TEXTS]
    assert w.counts.tolist() == [len(x) for x in expected]
    assert [w.word(i).decode() for i in range(len(w.first))] == [x for y in expected for x in y]


def test_hashes_depend_on_the_word_alone(monkeypatch):
    a = words.Words(*words.text_bytes(pa.array(["ab cd ab", "cd AB"])))
    h = a.hashes(0)
    assert h[0] == h[2] and h[1] == h[3] and h[4] != h[0] and len(set(h.tolist())) == 3
    assert a.hashes(0, lower=True)[4] == a.hashes(0, lower=True)[0]
    monkeypatch.setattr(words, "_HASHED", 3)
    assert (a.hashes(0) == h).all()


def test_grams_stay_within_texts():
    w = words.Words(*words.text_bytes(pa.array(["a b c", "b c", "a b"])))
    g, ok = w.grams(w.hashes(0), 2)
    assert ok.tolist() == [True, True, False, True, False, True, False]
    assert g[0] == g[5] and g[1] == g[3] and g[0] != g[1]
    _, ok = w.grams(w.hashes(0), 3, short=True)
    assert ok.tolist() == [True, False, False, True, False, True, False]


@pytest.fixture(scope="module")
def encoder():
    return words.Encoder(tokenizer_path(), keep=50)


def check(encoder, texts):
    ids, n = encoder(*words.text_bytes(pa.array(texts, pa.string())))
    ends = np.cumsum(n)
    for k, t in enumerate(texts):
        assert ids[ends[k] - n[k] : ends[k]].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_encoder_agrees_with_the_library(encoder):
    check(encoder, TEXTS)
    check(encoder, ["ab", "cd", ".", ".x", "'", "s"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAsStTrR mMdDlLvV'’.,!$<|>#09 \t\nÉéßİıøĀʼ̱́×日½²")), max_size=20), min_size=1, max_size=4))
def test_encoder_agrees_on_any_text(encoder, texts):
    check(encoder, texts)


def test_pieces_hold_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 9, 1, 1)])], ["text"])
    parts = list(words.pieces(batch, "text", 6))
    assert [p[0].num_rows for p in parts] == [2, 1, 2]
    assert b"".join(p[1].tobytes() for p in parts) == b"x" * 16
