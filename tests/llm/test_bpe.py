import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loadkit.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.Vocabulary(PATH)
ENCODER = bpe.Encoder(VOCABULARY)


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def check(texts):
    for text, raw in zip(texts, bpe.Encoder(VOCABULARY).encode(texts)):
        assert ids_of(raw) == LIBRARY.encode(text, add_special_tokens=False).ids, text[:80]


def test_plain_and_odd_texts():
    check([
        "", " ", "  ", "a", " a", "a ", "a  b", "a   b  ", "\n\na b\n", "it's we'll I'M don't", "été naïve 中文 テスト", "x<|endoftext|>y", "<|endoftext|>", " <|endoftext|> ",
        "a <|endoftext|><|endoftext|> b", "tab\tx \t y", "1234 56.7e8", "  lead", "trail  ", "a b 　c", "\x1c x\x1c y \x85z", "🙂🙂 👍🏽", "a" * 50, "ab" * 400, " " * 300, "é" * 100, "՘ ࢏",
        "!!! ??? ... ,,,", "'s 's", "a 's", "a '", "\r\n \r\n", "  x",
    ])


def test_every_character():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check(["".join(f"a{c}1{c}!{c} {c}" for c in points[i : i + 5000]) for i in range(0, len(points), 5000 * 12)])


def test_long_words():
    source = random.Random(5)
    check(["".join(source.choice("abcdeéthin") for _ in range(n)) for n in (47, 48, 49, 64, 500, 20_000)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab the'sn \n\t1.é <|>"), max_size=60), max_size=4))
def test_like_the_library(texts):
    for text, raw in zip(texts, ENCODER.encode(texts)):
        assert ids_of(raw) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_frames(spark):
    texts = [None, "", "The cat.", "The cat.", "x<|endoftext|>", "word " * 30_000]
    frame = spark.createDataFrame([(i if i else None, t, b"x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids binary, decoded string")
    rows = bpe.decode(bpe.encode(frame, VOCABULARY), VOCABULARY).collect()
    assert {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5}
    for r in rows:
        text = texts[r.doc_id or 0] or ""
        assert ids_of(r.ids) == LIBRARY.encode(text, add_special_tokens=False).ids
        assert r.decoded == text
    assert bpe.decode(bpe.encode(frame.limit(0), VOCABULARY), VOCABULARY).count() == 0


def test_decode_broken_ids(spark):
    raw = [np.array(x, "<u4").tobytes() for x in ([VOCABULARY.byte_ids[0xC3]], [50256, 60_000], [])] + [None]
    frame = spark.createDataFrame([(r,) for r in raw], "ids binary")
    assert [r.decoded for r in bpe.decode(frame, VOCABULARY).collect()] == ["�", "<|endoftext|>", "", ""]


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_query(spark):
    from loadkit.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
