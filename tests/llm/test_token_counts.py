import public_tokenizers
import pytest
from cases import EDGE, edge_docs, no_docs
from tokenizers import Tokenizer

from riskloom.llm import token_counts as t

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter(library):
    return t.Counter(library.to_str(), t.whole_tokens(library))


def of(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark, library):
    found = t.count_tokens(edge_docs(spark), PATH).collect()
    assert len(found) == len(EDGE)
    for r in found:
        assert r["n_tokens"] == of(library, r["text"]), r["text"]


def test_every_plain_character(library, counter):
    """The fast way splits and lower-cases each character as the library does."""
    for code in [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250)]:
        c = chr(code)
        for text in (c, f"ab{c}1{c}{c}Z '{c}", f"{c}'ll {c}re"):
            assert counter.count(text) == of(library, text), (code, text)


@pytest.mark.parametrize(
    "text",
    [
        "a<|startoftext|>b <|endoftext|>",
        "<|ENDOFTEXT|> x",
        "\x1c a\x85b\u3000c 日本語 ½ ²",
        "İstanbul é e\u0301 ﬁ ſ ß ẞ Σς",
        "I'LL we'Ve it's 's '",
        "\x00\x01\u200b a",
        "x" * 3000,
    ],
)
def test_odd_texts(library, counter, text):
    assert counter.count(text) == of(library, text)


def test_proof_of_whole_tokens(library):
    whole = t.whole_tokens(library)
    assert len(whole) > 30_000
    for piece in sorted(whole)[::97]:
        assert of(library, piece) == 1


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(t, "MEMORY", 3)
    small = t.Counter(library.to_str(), frozenset(["the"]))
    text = "the qzxv wvut srqp onml kjih"
    assert small.count(text) == of(library, text) and len(small.counts) <= 4


def test_empty_table_and_clashing_column(spark):
    assert t.count_tokens(no_docs(spark), PATH).count() == 0
    assert t.count_tokens(edge_docs(spark), PATH, out="n_words").dtypes[-1] == ("n_words", "bigint")
