import public_tokenizers
import pytest
import sentencepiece
from cases import EDGE, edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import pieces as p

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def plain(model):
    return p.Encoder(model, 1, 0.0)


@pytest.fixture(scope="module")
def dropping(model):
    return p.Encoder(model, 1, 0.5)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_without_dropout_as_the_library(library, plain, text):
    if p.MARK not in text:
        assert plain.encode(text, 0).tolist() == library.encode(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80), st.integers(0, 5))
def test_decoding_is_lossless(plain, dropping, text, key):
    for encoder in (plain, dropping):
        assert encoder.vocabulary.decode(encoder.encode(text, key)) == text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdefinorst ", min_size=1, max_size=30), st.integers(0, 2**32))
def test_list_and_heap_agendas_agree(plain, word, limit):
    v = plain.vocabulary
    key = p.coin_key(3, len(word))
    assert p._merge_short(word, v, key, limit) == p._merge_long(word, v, key, limit)


def test_segmentations_vary_and_repeat(dropping, model):
    text = "understanding international considerations " * 4
    found = {tuple(dropping.encode(text, k)) for k in range(8)}
    assert len(found) > 1
    again = p.Encoder(model, 1, 0.5)
    assert {tuple(again.encode(text, k)) for k in range(8)} == found
    other = p.Encoder(model, 2, 0.5)
    assert {tuple(other.encode(text, k)) for k in range(8)} != found


def test_dropout_lengthens(plain, dropping):
    text = "the quick brown fox jumps over the lazy dog " * 20
    assert len(dropping.encode(text, 1)) > 1.2 * len(plain.encode(text, 1))


def test_frame_round_trip(spark):
    coded = p.encode(edge_docs(spark), PATH)
    rows = coded.collect()
    assert len(rows) == len(EDGE) and all(r["lossless"] for r in rows)
    assert all(r["n_pieces"] == len(r["pieces"]) for r in rows)
    back = p.decode(coded.select("doc_id", "pieces"), PATH).collect()
    assert sorted(r["text"] for r in back) == sorted(x[1] or "" for x in EDGE)


def test_empty_table(spark):
    assert p.encode(no_docs(spark), PATH, ids=False).count() == 0


def test_every_occurrence_has_its_own_coins(model, plain):
    encoder = p.Encoder(model, 1, 0.1)
    word, n = " considerations", 4000
    whole = plain.encode(word[1:], 0).tolist()
    coded = encoder.encode_all(["x" + word] * n, list(range(n)))
    found = [tuple(x.tolist())[1:] for x in coded]
    assert len(set(found)) > 8
    # a word of so many characters takes at most one merge fewer
    assert 0.9 ** (len(word) - 1) - 0.04 < found.count(tuple(whole)) / n < 0.8
    one_text = encoder.encode("x" + word * n, 7).tolist()
    assert one_text[1 : 1 + n * len(whole)] != whole * n
    # a word of one merge is dropped at the rate in one document as over many
    short = " a"
    split = len(encoder.encode(short[1:] + short * (n - 1), 3)) - n
    assert abs(split / n - 0.1) < 0.03


def by_words(encoder, text, key):
    """One agenda after another, by the list and the heap."""
    words = p.WORD.findall(" " + text) if text else []
    keys = p.word_keys(p.coin_key(encoder.seed, key), len(words))
    runs = [
        p.encode_word(w, encoder.vocabulary, int(k) if encoder.limit else 0, encoder.limit)
        for w, k in zip(words, keys)
    ]
    return [i for run in runs for i in run]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(alphabet="abdeinorst Aé\n語😀▁", max_size=70), max_size=6),
    st.sampled_from([0.0, 0.1, 0.5, 1.0]),
)
def test_lockstep_is_one_agenda_after_another(model, texts, rate):
    if rate not in ENCODERS:
        ENCODERS[rate] = p.Encoder(model, 5, rate)
    encoder = ENCODERS[rate]
    keys = range(3, 3 + len(texts))
    got = [x.tolist() for x in encoder.encode_all(texts, list(keys))]
    assert got == [by_words(encoder, t, k) for t, k in zip(texts, keys)]


ENCODERS = {}


@pytest.mark.parametrize("rate", [0.0, 0.1])
def test_lockstep_over_a_table(spark, model, rate):
    from riskloom.llm.common import table

    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    encoder = p.Encoder(model, 17, rate)
    texts, keys = [r["text"] or "" for r in rows], [r["doc_id"] for r in rows]
    got = encoder.encode_all(texts, keys)
    assert [x.tolist() for x in got] == [by_words(encoder, t, k) for t, k in zip(texts, keys)]


def test_pair_table_has_every_split(model):
    v = p.Vocabulary(model)
    for piece in ("the", "▁the", "ing", "▁considered"):
        if piece not in v.ids:
            continue
        for at in range(1, len(piece)):
            a, b = (
                int(v.symbols[ord(h)]) if len(h) == 1 else v.ids.get(h) for h in (piece[:at], piece[at:])
            )
            if a is not None and b is not None:
                found = v.pairs.find(p.np.array([a]), p.np.array([b]))[0]
                assert v.pairs.made[found] == v.ids[piece]
    none = v.pairs.find(p.np.array([v.ids["the"]]), p.np.array([p.BASE + 0x2603]))
    assert none.tolist() == [-1]
