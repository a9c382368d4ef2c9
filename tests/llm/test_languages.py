import math
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from cases import EDGE, edge_docs, no_docs
from pyspark.sql import functions as F

from riskloom.llm import languages as g
from riskloom.llm.common import table

SF = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return g.Pieces(FILE)


@pytest.fixture(scope="module")
def model(spark):
    return g.fit(table(spark, SF, "documents"), FILE)


def vocabulary():
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=FILE)
    plain = {m.id_to_piece(i): i for i in range(3, m.get_piece_size()) if not m.is_byte(i)}
    return plain, {b: m.piece_to_id(f"<0x{b:02X}>") for b in range(256)}


def segmentations(word, plain, spelled):
    """Every way of cutting a word, as lists of piece ids."""
    if not word:
        return [[]]
    out = []
    for end in range(1, len(word) + 1):
        if word[:end] in plain:
            out += [[plain[word[:end]], *rest] for rest in segmentations(word[end:], plain, spelled)]
    if word[0] not in plain:
        head = [spelled[b] for b in word[0].encode()]
        out += [head + rest for rest in segmentations(word[1:], plain, spelled)]
    return out


WORDS = ["the", "überall", "a", "mañana", "été", "щука", "日本語", "ꙮx", "ét", "𝒳y"]


def test_forward_sums_every_segmentation(pieces):
    plain, spelled = vocabulary()
    draw = np.random.default_rng(1)
    logs = np.log(draw.dirichlet(np.ones(pieces.size), 3).T + 1e-12)
    got = g.word_logs(WORDS, pieces, logs)
    for word, row in zip(WORDS, got):
        ways = segmentations(g.MARK + word, plain, spelled)
        want = [math.log(sum(math.exp(logs[w, k].sum()) for w in ways)) for k in range(3)]
        assert len(ways) >= 1 and np.allclose(row, want)


def test_expected_counts_of_every_segmentation(pieces):
    plain, spelled = vocabulary()
    draw = np.random.default_rng(2)
    logs = np.log(draw.dirichlet(np.ones(pieces.size)) + 1e-12)[:, None]
    times = np.arange(1, len(WORDS) + 1)
    want = np.zeros(pieces.size)
    for word, n in zip(WORDS, times):
        ways = segmentations(g.MARK + word, plain, spelled)
        p = np.array([math.exp(logs[w, 0].sum()) for w in ways])
        for way, share in zip(ways, p / p.sum()):
            np.add.at(want, way, share * n)
    assert np.allclose(g.expected(WORDS, times, pieces, logs), want)


def test_long_words_do_not_underflow(pieces):
    logs = np.full((pieces.size, 2), -math.log(pieces.size))
    got = g.word_logs(["ab" * 20_000, "x"], pieces, logs)
    assert np.isfinite(got).all() and got[0, 0] < -10_000


def test_probabilities_sum_to_one(model):
    assert model.languages == ["de", "en", "es", "fr"]
    assert np.allclose(np.exp(model.logs).sum(axis=0), 1.0)


def test_held_out_accuracy(spark, model):
    docs = table(spark, SF, "documents").filter(g.held_out(F.col("doc_id")))
    rows = g.identify(docs, model).collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert len(rows) > 200 and right / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_learns_from_text_and_language_alone(spark):
    docs = table(spark, SF, "documents").filter(g.held_out(F.col("doc_id")))
    assert g.fit(docs, FILE).languages == []


def test_edge_cases(spark, model):
    made = g.identify(edge_docs(spark), model)
    assert made.columns == [*edge_docs(spark).columns, "lang_pred", "score"]
    rows = made.collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        letters = any(unicodedata.category(c)[0] == "L" for c in r["text"] or "")
        assert (r["lang_pred"] == g.UND) == (not letters)
        assert r["score"] > 0 if letters else r["score"] == 0
    assert g.identify(no_docs(spark), model).count() == 0


def test_without_labels_and_with_clashing_names(spark):
    docs = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.withColumn("_letter_words", F.lit("mine")).withColumn("cells", F.lit(1))
    none = g.fit(docs, FILE)
    assert none.languages == []
    rows = g.identify(docs, none).collect()
    assert {(r["lang_pred"], r["score"], r["_letter_words"]) for r in rows} == {("und", 0.0, "mine")}
    assert g.fit(no_docs(spark).withColumn("lang", F.lit("x")), FILE).languages == []
    one = g.fit(docs.withColumn("lang", F.lit("xx")), FILE)
    assert {r["lang_pred"] for r in g.identify(docs, one).collect()} == {"xx", "und"}
