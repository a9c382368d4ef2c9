"""The pipeline against its stages' brute-force definitions on a small fixture."""

import random
import zlib

import pytest
from pyspark.sql import functions as F
from test_decontaminate import expected as contaminated
from test_near_dups import expected as components

import corpus_pipeline
from riskloom.llm.common import table
from riskloom.llm.rule_ensemble import THRESHOLD, fit, with_score

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d, r = tmp_path_factory.mktemp("pipeline"), random.Random(9)
    texts, labels = [], []
    for i in range(160):
        text = sentence(r, r.randrange(60, 120))
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        texts.append(text)
        if i % 2:
            labels.append((i, int(i % 5 != 0), 0))
    clean = texts[1]
    words = clean.split()
    words[7] = "edited"
    texts += [clean, " ".join(words), None, "", "too short a text"]
    item = sentence(r, 14)
    texts.append(sentence(r, 60) + " " + item + " " + sentence(r, 5))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], (None, sentence(r, 70), "en", "s", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, item


def test_stages_take_effect(spark, folder):
    d, rows, item = folder
    docs = table(spark, d, "documents")
    scored = with_score(docs, fit(docs, table(spark, d, "labels"))).collect()
    good = [r for r in scored if r["score"] >= THRESHOLD]
    long = [(r["doc_id"], r["text"]) for r in good if len((r["text"] or "").split()) >= 50]
    shouting = [(i, t) for i, t in long if t.isupper()]
    long = [x for x in long if x not in shouting]
    with_id = sorted({x for x in long if x[0] is not None})
    least = components(with_id, 5)
    kept = [x for x in with_id if least[x[0]] == x[0]] + [x for x in long if x[0] is None]
    want = sorted((i or -1, t) for i, t in kept if not contaminated(t, [(1, item)])[1])
    out = corpus_pipeline.run(spark, d)
    got = out.collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == want
    assert len(want) > 100 and all(r["lossless"] for r in got)
    assert all(zlib.crc32(b"".join(p.to_bytes(4, "little") for p in r["pieces"])) == r["pieces_crc32"] for r in got)


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = table(spark, folder[0], "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).columns == docs.columns


CLASHING = [
    "_id", "_hash", "_th", "_words", "_w", "_lines", "_here", "_here_", "_doc", "_score",
    "label", "n_words", "n_lines", "kept", "fail_bits", "digest", "component_id", "text_hash",
]


def test_columns_with_names_of_the_operators_stay_as_they_are(spark, folder):
    docs = table(spark, folder[0], "documents")
    more = docs.withColumns({c: F.concat(F.lit(f"{c} of "), "doc_id") for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, folder[0]), stage(spark, more, folder[0])
        assert out.columns == more.columns, name
        rows = out.collect()
        key = lambda r: (r["doc_id"] or -1, r["text"] or "")
        assert sorted(map(key, rows)) == sorted(map(key, plain.collect())), name
        for r in rows:
            for c in CLASHING:
                assert r[c] == (None if r["doc_id"] is None else f"{c} of {r['doc_id']}"), name


def test_empty_documents(spark, folder, tmp_path):
    docs = table(spark, folder[0], "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0
