import random
import re

from cases import EDGE, edge_docs, no_docs

from riskloom.llm import decontaminate as d

BENCH = "item_id long, text string, n_words string"


def plain(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def expected(text, items, window=10):
    w, hit, found = plain(text), set(), set()
    for item, t in items:
        v = plain(t)
        size = min(window, len(v))
        for i in range(len(v) - size + 1) if v else ():
            for j in range(len(w) - size + 1):
                if w[j : j + size] == v[i : i + size]:
                    hit |= set(range(j, j + size))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def check(spark, docs, items, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string, items string")
    bench = spark.createDataFrame([(i, t, None) for i, t in items], BENCH)
    rows = d.contamination(df, bench, **options).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=key)
    assert got == sorted(((i, *expected(t, items)) for i, t, _ in docs), key=key)


def test_windows_equal_brute_force(spark):
    r = random.Random(3)
    few = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(r.choice(few) for _ in range(r.choice([1, 2, 5, 9, 10, 11, 14])))) for i in range(12)]
    items += [(20, "Alpha beta, GAMMA! delta"), (20, "second text of item twenty"), (None, "alpha beta")]
    items = [(i, t) for i, t in items if i is not None]
    docs = []
    for k in range(60):
        w = [r.choice([*few, "zz"]) for _ in range(r.randrange(40))]
        if k % 4 == 0:
            w += plain(r.choice(items)[1])
        docs.append((k, " ".join(w), None))
    docs.append((99, "xx ALPHA-beta gamma... delta yy", None))
    check(spark, docs, items)


def test_long_items_only(spark):
    r = random.Random(5)
    text = " ".join(f"w{r.randrange(30)}" for _ in range(60))
    docs = [(1, text, None), (2, "x " + text[:90] + " y", None), (3, text.upper() * 2, None)]
    docs += [(1, text, None), (None, text, None)]
    check(spark, docs, [(7, text), (8, text[40:])])


def test_edge_cases(spark):
    bench = spark.createDataFrame(
        [(1, None, None), (2, "", None), (3, " ... ", None), (10, "Quick brown", None), (9, "same SAME same", None)],
        BENCH,
    )
    rows = d.contamination(edge_docs(spark), bench).collect()
    items = [(10, "Quick brown"), (9, "same SAME same")]
    assert len(rows) == len(EDGE)
    want = sorted(expected(t, items) for _, t, *_ in EDGE)
    assert sorted((r["n_words"], r["n_hit"], r["items"]) for r in rows) == want
    kept = d.decontaminate(edge_docs(spark), bench)
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3, 4, 5, 7, 8]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], BENCH)
    assert d.contamination(no_docs(spark), bench).count() == 0
    assert d.contamination(edge_docs(spark), bench).filter("n_hit > 0").count() == 0


def test_shuffled_benchmark_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_SHINGLES", 0)
    check(spark, [(1, "a b c d e f", None), (2, "b c", None)], [(1, "b c d"), (2, "c")])


def test_no_python_in_the_plan(spark):
    bench = spark.createDataFrame([(1, "a b c", None)], BENCH)
    plan = d.contamination(edge_docs(spark), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
