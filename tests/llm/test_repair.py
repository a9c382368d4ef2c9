import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import repair as r
from riskloom.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, part string, rows string, seg string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def brute_search(rows):
    """Every way to edit, with at most three inserts, by cost and audit."""
    best = None

    def go(at, said, cost, audit, inserts):
        nonlocal best
        if at == len(rows) and GRAMMAR.match(said) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserts:
            for c in "ua":
                go(at, said + c, cost + 5, audit + "I", inserts - 1)
        if at < len(rows):
            initial, fault = rows[at]
            go(at + 1, said, cost + 2, audit + "D", inserts)
            if fault not in ("blank", "duplicate"):
                stay = cost + (5 if fault == "truncated" else 0)
                go(at + 1, said + (initial or "?"), stay, audit + "K", inserts)
                for c in "ua":
                    go(at + 1, said + c, stay + 1, audit + "R", inserts)

    go(0, "", 0, "", 3)
    return best


@settings(max_examples=60, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.sampled_from(["", "", "truncated", "blank"])),
        max_size=5,
    )
)
def test_search_equals_enumeration(rows):
    assert r.search(rows) == brute_search(rows)


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "truncated", "duplicate"])), max_size=40),
    st.integers(1, 7),
)
def test_chained_segments_equal_one_search(rows, size):
    chain = r.Chain()
    for i in range(0, len(rows), size):
        ways = [r.search(rows[i : i + size], a, (b,)) for a in r.STATES for b in r.STATES]
        chain.add(
            {
                "faults": [0, 0, 0],
                **{c: 0 for c in ("illegal", "turns")},
                **{c: None for c in ("low", "high", "first", "last")},
                "costs": [w[0] if w else None for w in ways],
                "audits": [w[1] if w else None for w in ways],
            }
        )
    assert chain.best()[:2] == r.search(rows)


def test_long_runs_are_searched_fast():
    for rows in ([("u", "")] * 256, [("a", "truncated")] * 256, [("s", ""), ("u", "")] * 128):
        cost, audit = r.search(rows)
        assert len(audit.replace("I", "")) == 256 and cost <= 512


def brute_repair(rows):
    """All results of (conv, turn, role, text) rows, one conversation after another."""
    out = {}
    for conv in {x[0] for x in rows}:
        own = sorted(
            ((t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows if c == conv),
            key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()),
        )
        seen, plain, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else ""
            if not fault and words[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            plain.append((role[:1], fault))
            if fault:
                count[fault] += 1
        cost, audit = r.search(plain)
        lines, said, left = [], 0, iter(own)
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else next(left)
            if edit in "IR":
                system = bool(lines) and lines[0][:1] == "s"
                role = ("user", "assistant")[(len(lines) - system) % 2]
            if edit != "D":
                lines.append(f"{role}:{text}")
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[0] + b[0] for a, b in itertools.pairwise(plain)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *count.values(),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def repaired(spark, rows, **options):
    frame = spark.createDataFrame([(*x, "p", "q", "s") for x in rows], SCHEMA)
    made = r.repair(frame.repartition(3), **options).collect()
    assert len(made) == len({x["conv_id"] for x in made})
    return {x["conv_id"]: tuple(x)[1:] for x in made}


def sample():
    rows = []
    for conv in range(40):
        for turn in range(conv % 9 + 1):
            role = ["system", "user", "assistant", "tool", None, "", "User"][(conv * 5 + turn * 3) % 7]
            if turn and conv % 2:
                role = ("user", "assistant")[turn % 2]
            text = ["Fine.", "cut", "", None, "Odd? \n", "Ünï!", "same."][(conv + turn * turn) % 7]
            rows.append((conv, turn * (1 + conv % 3), role, text))
    rows += [(None, None, "user", "a row without id."), (None, 3, "assistant", "an answer!")]
    rows += [(7, 1, "user", "Fine.")] * 30 + [(8, None, "assistant", f"{i}.") for i in range(25)]
    return rows


@pytest.mark.parametrize("most", [256, 3, 1])
def test_whole_and_cut_conversations_equal_brute_force(spark, most):
    rows = sample()
    assert repaired(spark, rows, rows_most=most) == brute_repair(rows)


def test_segments_are_bounded_and_long_texts_whole(spark):
    rows = [(1, i % 50, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(3000)]
    rows += [(2, 0, "user", "word " * 200_000 + "."), (2, 1, "assistant", "x" * 500_000 + "!")]
    frame = spark.createDataFrame([(*x, "p", "q", "s") for x in rows], SCHEMA)
    cut = r.segmented(frame.select("conv_id", "turn", "role", "text"), 100, 10_000)
    assert max(len(x["rows"]) for x in cut.filter("conv_id = 1").collect()) <= 100
    assert cut.filter("conv_id = 2").count() == 2
    assert repaired(spark, rows, rows_most=100, bytes_most=10_000) == brute_repair(rows)


def test_empty_table_and_ids_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    ids = spark.createDataFrame([(1,), (1,), (None,)], "conv_id long")
    assert r.repair(none).count() == 0
    made = {x["conv_id"]: tuple(x)[1:] for x in r.repair(none, ids).collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert made == {1: empty, None: empty}


def test_damage(spark):
    rows = [(c, t, "assistant", "A. B! c?") for c in range(30) for t in range(5)]
    rows += [(None, None, None, None), (1, None, "user", "x.")]
    frame = spark.createDataFrame([(*x, "p", "q", "s") for x in rows], SCHEMA)
    want = []
    for c, t, role, text in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        want += [(c, t, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    order = lambda x: tuple((v is not None, v) for v in x)
    got = [tuple(x) for x in r.damage(frame).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


def test_whole_table(spark):
    frame = r.damage(table(spark, "/root/testdata/sf0.001", "conversations"))
    want = brute_repair([tuple(x) for x in frame.collect()])
    got = {x["conv_id"]: tuple(x)[1:] for x in r.repair(frame).collect()}
    assert got == want and any("I" in x[-2] or "R" in x[-2] for x in want.values())
