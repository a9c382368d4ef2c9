import gzip
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import warc

PAGES = "page_id long, url string, html string, payload_digest string"
BIG = "<p>" + "r\r\n\r\n" * 400 + "WARC/1.1\r\n"
ROWS = [
    (1, "http://a.example/x y", BIG, "clash"),
    (9, "http://b.example/", BIG, None),
    (4, None, BIG, None),
    (5, "http://c.example/", "small", None),
    (6, "http://d.example/\r\nEvil: 1", "small", None),
    (7, "u", None, None),
    (8, "u", "", None),
    (None, "http://e.example/", "ü" * 999, None),
    (10, "http://f.example/", "ends\r\n", None),
]


def run(spark, tmp_path, rows, **options):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, PAGES), path, **options)
    return path, warc.resolve_archives(warc.read_archives(spark, path)).collect()


def test_round_trip(spark, tmp_path):
    _, found = run(spark, tmp_path, ROWS)
    assert len(found) == len(ROWS)
    by = {r["page_id"]: r for r in found}
    for page, _, html, _ in ROWS:
        payload = (html or "").encode()
        assert by[page]["payload_bytes"] == len(payload)
        assert by[page]["payload_digest"] == hashlib.sha1(payload).hexdigest()
    kinds = {p: (r["record_type"], r["refers_to"]) for p, r in by.items()}
    assert kinds[1] == kinds[4] == ("revisit", 9)
    assert all(k == ("response", None) for p, k in kinds.items() if p not in (1, 4))


def test_archives_hold_a_repeated_payload_once(spark, tmp_path):
    path, _ = run(spark, tmp_path, ROWS)
    import glob

    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*.gz"))
    assert raw.count(BIG.encode()) == 1
    records = list(warc.parse_records(iter([raw])))
    assert len(records) == len(ROWS)
    ids = [h["WARC-Record-ID"] for h, _ in records]
    assert len(set(ids)) == len(ids)
    refers = {h["WARC-Refers-To"] for h, _ in records if h["WARC-Type"] == "revisit"}
    assert refers == {h["WARC-Record-ID"] for h, _ in records if h.get("WARC-Page-ID") == "9"}


def test_repeated_winner_and_empty_table(spark, tmp_path):
    _, found = run(spark, tmp_path, [ROWS[1], ROWS[1], ROWS[0]])
    assert sorted((r["page_id"], r["record_type"]) for r in found) == [
        (1, "revisit"),
        (9, "response"),
        (9, "response"),
    ]
    assert all(r["payload_bytes"] == len(BIG) for r in found)
    (tmp_path / "none").mkdir()
    assert run(spark, tmp_path / "none", [])[1] == []


@settings(max_examples=50, deadline=None)
@given(
    st.lists(st.binary(max_size=60).map(lambda b: b.replace(b"x", b"\r\n")), max_size=6),
    st.integers(1, 40),
)
def test_parser_takes_any_payload_in_any_chunks(payloads, size):
    raw = b"".join(
        b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(p), p) for p in payloads
    )
    chunks = [raw[i : i + size] for i in range(0, len(raw), size)]
    assert [b for _, b in warc.parse_records(iter(chunks))] == payloads


def test_damaged_archives_are_errors():
    for raw in (b"junk\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", b"WARC/1.1\r\nConte"):
        with pytest.raises(ValueError):
            list(warc.parse_records(iter([raw])))


@pytest.mark.parametrize("end", ["\r\n", "\r", "\n", "\r\n\r", "\r\n\r\n", "\r\n\r\n\r\n"])
def test_parts_whose_last_payload_ends_in_line_ends(spark, tmp_path, end):
    rows = [(i, f"http://a.example/{i}", f"page {i}{end}", None) for i in range(4)]
    path = str(tmp_path / "warc")
    # one page a part, all parts in one task
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(4, "page_id"), path)
    found = warc.read_archives(spark, path).coalesce(1).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in found) == [
        (i, len(html)) for i, _, html, _ in rows
    ]


def test_only_revisits_are_joined(spark, tmp_path):
    """Responses have no digest to join by: they would all meet in one task."""
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(ROWS, PAGES), path)
    plan = warc.resolve_archives(warc.read_archives(spark, path))._jdf.queryExecution()
    left = plan.optimizedPlan().toString().split("Join LeftOuter")[1].split("Aggregate")[0]
    assert "= revisit" in left and "MapInArrow" not in plan.optimizedPlan().toString()


def test_very_long_page(spark, tmp_path):
    html = "<p>long\r\n\r\n" * 300_000
    _, found = run(spark, tmp_path, [(1, "u", html, None), (2, "u", html, None), (3, "u", "x", None)])
    want = hashlib.sha1(html.encode()).hexdigest()
    assert sorted((r["page_id"], r["record_type"], r["payload_digest"] == want) for r in found) == [
        (1, "revisit", True),
        (2, "response", True),
        (3, "response", False),
    ]
