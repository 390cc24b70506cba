import gzip
import io
import random

import pytest
from pyarrow import fs

from avionyx.llm import warc
from avionyx.session import scratch_path


def brute(rows, least):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        revisit = len(data) >= least and same and sum((h or "").encode() == data for _, _, h in rows) > 1 and page != max(same)
        out.append((page, len(data), warc.digest(data), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (9, "http://c/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "http://d/", ""),
    (5, "http://é/", "é\r\n\r\nWARC/1.1\r\n\r\n" * 3), (6, "u", "long " * 200_000), (7, "u", "\n"), (7, "u", "\n"), (8, "u", "q"), (8, "u", "q"),
    (None, "u", "<p>x</p>"), (None, "u", "alone"), (10, "u", "\x00\x0b\x85"),
]


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip_matches_brute_force(spark, least):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string")
    got = sorted(map(tuple, warc.round_trip(pages, least).collect()), key=str)
    assert got == brute(ROWS, least)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_members_and_index(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    warc.write_monolithic(warc.mark_revisits(pages).coalesce(1), f"{folder}/m")
    index = warc.normalise(spark, f"{folder}/m", f"{folder}/r")
    rows = sorted(index.collect(), key=lambda r: r["offset"])
    (name,) = {r["archive"] for r in rows}
    data = fs.LocalFileSystem().open_input_file(warc.filesystem(name)[1]).read()
    assert rows[0]["offset"] == 0 and rows[-1]["offset"] + rows[-1]["length"] == len(data)
    whole = b""
    for r, after in zip(rows, [*rows[1:], None], strict=True):
        assert after is None or r["offset"] + r["length"] == after["offset"]
        whole += gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])
    assert whole == gzip.decompress(data)
    back = {(r["page_id"], r["payload"]) for r in warc.read_records(index, payloads=True).collect() if r["record_type"] == "response"}
    assert back == {(p, h or "") for p, _, h in ROWS} - {(1, "<p>x</p>"), (2, "<p>x</p>"), (None, "<p>x</p>"), (3, "")}


def test_inflating_in_pieces_and_many_members():
    rng = random.Random(0)
    parts = [rng.randbytes(rng.randrange(5000)) + b"a" * rng.randrange(90_000) for _ in range(20)]
    stream = io.BytesIO(b"".join(gzip.compress(p) for p in parts))
    assert b"".join(warc.inflated(stream, 700)) == b"".join(parts)


def test_broken_archives_are_refused():
    good = warc.render(1, "u", "abc", "00" * 20, None).encode() + b"\r\n\r\n"
    assert len(list(warc.records(iter([good[:9], good[9:], good])))) == 2
    for bad in (good[:-5], good.replace(b"abc", b"abcd"), b"nonsense\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(iter([bad])))
