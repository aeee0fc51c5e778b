import base64
import gzip
import hashlib
import random

import pytest

from quire.llm import warc

SCHEMA = "page_id long, url string, html string, date string, first string, run string"


@pytest.mark.parametrize("runs", [[], [[]], [[1]], [[3], [1], [2]], [[1, 1, 4], [1, 2], [], [0, 9]]])
def test_loser_tree(runs):
    assert list(warc.LoserTree(runs, lambda x: (x,))) == sorted(x for r in runs for x in r)


def test_loser_tree_random():
    random.seed(1)
    runs = [sorted(random.randrange(50) for _ in range(random.randrange(40))) for _ in range(13)]
    assert list(warc.LoserTree(runs, lambda x: (x,))) == sorted(x for r in runs for x in r)


def test_round_trip(spark):
    pages = [(5, "https://www.Example.org:80/A?b#c", "<p>same</p>"), (2, "http://b.example.org/", "<p>same</p>"),
             (9, "http://b.example.org/", "<p>same</p>"), (7, None, None), (8, "u\r\nWARC-Type: fake", ""),
             (4, "http://x.example/", "tricky\r\n\r\nWARC/1.0\r\n\r\n"), (6, "http://x.example/", "é" * 50_000),
             (None, "http://n.example/", "no id"), (3, "http://x.example/", "once"), (3, "http://x.example/", "once")]
    df = spark.createDataFrame([(*p, "clash", "clash", "clash") for p in pages], SCHEMA).repartition(3)
    rows = warc.capture_history(spark, df, captures_per_range=3).collect()
    assert len(rows) == len(pages)
    keys = [(r.urlkey, r.captured) for r in rows]
    assert keys == sorted(keys)
    by = {}
    for r in rows:
        by.setdefault(r.page_id, []).append(r)
    for page, _, html in pages:
        raw = (html or "").encode()
        for r in by[page]:
            assert r.payload_bytes == len(raw)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    kinds = {k: (v[0].record_type, v[0].refers_to) for k, v in by.items()}
    assert kinds == {2: ("response", None), 5: ("revisit", 2), 9: ("revisit", 2), 7: ("response", None), 8: ("revisit", 7),
                     4: ("response", None), 6: ("response", None), None: ("response", None), 3: ("response", None)}
    assert by[5][0].urlkey == "org,example)/a?b" and by[7][0].url == "" and "\n" not in by[8][0].url
    assert not warc.capture_history(spark, df.limit(0)).collect()
    small = {r.page_id: r.record_type for r in warc.capture_history(spark, df, least=20).collect()}
    assert small[5] == small[9] == "response"


def test_files_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a.example/", "x"), (2, "http://a.example/", "x")], "page_id long, url string, html string")
    warc.write(df.coalesce(1), str(tmp_path / "w"))
    found = [x for f in (tmp_path / "w").glob("*.gz") for x in warc.parse(gzip.decompress(f.read_bytes()))]
    assert sorted(x[1]["WARC-Type"] for x in found) == ["response", "revisit"]
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.0\r\nContent-Length: 5\r\n\r\nab\r\n\r\n"))
