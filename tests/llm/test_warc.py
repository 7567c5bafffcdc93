"""WARC: loser tree, archive format, record payloads."""

from __future__ import annotations

import gzip
import hashlib
import os

from hypothesis import given, settings
from hypothesis import strategies as st

from casekit.llm import warc
from casekit.plans.pipeline import scratch_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree_merges(lists):
    runs = [[(v, (r, i)) for i, v in enumerate(sorted(x))] for r, x in enumerate(lists)]
    assert list(warc.loser_tree_merge(runs)) == sorted(x for run in runs for x in run)


def test_archives_are_valid_and_sorted(spark, awkward):
    path = scratch_path(spark, "archive")
    pages = spark.read.parquet(f"{awkward}/pages.parquet")
    warc.write_archives(pages.repartition(3, "page_id"), path)
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    seen = {}
    for name in sorted(os.listdir(path.removeprefix("file:"))):
        if not name.endswith(".gz"):
            continue
        data = gzip.open(f"{path.removeprefix('file:')}/{name}").read()
        keys = []
        while data:  # an independent reader of the format
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            size = int(fields["Content-Length"])
            block, end = rest[:size], rest[size:size + 4]
            assert end == b"\r\n\r\n"
            http, _, body = block.partition(b"\r\n\r\n")
            page = int(fields["WARC-Record-ID"][len("<urn:page:"):-1])
            assert f"Content-Length: {len(html[page])}".encode() in http
            assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(html[page]).hexdigest()
            assert body == (html[page] if fields["WARC-Type"] == "response" else b"")
            keys.append((fields["X-Url-Key"], fields["WARC-Date"]))
            seen[page] = fields["WARC-Type"]
            data = rest[size + 4:]
        assert keys == sorted(keys)
    assert seen.keys() == html.keys()
    assert sum(t == "revisit" for t in seen.values()) == 5


def test_small_ranges_give_the_same_order(spark, awkward):
    from casekit.llm.common import stored, table

    path = scratch_path(spark, "archive")
    warc.write_archives(table(spark, awkward, "pages").repartition(4, "page_id"), path)
    captures = stored(warc.read_archives(spark, path), "captures")
    one, many = (sorted(map(str, warc.merge_runs(captures, n).select("position", "page_id").collect()))
                 for n in (10_000, 2))
    assert one == many and len(one) == 17
