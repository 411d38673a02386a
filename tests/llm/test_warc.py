import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

from touchline.llm.warc import read_archives, records, resolve, write_archives


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, payload string, salt int")


def test_revisits_by_brute_force(spark, scratch):
    long, other = "<p>" + "ä" * 600, "b" * 999
    rows = [(i, f"http://h/{i}", long) for i in range(1, 60)] + [(i, None, other) for i in range(60, 65)]
    rows += [(70, "http://h/x", None), (71, "u", ""), (72, "u\r\nv", "c" * 1000), (73, "u", "c" * 1000), (74, "u", "d" * 200_000)]
    manifest = write_archives(pages(spark, rows), f"{scratch}/w")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in resolve(read_archives(manifest, f"{scratch}/w")).collect()}
    by = defaultdict(list)
    for i, _, h in rows:
        by[(h or "").encode()].append(i)
    want = {}
    for p, ids in by.items():
        for i in ids:
            again = len(p) >= 1000 and i != max(ids)
            want[i] = (len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", max(ids) if again else None)
    assert got == want
    assert sum(r.n_records for r in manifest.collect()) == len(rows)


def test_archives_are_plain_gzip_members(spark, scratch):
    rows = [(1, "http://a/", "x" * 2000), (2, "http://b/", "x" * 2000)]
    manifest = write_archives(pages(spark, rows), f"{scratch}/w")
    seen = []
    for r in manifest.collect():
        assert gzip.decompress(Path(r.path).read_bytes()).startswith(b"WARC/1.1\r\n")
        with open(r.path, "rb") as f:
            seen += [(h["warc-type"], len(b.partition(b"\r\n\r\n")[2])) for h, b in records(f, chunk=17)]
    assert sorted(seen) == [("response", 2000), ("revisit", 0)]


def test_null_and_repeated_page_ids(spark, scratch):
    p = "y" * 1500
    rows = [(None, "a", p), (5, "b", p), (5, "c", p), (5, "b", p), (None, "z", "short")]
    got = resolve(read_archives(write_archives(pages(spark, rows), f"{scratch}/w"), f"{scratch}/w")).collect()
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in got)
    assert kinds == [("5", "response", "None"), ("5", "revisit", "5"), ("5", "revisit", "5"), ("None", "response", "None"), ("None", "revisit", "5")]
    assert all(r.payload_bytes == 1500 for r in got if r.payload_digest == hashlib.sha1(p.encode()).hexdigest())


def test_repeated_rows_have_records_of_their_own(spark, scratch):
    p = "y" * 1500
    rows = [(5, "b", p)] * 3 + [(5, "c", p), (4, "b", p), (4, "b", p), (None, "a", p), (None, "a", p)] + [(6, "s", "short")] * 2
    heads = read_archives(write_archives(pages(spark, rows), f"{scratch}/w"), f"{scratch}/w").collect()
    assert len({h.record_id for h in heads}) == len(rows)
    (original,) = [h.record_id for h in heads if h.record_type == "response" and h.page_id == 5]
    revisits = [h for h in heads if h.record_type == "revisit"]
    assert len(revisits) == 7
    assert all(h.refers_to_record == original != h.record_id for h in revisits)


def test_empty_table(spark, scratch):
    manifest = write_archives(pages(spark, []), f"{scratch}/w")
    assert resolve(read_archives(manifest, f"{scratch}/w")).collect() == []
