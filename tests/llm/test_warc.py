"""Archives: exact round trips, revisits against plain Python, foreign files."""

import gzip
import hashlib
import random

import pytest
from navloom.llm import warc

SCHEMA = "page_id long, url string, html string"


def by_hand(rows, least=1000):
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for html, ids in groups.items():
        data = html.encode()
        ids = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        for n, i in enumerate(ids):
            revisit = len(data) >= least and n > 0
            out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", ids[0] if revisit else None))
    return sorted(out, key=str)


def test_pages_through_archives(spark):
    rng = random.Random(4)
    bodies = ["<p>été</p>" * 200, "short", "", None, "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 60, "\r\n" * 700, "\r\n\r\n" + "x" * 995, "y" * 999, "z" * 1000, "q" * 3_000_000]
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "http://a/b", "x\r\ny", "hé"]), rng.choice(bodies)) for _ in range(150)]
    rows += rows[:10] + [(500 + k, "u", bodies[0]) for k in range(60)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", record_id int").repartition(4)
    found = warc.archived(df).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.original_page) for r in found), key=str) == by_hand(rows)
    assert all(r.intact for r in found) and len({r.record_id for r in found}) == len(rows)
    assert warc.archived(df.limit(0)).count() == 0


def test_files_are_records_one_after_the_other(spark, tmp_path):
    rows = [(k, f"http://h/{k}", f"<p>{k % 3}</p>" * 300) for k in range(12)]
    warc.write_pages(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/a")
    warc.deduplicate(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    files = [gzip.decompress(p.read_bytes()) for p in (tmp_path / "b").glob("part-*.gz")]
    heads = []
    for data in files:
        at = 0
        while at < len(data):
            head, _, rest = data[at:].partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            at += len(head) + 4 + size + 4
            heads.append((fields, rest[:size]))
    kinds = [f["WARC-Type"] for f, _ in heads]
    assert kinds.count("response") == 3 and kinds.count("revisit") == 9
    ids = {f["WARC-Record-ID"]: f for f, _ in heads}
    for f, block in heads:
        assert f["WARC-Target-URI"] == f"http://h/{f['Page-ID']}"
        if f["WARC-Type"] == "revisit":
            assert ids[f["WARC-Refers-To"]]["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] and block.endswith(b"\r\n\r\n") and b"<p>" not in block
    warc.deduplicate(spark, f"{tmp_path}/b", f"{tmp_path}/c")
    again = warc.resolved(spark, f"{tmp_path}/c").collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes) for r in again) == sorted((int(f["Page-ID"]), f["WARC-Type"], 2400) for f, _ in heads)
    assert all(r.intact for r in again)


@pytest.mark.parametrize("packed", [lambda parts: b"".join(parts), lambda parts: b"".join(map(gzip.compress, parts)), lambda parts: gzip.compress(b"".join(parts))])
def test_foreign_files_are_read(spark, tmp_path, packed):
    http = b"HTTP/1.0 200 OK\r\nServer: s\r\n\r\n"
    bodies = [b"", b"\x00\xff\r\n\r\nWARC/1.0\r\n", b"z" * 400_000]
    parts = [b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"]
    parts += [b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (k + 1, len(http + b), http + b) for k, b in enumerate(bodies)]
    (tmp_path / "f.warc").write_bytes(packed(parts))
    rows = sorted(warc.read_archives(spark, str(tmp_path), payloads=True).collect(), key=lambda r: r.record_id)
    assert [bytes(r.payload) for r in rows] == bodies and [r.payload_digest for r in rows] == [hashlib.sha1(b).hexdigest() for b in bodies]
    assert all(r.intact and r.page_id is None and r.http == http.decode()[:-2] for r in rows)


def test_what_is_no_record_is_an_error(spark, tmp_path):
    (tmp_path / "f.warc").write_bytes(b"GET / HTTP/1.0\r\n\r\n")
    with pytest.raises(Exception, match="not a record"):
        warc.read_archives(spark, str(tmp_path)).collect()
