"""Archives: exact round trip, equal bytes, revisits, rolled files, refused damage."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from patronlake.llm import warc

ROWS = [(i, f"http://h/{i}", f"<p>{i % 7 and i}</p>" * (i % 50)) for i in range(1, 400)] + [
    (1000, None, None), (1001, "http://x\r\ny: z", ""), (None, "http://n", "<p>same</p>"), (None, "http://n", "<p>same</p>"),
    (5000, "u", "twice"), (5000, "u", "twice"), (5000, "v", "twice"), (4000, "u", "twice"), (-3, "é", "Ünï\r\n\r\ncode"),
]


def make(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(parts)


def expected(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for html, pages in groups.items():
        data = html.encode()
        known = [p for p in pages if p is not None]
        best = max(known) if known else None
        done = False
        for p in pages:
            first = p == best and not done
            done = done or first
            sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
            out.append((p, len(data), sha, "response" if first else "revisit", None if first else best))
    return sorted(map(str, out))


def read(spark, folder):
    return warc.read_archives(spark, folder)


@pytest.mark.parametrize("shard_bytes, roll", [(1 << 24, 1 << 28), (2000, 700)])
def test_round_trip(spark, tmp_path, shard_bytes, roll):
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(make(spark, ROWS), folder, shard_bytes=shard_bytes, roll_bytes=roll).collect()
    rows = read(spark, folder).collect()
    got = sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows)
    assert got == expected(ROWS)
    html = {(p, u): (h or "").encode() for p, u, h in ROWS}
    for r in rows:
        if r.record_type == "response" and r.page_id not in (1000, 1001):
            assert bytes(r.payload) == html[r.page_id, r.url]
    assert len(manifest) == 1 if roll > 1000 else len(manifest) > 10
    names = {p.name for p in Path(f"{tmp_path}/a").glob("*.warc.gz")}
    assert names == {m.name for m in manifest} and not list(Path(f"{tmp_path}/a").glob("tmp-*"))
    for m in manifest:
        data = (tmp_path / "a" / m.name).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (m.n_bytes, m.sha256)
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == m.n_records


def test_equal_records_give_equal_bytes(spark, tmp_path):
    found = []
    for i, parts in enumerate((1, 7)):
        folder = f"{tmp_path}/{i}"
        warc.write_archives(make(spark, ROWS[::-1] if i else ROWS, parts), folder, shard_bytes=3000, roll_bytes=900)
        found.append({p.name: p.read_bytes() for p in Path(folder).glob("*.warc.gz")})
    assert found[0] == found[1] and len(found[0]) > 3


def test_small_payloads_may_stay_responses(spark, tmp_path):
    warc.write_archives(make(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "y" * 9), (4, "d", "y" * 9)]), f"{tmp_path}/a", min_payload=5)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in read(spark, f"{tmp_path}/a").collect()}
    assert kinds == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_naming_again_changes_nothing_and_damage_is_refused(spark, tmp_path):
    folder = f"{tmp_path}/a"
    warc.write_archives(make(spark, ROWS[:20]), folder)
    attempts = spark.read.schema(warc._FILE).parquet(f"{folder}/manifest-attempts")
    assert attempts.mapInArrow(warc._name_files(folder), warc._MANIFEST).count() == 1
    file = next(Path(folder).glob("*.warc.gz"))
    record = next(iter(warc._stream(*warc.files.opened(str(file)))))
    with pytest.raises(ValueError, match="does not hold"):
        warc.parse_record(record.replace(b"<p>", b"<q>", 1))
    file.unlink()
    with pytest.raises(Exception, match="neither"):
        attempts.mapInArrow(warc._name_files(folder), warc._MANIFEST).collect()


def test_no_pages_give_no_files(spark, tmp_path):
    assert warc.write_archives(make(spark, ROWS).limit(0), f"{tmp_path}/a").count() == 0
    assert read(spark, f"{tmp_path}/a").count() == 0


def test_each_shard_is_written_by_a_task_of_its_own(spark, tmp_path):
    folder = f"file://{tmp_path}/s"
    rows = [(i, f"http://x/{i}", f"page {i} " + "x" * 400) for i in range(300)]
    warc.write_archives(make(spark, rows), folder, shard_bytes=4000, roll_bytes=300).collect()
    files = spark.read.schema(warc._FILE).parquet(f"{folder}/manifest-attempts").collect()
    assert len({f.shard for f in files}) > 20 and max(f.part for f in files) > 0
    assert all(f.temporary.split("-")[1] == str(f.shard) for f in files)
