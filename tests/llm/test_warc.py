import gzip
import hashlib
import io
import tempfile
from pathlib import Path

import pytest

from learnstream.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, shard string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def want(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw and j is not None]
        last = max(same, default=None)
        revisit = len(raw) >= 1000 and last is not None and i != last
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                    last if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows, out=None, parts=3):
    out = out or tempfile.mkdtemp(prefix="warc-", dir="/tmp")
    warc.write(pages_of(spark, rows).repartition(parts), out)
    return out, warc.read(spark, out)


ROWS = [(k, f"http://x/{k}", "<p>" + "abc é\r\n\r\n" * (50 + k % 5 * 40)) for k in range(40)]
ROWS += [(100, None, None), (101, "http://a b\nc", ""), (102, "u", None), (None, "n", "z" * 2000), (103, "m", "z" * 2000),
         (104, "m", "z" * 2000), (104, "m", "z" * 2000), (105, "s", "short"), (106, "s", "short")]


def test_round_trip(spark):
    _, back = round_trip(spark, ROWS)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()]
    assert sorted(got, key=str) == want(ROWS)


def test_shards_do_not_depend_on_the_dealing(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(warc, "ROLL_BYTES", 300)
    files = []
    for parts in (1, 7):
        out, back = round_trip(spark, ROWS, parts=parts)
        assert back.count() == len(ROWS)
        files.append({p.name: p.read_bytes() for p in Path(out).glob("*.warc.gz")})
        assert not list(Path(out).glob("_temporary*")) and (Path(out) / "_SUCCESS").exists()
        shards = {r.shard: 0 for r in spark.read.parquet(f"{out}/_manifest").collect()}
        assert len(shards) > 1 and len(files[-1]) > len(shards)
    assert files[0] == files[1]


def test_ranges_of_several_shards_give_the_same_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 5_000)
    files = []
    for ranges in (1, 3, 1 << 16):
        monkeypatch.setattr(warc, "RANGES", ranges)
        out, back = round_trip(spark, ROWS, parts=4)
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()]
        assert sorted(got, key=str) == want(ROWS)
        files.append({p.name: p.read_bytes() for p in Path(out).glob("*.warc.gz")})
    assert files[0] == files[1] == files[2] and len(files[0]) > 5


def test_ids_beyond_doubles_come_back(spark):
    big = (1 << 62) + 1
    rows = [(None, "n", "z" * 2000), (big, "m", "z" * 2000), (big - 1, "m", "z" * 2000), (-big, "m", None), (big, "o", "x")]
    _, back = round_trip(spark, rows)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()]
    assert sorted(got, key=str) == want(rows)


def test_a_record_longer_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 1_000)
    rows = [(k, "u", "%d " % k * (9000 if k == 3 else 100)) for k in range(12)]
    _, back = round_trip(spark, rows)
    assert sorted(r.page_id for r in back.collect()) == list(range(12))


def test_files_are_plain_gzip_of_warc_records(spark):
    out, _ = round_trip(spark, ROWS[:3])
    text = b"".join(gzip.open(p).read() for p in sorted(Path(out).glob("*.warc.gz")))
    assert text.count(b"WARC/1.1\r\n") == 3 and b"WARC-Block-Digest: sha1:" in text


def test_damage_is_noticed(spark):
    out, _ = round_trip(spark, ROWS[:5])
    path = next(Path(out).glob("*.warc.gz"))
    raw = gzip.open(path).read().replace(b"abc", b"abd", 1)
    path.write_bytes(gzip.compress(raw))
    with pytest.raises(Exception, match="damaged"):
        warc.read(spark, out).collect()


def test_members_end_inside_a_record():
    whole = gzip.compress(b"x" * 5000)
    assert [len(m) for m in warc.members(io.BytesIO(whole + whole))] == [5000, 5000]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(whole + whole[:-30])))


def test_empty_table(spark):
    _, back = round_trip(spark, [])
    assert back.count() == 0
