"""Operator 8: a deterministic, sharded WARC writer and its reader.

Records are put in one total order (id, digest, url). The running sum of
their bytes along it cuts the shards, so shards depend on the rows alone, not
on how Spark dealt them. Consecutive shards are a range; at most ``RANGES``
first keys tell a record's range where it is read, so payloads are dealt once,
to the plan's rows of the same range. A task merges the two in their order,
writes its shards, one gzip member a
record, and rolls files by compressed size, under temporary names. The rows
it returns are the manifest: only those of task attempts that Spark committed
are in it. A second job renames exactly these files (again, if an executor is
lost: a file already in place is done), then the manifest and ``_SUCCESS``
are written. Readers take the files from the manifest.

Of records with equal payloads of at least ``MIN_PAYLOAD`` bytes, that of the
largest id is a response, the others are revisits of it without the payload.

Nulls: a null html is an empty payload, a null url ``about:blank``; a null id
is smaller than any and never referred to (if all of a group are null, all
are responses). Rows that repeat an id and a payload are records of their
own; if they hold the group's largest id, each is a response. Extra columns
are ignored. An empty table writes a manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnstream.llm.common import BATCH_ROWS, bound_batches, materialize, per_batch, running_total

MIN_PAYLOAD = 1000
SHARD_BYTES = 32 << 20       # payload bytes of a shard, about
ROLL_BYTES = 16 << 20        # compressed bytes of a file, about
RANGES = 1 << 16             # ranges of shards, at most: one first key of each is sent to the tasks
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_CHUNK = 1 << 20
HEADER_BYTES = 600           # what a record weighs beside its payload, about

MANIFEST = "shard long, file string, temporary string, records long, bytes long, sha1 string"
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string")


def arrow_schema(columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    own = name.strip("<>").rpartition(":")[2]
    return None if own == "none" else int(own)


def record(page_id, url, payload: bytes, n: int, digest: str, refers_to=None) -> bytes:
    """One gzip member. ``digest`` is the payload's SHA-1 in hex. A response
    does not depend on other records."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    sha = lambda raw: "sha1:" + base64.b32encode(raw).decode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", DATE),
              ("WARC-Target-URI", quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~-._")),
              ("WARC-Payload-Digest", sha(bytes.fromhex(digest))),
              ("WARC-Block-Digest", sha(hashlib.sha1(block).digest()))]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_name(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return gz.compress(head.encode() + block + b"\r\n\r\n") + gz.flush()


def _order(page_id: int | None, digest: str) -> tuple:
    """The sort key of a record; no id comes first."""
    return (page_id is not None, page_id or 0, digest)


def _responses(starts: list[tuple], ranges: list[int]):
    """The rows with their range and their response record in place of the payload."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, urls, ns, digests, payloads = (c.to_pylist() for c in b.columns)
        own = [ranges[bisect_right(starts, _order(i, d)) - 1] for i, d in zip(ids, digests)]
        made = [record(i, u, p, n, d) for i, u, n, d, p in zip(ids, urls, ns, digests, payloads)]
        return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *b.columns[:4], pa.array(made, pa.binary())],
                                          ["range", *b.schema.names[:4], "member"])
    return run


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; checks length and block digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    block = rest[:n]
    if rest[n:] != b"\r\n\r\n" or digest_hex(fields["warc-block-digest"]) != hashlib.sha1(block).hexdigest():
        raise ValueError(f"damaged record {fields.get('warc-record-id')}")
    return fields, block


def digest_hex(value: str) -> str:
    return base64.b32decode(value.partition(":")[2]).hex()


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    gz, parts = zlib.decompressobj(31), []
    data = stream.read(READ_CHUNK)
    while data:
        parts.append(gz.decompress(data))
        if gz.eof:
            yield b"".join(parts)
            data = gz.unused_data
            gz, parts = zlib.decompressobj(31), []
        else:
            data = b""
        data = data or stream.read(READ_CHUNK)
    if parts:
        raise ValueError("the file ends inside a record")


def plan(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to and shard of every distinct (page_id, digest)."""
    keys = materialize(pages.groupBy("page_id", "digest", "n").agg(F.count(F.lit(1)).alias("copies")), "keys")
    last = (keys.where(F.col("n") >= MIN_PAYLOAD).groupBy("digest")
            .agg(F.max("page_id").alias("last"), F.sum("copies").alias("of")).where("of > 1").drop("of"))
    keys = (keys.join(last, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))))

    stored = F.when(F.col("refers_to").isNull(), F.col("n")).otherwise(0)
    keys = keys.select("page_id", "digest", "refers_to",
                       ((stored + HEADER_BYTES) * F.col("copies")).alias("weight"))
    ordered = running_total(keys, [F.col("page_id").asc_nulls_first(), F.col("digest")], "weight", "ordered")
    return ordered.select("page_id", "digest", "refers_to",
                          F.floor(F.col("before") / SHARD_BYTES).alias("shard"))


def write(pages: DataFrame, out: str) -> DataFrame:
    """Write the archive to the folder ``out`` (any place pyarrow.fs opens)
    and return its manifest."""
    spark = pages.sparkSession
    bound_batches(spark)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", F.octet_length(payload).cast("long").alias("n"),
                        F.sha1(payload).alias("digest"), payload.alias("payload"))
    planned = materialize(plan(rows.select("page_id", "n", "digest")), "plan")
    shards = (planned.agg(F.max("shard")).first()[0] or 0) + 1
    n_ranges = min(shards, RANGES)
    planned = planned.withColumn("range", F.floor(F.col("shard") * n_ranges / shards).cast("int"))
    # at most RANGES rows
    firsts = planned.groupBy("range").agg(F.min(F.struct("page_id", "digest")).alias("first")).orderBy("range").collect()
    starts, ranges = [_order(*r["first"]) for r in firsts], [r["range"] for r in firsts]
    # compressed before they are dealt; what turns out a revisit is left behind
    packed = rows.mapInArrow(per_batch(_responses(starts, ranges)),
                             "range int, page_id long, url string, n long, digest string, member binary")
    dealt = (packed.unionByName(planned, allowMissingColumns=True)
             .repartitionById(n_ranges, "range")
             .sortWithinPartitions(F.col("page_id").asc_nulls_first(), "digest", F.col("shard").asc_nulls_last(),
                                   F.col("url").asc_nulls_first())
             .select("page_id", "url", "n", "digest", "member", "refers_to", "shard"))
    temporary = f"_temporary-{uuid.uuid4().hex[:12]}"

    def save(batches):
        store, root = fs.FileSystem.from_uri(out)
        store.create_dir(f"{root}/{temporary}", recursive=True)
        attempt, file, rows = uuid.uuid4().hex[:12], None, []

        def close():
            nonlocal file
            if file:
                file.pop("stream").close()
                rows.append({**file, "sha1": file["sha1"].hexdigest()})
            file = None

        shard = refers_to = None
        nth = 0
        for b in batches:
            for page_id, url, n, digest, member, refers, own in zip(*(c.to_pylist() for c in b.columns)):
                if own is not None:             # the plan's row ahead of its records
                    shard, nth, refers_to = own, nth if own == shard else 0, refers
                    continue
                if file and (file["shard"] != shard or file["bytes"] >= ROLL_BYTES):
                    close()
                if file is None:
                    name = f"shard-{shard:06d}-{nth:04d}.warc.gz"
                    at = f"{temporary}/{name}.{attempt}"
                    file = {"shard": shard, "file": name, "temporary": at, "records": 0, "bytes": 0,
                            "sha1": hashlib.sha1(), "stream": store.open_output_stream(f"{root}/{at}", compression=None)}
                    nth += 1
                raw = member if refers_to is None else record(page_id, url, b"", n, digest, refers_to)
                file["stream"].write(raw)
                file["sha1"].update(raw)
                file["records"] += 1
                file["bytes"] += len(raw)
        close()
        yield pa.RecordBatch.from_pylist(rows, arrow_schema(MANIFEST))

    manifest = materialize(dealt.mapInArrow(save, MANIFEST), "manifest")

    def commit(frames):
        store, root = fs.FileSystem.from_uri(out)
        for df in frames:
            for r in df.itertuples():
                final = f"{root}/{r.file}"
                if store.get_file_info(f"{root}/{r.temporary}").type != fs.FileType.NotFound:
                    store.move(f"{root}/{r.temporary}", final)
                elif store.get_file_info(final).type == fs.FileType.NotFound:
                    raise FileNotFoundError(final)
            yield df

    done = manifest.mapInPandas(commit, MANIFEST).drop("temporary")
    done.write.mode("overwrite").parquet(posixpath.join(out, "_manifest"))
    store, root = fs.FileSystem.from_uri(out)
    if store.get_file_info(f"{root}/{temporary}").type != fs.FileType.NotFound:
        store.delete_dir(f"{root}/{temporary}")      # attempts that were not committed
    with store.open_output_stream(f"{root}/_SUCCESS"):
        pass
    return spark.read.parquet(posixpath.join(out, "_manifest"))


def read(spark: SparkSession, out: str) -> DataFrame:
    """The records of an archive, every digest and count checked."""
    files = spark.read.parquet(posixpath.join(out, "_manifest"))

    def load(batches):
        store, root = fs.FileSystem.from_uri(out)
        for b in batches:
            for f in b.to_pylist():
                n, rows = 0, []
                with store.open_input_stream(f"{root}/{f['file']}", compression=None) as stream:
                    for raw in members(stream):
                        rows.append(_row(*parse(raw)))
                        n += 1
                        if len(rows) == BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(rows, arrow_schema(RECORD))
                            rows = []
                if n != f["records"]:
                    raise ValueError(f"{f['file']} holds {n} of {f['records']} records")
                yield pa.RecordBatch.from_pylist(rows, arrow_schema(RECORD))

    return files.repartition(max(1, files.count()), "file").mapInArrow(load, RECORD)


def _row(fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = digest_hex(fields["warc-payload-digest"])
    if fields["warc-type"] == "response":
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload digest of {fields['warc-record-id']}")
        n, refers_to = len(payload), None
    else:
        n = int(http.decode().lower().partition("content-length:")[2].split()[0])
        refers_to = page_of(fields["warc-refers-to"])
    return {"page_id": page_of(fields["warc-record-id"]), "payload_bytes": n, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": refers_to, "url": fields["warc-target-uri"]}
