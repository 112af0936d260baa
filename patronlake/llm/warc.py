"""WARC archives: a deterministic sharded writer and a reader.

Writing. Payload digests are folded into (digest, largest page_id): the response of each payload, all
others revisit it. Records go to shards by exact quantiles of page_id, not by a sample, and are sorted
inside the shard by (page_id, digest, url). So shards, their order, headers and bytes depend on the
records alone. Each shard is written by a task of its own, which streams it. A shard rolls to its next file once the file has `roll_bytes` compressed bytes. Every
record is a gzip member of its own.

Committing. A task writes files under names of its own attempt and reports them. Spark keeps the
reports of successful attempts only; this manifest is a table in the archive's folder. A second pass
gives the listed files their final names, which it may repeat without harm, and the manifest's success
marker comes last. Readers open what the manifest lists, so leftovers of lost attempts are never seen.

Reading. Each file is read by one task, member by member. Headers are parsed, and lengths and digests
of blocks and payloads are verified.

Defined results: a NULL html is an empty payload; a NULL url becomes an empty target address; a NULL
page_id sorts first and is the response only if no record with an id has its payload; of repeated
page_ids with equal payloads the first by url is the response if theirs is the largest id, and further
ones revisit it; an empty table gives an archive without files; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlake.llm import files
from patronlake.llm.shared import Workspace, prepare, required

ROLL_BYTES = 8 * 1024**2
SHARD_BYTES = 64 * 1024**2  # of payload; more, where there would be over MAX_SHARDS
MAX_SHARDS = 4096
MAX_READERS = 1 << 16  # tasks that read an archive; more files share them
WARC_DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

_FILE = "shard int, part int, temporary string, name string, n_records long, n_bytes long, sha256 string"
_MANIFEST = "name string, n_records long, n_bytes long, sha256 string"
_RECORD = (
    "page_id long, url string, record_type string, record_id string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, file string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {url} {digest}')}>"


def _header_text(value: str) -> str:
    """A header's value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page_id, url: str, payload: bytes, digest: str, repeat: bool, original: int | None) -> bytes:
    """A whole record; if it is a `repeat`, a revisit of the response with page_id `original`."""
    url = _header_text(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if repeat else http + payload
    headers = [
        ("WARC-Type", "revisit" if repeat else "response"),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", WARC_DATE),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if page_id is not None:
        headers.append(("Page-Id", str(page_id)))
    if repeat:
        headers.append(("WARC-Profile", _PROFILE))
        if original is not None:
            headers.append(("Refers-To-Page-Id", str(original)))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without time or name, so that equal records have equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = (zlib.crc32(data) & 0xFFFFFFFF).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail


class _ShardFile:
    def __init__(self, folder: str, shard: int, part: int, attempt: str):
        self.shard, self.part = shard, part
        self.temporary = f"tmp-{attempt}-{shard:06d}-{part:05d}"
        self.store, path = files.opened(f"{folder}/{self.temporary}")
        self.out = self.store.open_output_stream(path, compression=None)
        self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.records += 1
        self.bytes += len(member)

    def close(self) -> tuple:
        self.out.close()
        name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
        return self.shard, self.part, self.temporary, name, self.records, self.bytes, self.digest.hexdigest()


def _shard_writer(folder: str, roll_bytes: int):
    """Rows (shard, page_id, url, payload, digest, response, kind) sorted by shard and record.

    Of kind 0 are notes that name the response of a page's repeated payload; 1 are records that may
    revisit, 2 those that may not.
    """

    def run(batches):
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        current, done = None, []
        last = noted = original = None
        for batch in batches:
            for shard, page, url, payload, digest, response, kind in zip(*(c.to_pylist() for c in batch.columns)):
                here = (page, digest)
                if kind == 0:
                    noted, original = here, response
                    continue
                if current is None or current.shard != shard or current.bytes >= roll_bytes:
                    part = current.part + 1 if current and current.shard == shard else 0
                    if current:
                        done.append(current.close())
                    current = _ShardFile(folder, shard, part, attempt)
                # equal ids with equal payloads stand together; the first of them is the response
                response = original if noted == here else page
                repeat = kind == 1 and (page != response or here == last)
                last = here
                current.add(gzip_member(record_bytes(page, url, payload, digest, repeat, response)))
        if current:
            done.append(current.close())
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [f.split()[0] for f in _FILE.split(", ")]
        columns = zip(*done) if done else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _name_files(folder: str):
    """Gives written files their final names. Repeating it, also after a failure, changes nothing."""

    def run(batches):
        for batch in batches:
            store, root = files.opened(folder)
            for temporary, name in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist()):
                if files.exists(store, f"{root}/{temporary}"):
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
                elif not files.exists(store, f"{root}/{name}"):
                    raise FileNotFoundError(f"neither {temporary} nor {name} is in {folder}")
            yield batch.select(["name", "n_records", "n_bytes", "sha256"])

    return run


def _shard_bounds(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """Ids at which shards begin, from exact sizes (page_id, n): by bins of ids, cut again where full.

    The driver sees at most 4,096 bins at a time and one bound for each shard.
    """
    low, high, total = sizes.agg(F.min("page_id"), F.max("page_id"), F.sum("n")).first()
    if low is None or total <= shard_bytes:
        return []
    width = max(1, -(-(high - low + 1) // 4096))
    bins = (
        sizes.filter(F.col("page_id").isNotNull())
        .groupBy(F.floor((F.col("page_id") - low) / F.lit(width)).cast("long").alias("bin"))
        .agg(F.sum("n").alias("n")).orderBy("bin").collect()
    )
    bounds, held = [], 0
    for b in bins:
        begin = low + b["bin"] * width
        if held and held + b["n"] > shard_bytes:
            bounds.append(begin)
            held = 0
        if b["n"] > shard_bytes and width > 1:
            inside = sizes.filter((F.col("page_id") >= begin) & (F.col("page_id") < begin + width))
            bounds += _shard_bounds(inside, shard_bytes)
        held += b["n"]
    return sorted(set(bounds))


def write_archives(
    pages: DataFrame, folder: str, min_payload: int = 0, shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Writes pages (page_id, url, html) and returns the manifest: name, n_records, n_bytes, sha256.

    Payloads of fewer than `min_payload` bytes are responses always. Payloads are shuffled once, by
    shard. Which records revisit which is worked out on digests alone and sent to the shards as rows
    beside the records.
    """
    spark = pages.sparkSession
    prepare(spark)
    space = Workspace(spark, "warc")
    records = required(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    ids = space.put("ids", records.select("page_id", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n")))
    counted = ids.filter(F.col("n") >= min_payload)
    repeated = space.put(
        "repeated",
        counted.groupBy("sha1").agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
        .filter("copies > 1").select("sha1", "response"),
    )
    total = ids.agg(F.sum("n")).first()[0] or 0
    bounds = _shard_bounds(ids.select("page_id", "n"), max(shard_bytes, total // MAX_SHARDS))
    shard = F.coalesce(_shard_of(bounds), F.lit(0)).cast("int").alias("shard")
    notes = counted.join(repeated, "sha1").select(
        shard, "page_id", F.lit("").alias("url"), F.lit(b"").alias("payload"), _base32(F.col("sha1")).alias("digest"),
        "response", F.lit(0).alias("kind"),
    )
    rows = records.select(
        shard, "page_id", "url", "payload", _base32(F.sha1("payload")).alias("digest"),
        F.lit(None).cast("long").alias("response"),
        F.when(F.octet_length("payload") >= min_payload, 1).otherwise(2).alias("kind"),
    )
    written = (
        rows.unionByName(notes).repartitionById(len(bounds) + 1, "shard")  # a task for each shard
        .sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
        .mapInArrow(_shard_writer(folder, roll_bytes), _FILE)
    )
    _make_folder(spark, folder)
    manifest_path = f"{folder}/manifest-attempts"
    written.write.mode("overwrite").parquet(manifest_path)
    attempts = spark.read.schema(_FILE).parquet(manifest_path)
    named = attempts.mapInArrow(_name_files(folder), _MANIFEST)
    named.write.mode("overwrite").parquet(f"{folder}/manifest")
    for name in ("ids", "repeated"):
        space.drop(name)
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _shard_of(bounds: list[int]):
    """How many bounds lie at or below page_id; a long list is looked up in two steps."""

    def below(values):
        return F.size(F.filter(values, lambda b: b <= F.col("page_id")))

    if not bounds:
        return F.lit(0)
    step = 64
    heads = F.array(*map(F.lit, bounds[::step]))
    rows = F.array(*[F.array(*map(F.lit, bounds[i : i + step])) for i in range(0, len(bounds), step)])
    head = below(heads)
    return F.when(head == 0, 0).otherwise((head - 1) * step + below(F.get(rows, head - 1)))


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _base32(hexes):
    """Upper-case base32 of 40 hexadecimal digits, by five digits to four."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = []
    for i in range(0, 40, 5):
        number = F.conv(F.substring(hexes, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substr(F.lit(alphabet), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def parse_record(record: bytes) -> dict:
    """Headers and payload; raises if a length or digest does not hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"length of record {headers['WARC-Record-ID']} does not hold")
    if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest of record {headers['WARC-Record-ID']} does not hold")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (length != len(payload) or digest != base32_sha1(payload)):
        raise ValueError(f"payload of record {headers['WARC-Record-ID']} does not hold")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("Page-Id"), "url": headers["WARC-Target-URI"], "record_type": headers["WARC-Type"],
        "record_id": headers["WARC-Record-ID"], "refers_to": number("Refers-To-Page-Id"),
        "payload_bytes": length, "payload_digest": digest,
        "payload": payload if headers["WARC-Type"] == "response" else None,
    }


def _file_reader(folder: str, with_payload: bool):
    def run(batches):
        names = [f.split()[0] for f in _RECORD.split(", ")]
        kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        for batch in batches:
            store, root = files.opened(folder)
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                for record in _stream(store, f"{root}/{name}"):
                    row = parse_record(record) | {"file": name}
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield _as_batch(rows, names, kinds)
                        rows, held = [], 0
                yield _as_batch(rows, names, kinds)

    return run


def _as_batch(rows, names, kinds):
    columns = [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _stream(store, path: str, piece: int = 4 << 20):
    """Records of a file, which is read in pieces."""
    with store.open_input_stream(path, compression=None) as source:
        unpacker, parts = zlib.decompressobj(31), []
        data = source.read(piece)
        while data:
            parts.append(unpacker.decompress(data))
            if unpacker.eof:
                yield b"".join(parts)
                data, unpacker, parts = unpacker.unused_data or source.read(piece), zlib.decompressobj(31), []
            else:
                data = source.read(piece)
        if parts:
            raise ValueError(f"{path} ends inside a record")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives that the folder's manifest lists, each file by one task.

    Columns: page_id, url, record_type, record_id, refers_to, payload_bytes, payload_digest, payload
    (NULL for revisits), file.
    """
    prepare(spark)
    manifest = spark.read.parquet(f"{folder}/manifest").select("name")
    # a given number of tasks: by the size of the names alone, adaptive execution would make one of them
    tasks = max(1, min(MAX_READERS, manifest.count()))
    return manifest.repartition(tasks).mapInArrow(_file_reader(folder, with_payload), _RECORD)
