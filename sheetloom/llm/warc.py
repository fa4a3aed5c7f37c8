"""WARC archives: a deterministic sharded writer, and a reader.

Writing
* The order is by record id.  Shards are ranges of it, cut where the running size of the
  records before (payloads and headers) passes a multiple of the shard's size.  The running
  size is exact, whatever ranges it is added up in, so that the same input always gives the
  same shards, on any cluster, and finding them takes a fixed number of jobs.
* A task writes one shard: records sorted by id, each its own gzip member, into files that
  roll once their compressed size passes a 16th of the shard's size.  Record ids, dates, lengths and
  SHA-1 digests are generated anew from the data alone: a repeated task writes the same
  bytes.
* A file is written under a temporary name of its task attempt and then renamed.  The
  manifest (one row per file: name, bytes, records, digest) is written last; only files
  that it lists belong to the archive, so a lost or repeated task leaves nothing half
  done.

Equal payloads are stored once: the record with the largest id is the response, the others
revisit it.  What a record refers to is noted by its id and its payload's digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sheetloom.session import durable, shared_folder

SHARDS = 4096              # the shards grow with the archive while it has so many,
SHARD_BYTES = 32 << 20     # from this uncompressed size
SHARD_MOST = 1 << 30       # to this one
ROLL = 16                  # a file rolls at this part of a shard's size, compressed
FILE_BYTES = SHARD_MOST // ROLL
HEADER_BYTES = 640         # what a record weighs besides its payload
DATE = "2000-01-01T00:00:00Z"     # of records without a date; the writer never reads a clock
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")     # the URL namespace
_ID_BITS = 62


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(record_id: int | str) -> str:
    return f"urn:uuid:{uuid.uuid5(_NAMESPACE, f'record:{record_id}')}"


def _line(text: str | None) -> str:
    """A header value: one line, whatever the source holds."""
    return " ".join((text or "").split()) or "about:blank"


def record(record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record with regenerated headers; one without an id is named by its payload."""
    if refers_to is None:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        block = http + payload
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_urn(digest if record_id is None else record_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if record_id is not None:
        headers.append(f"X-Record-Key: {record_id}")
    if refers_to is not None:
        headers += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_urn(refers_to)}>",
                    f"X-Refers-To-Key: {refers_to}"]
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


# --- shards -----------------------------------------------------------------------

def _bounds(sizes: DataFrame) -> tuple[list[int], int]:
    """First ids of the shards after the first, and a shard's size, from ``id, bytes``.

    The running size is added up within ranges of the id first and then over the ranges;
    at most ``SHARDS`` cuts reach the driver below ``SHARDS * SHARD_MOST`` bytes, beyond that
    one for each ``SHARD_MOST``.
    """
    per_id = sizes.where("id is not null").groupBy("id").agg(
        F.sum(F.col("bytes") + HEADER_BYTES).cast("long").alias("bytes"))
    ranges = durable(per_id.repartitionByRange("id").withColumn("range", F.spark_partition_id()))
    totals = ranges.groupBy("range").agg(F.sum("bytes").alias("all"))
    # as many rows as a shuffle has partitions
    before = totals.select("range", (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("before"),
                           F.sum("all").over(Window.partitionBy()).alias("total"))
    within = F.sum("bytes").over(Window.partitionBy("range").orderBy("id")) - F.col("bytes")
    size = F.least(F.greatest(F.floor(F.col("total") / SHARDS), F.lit(SHARD_BYTES)), F.lit(SHARD_MOST)).cast("long")
    placed = ranges.withColumn("within", within).join(F.broadcast(before), "range").select(
        "id", size.alias("size"), F.expr("(before + within)").alias("start")).withColumn(
        "shard", F.expr("start div size"))
    rows = placed.groupBy("shard").agg(F.min("id").alias("first"), F.max("size").alias("size")).collect()
    return sorted(r["first"] for r in rows)[1:], max((r["size"] for r in rows), default=SHARD_BYTES)


def _shard_of(spark: SparkSession, cuts: list[int]):
    """The shard of an id; records without an id are dealt by their payload."""
    shared = spark.sparkContext.broadcast(np.array(cuts, dtype=np.int64))

    @F.pandas_udf("int")
    def find(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, ids.to_numpy(np.int64), side="right").astype(np.int32))

    return lambda digest: F.when(
        F.col("id").isNull(), F.pmod(F.xxhash64(digest), F.lit(len(cuts) + 1)).cast("int")).otherwise(
        find(F.coalesce(F.col("id"), F.lit(0))) if cuts else F.lit(0))


# --- writing ----------------------------------------------------------------------

class _Roller:
    """The files of one shard, in a folder of any file system that Arrow opens."""

    def __init__(self, folder: str, shard: int, attempt: str, limit: int | None = None):
        from pyarrow import fs

        self.limit = limit
        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.number, self.out = shard, attempt, 0, None

    def write(self, data: bytes, key: int) -> dict | None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.hidden = f"{self.path}/_temporary-{self.attempt}-{self.name}"
            self.out, self.sha = self.fs.open_output_stream(self.hidden, compression=None), hashlib.sha256()
            self.bytes = self.records = 0
            self.first = key
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)       # one member, no time stamp
        member = packer.compress(data) + packer.flush()
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1
        self.last = key
        return self.close() if self.bytes >= (FILE_BYTES if self.limit is None else self.limit) else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.hidden, f"{self.path}/{self.name}")
        self.out, self.number = None, self.number + 1
        return {"file": self.name, "bytes": self.bytes, "records": self.records,
                "first_id": self.first, "last_id": self.last, "sha256": self.sha.hexdigest()}


def _writer(folder: str, limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        roller, noted, done = None, None, []
        for batch in batches:
            for shard, key, kind, url, html, digest, refers in batch.itertuples(index=False):
                if roller is None:
                    roller = _Roller(folder, shard, f"{task.stageId()}-{task.taskAttemptId()}", limit)
                key = None if pd.isna(key) else int(key)
                if kind == 0:
                    noted = (key, digest, int(refers))
                    continue
                payload = (html or "").encode("utf-8", "surrogatepass")
                refers = noted[2] if noted and noted[:2] == (key, digest) else None
                done.append(roller.write(record(key, url, payload, digest, refers), key))
        done += [roller.close()] if roller else []
        done = [row for row in done if row]
        if done:
            out = pd.DataFrame(done)
            yield out.assign(**{c: out[c].astype("Int64") for c in ("first_id", "last_id")})

    return run


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html`` as WARC files into ``folder``; returns the manifest.

    A null html is an empty payload; a null url is ``about:blank``.  Of equal payloads the
    largest page_id is the response; repeated rows of that id are responses too.  Rows of one
    page_id with different payloads are records of their own.  A row with a null page_id is
    a record without a key: it revisits an equal payload that has one, else it is a
    response.  All rows of one page_id lie in one shard.  Extra columns are ignored; an empty
    table gives an empty manifest.
    """
    spark = records.sparkSession
    rows = records.select(F.col("page_id").cast("long").alias("id"), "url",
                          F.coalesce("html", F.lit("")).alias("html"))
    sha = F.sha1(F.encode("html", "UTF-8"))
    digested = durable(rows.select("id", sha.alias("sha"), F.octet_length("html").alias("bytes")))
    cuts, size = _bounds(digested.select("id", "bytes"))
    # groups of equal payloads: only ids travel, and only repeated ones are joined
    last = digested.groupBy("sha").agg(F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1")
    refers = (digested.join(last, "sha").where("coalesce(id < response, response is not null)")
              .select("id", "sha", F.col("response").alias("refers")).distinct())
    made = f"{folder.rstrip('/')}"
    _hadoop_mkdirs(spark, made)
    shard = _shard_of(spark, cuts)
    # what a record refers to comes as a row of its own just before it: one shuffle of the payloads
    keyed = rows.withColumn("digest", _base32(sha))
    records_ = keyed.select(shard("digest").alias("shard"), "id", F.lit(1).alias("kind"), "url", "html",
                            "digest", F.lit(None).cast("long").alias("refers"))
    noted = refers.withColumn("digest", _base32(F.col("sha")))
    notes = noted.select(shard("digest").alias("shard"), "id", F.lit(0).alias("kind"), *[
        F.lit(None).cast("string").alias(c) for c in ("url", "html")], "digest", "refers")
    ready = (records_.union(notes).repartitionById(len(cuts) + 1, F.col("shard"))
             .sortWithinPartitions("id", "digest", "kind", "url"))
    schema = "file string, bytes long, records long, first_id long, last_id long, sha256 string"
    ready.mapInPandas(_writer(made, max(1, size // ROLL)), schema).write.parquet(f"{made}/manifest")
    return spark.read.schema(schema).parquet(f"{made}/manifest")


def _base32(hexadecimal):
    """Upper-case base32 of a hexadecimal SHA-1 (160 bits are 32 letters exactly)."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = [F.conv(F.substring(hexadecimal, 10 * i + 1, 10), 16, 10).cast("long") for i in range(4)]
    return F.concat(*[F.substring(letters, F.shiftright(g, 35 - 5 * k).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
                      for g in groups for k in range(8)])


def _hadoop_mkdirs(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


# --- reading ----------------------------------------------------------------------

def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpack, held = zlib.decompressobj(31), []
    data = stream.read(1 << 20)
    while data:
        held.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(held)
            data, unpack, held = unpack.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(1 << 20)
    if any(held):
        raise ValueError("an archive ends within a record")


def parsed(data: bytes) -> dict:
    """Headers and payload of one record, with its digests and lengths checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
    kind = headers["WARC-Type"]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    return {"page_id": int(headers["X-Record-Key"]) if "X-Record-Key" in headers else None, "url": headers["WARC-Target-URI"],
            "payload_bytes": int(headers["X-Payload-Length"]) if payload is None else len(payload),
            "payload_digest": digest, "record_type": kind,
            "refers_to": int(headers["X-Refers-To-Key"]) if "X-Refers-To-Key" in headers else None,
            "payload": payload}


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, expected in zip(batch["file"], batch["records"]):
                held, size, n = [], 0, 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        row = parsed(member)
                        n, size = n + 1, size + len(member)
                        if not with_payload:
                            del row["payload"]
                        held.append(row)
                        if len(held) >= 2000 or size > 8 << 20:
                            yield _frame(held)
                            held, size = [], 0
                if n != expected:
                    raise ValueError(f"{name} has {n} records, not {expected}")
                if held:
                    yield _frame(held)

    return run


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows)
    return out.assign(**{c: out[c].astype("Int64") for c in ("page_id", "refers_to")})


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of an archive: ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to`` and ``payload`` (null for a revisit).  Only files of the
    manifest are read; digests and counts are checked."""
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long" + (", payload binary" if with_payload else ""))
    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest").select("file", "records")
    files = manifest.repartition(max(1, spark.sparkContext.defaultParallelism * 2), "file")
    return files.mapInPandas(_reader(folder.rstrip("/"), with_payload), schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to the shared folder and read the archive's records back."""
    folder = f"{_uri(shared_folder(pages.sparkSession))}/warc-{uuid.uuid4().hex}"
    write(pages, folder)
    return read(pages.sparkSession, folder, with_payload=False)


def _uri(folder: str) -> str:
    return folder if ":" in folder.split("/")[0] else f"file://{folder}"
