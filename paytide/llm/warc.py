"""Writing pages as WARC files and reading them back.

Records are sorted by page id into shards whose borders depend on the data alone, every
record is a gzip member of its own, and a file is closed when it has reached a compressed
size. Headers, digests and record ids are made anew from the page, so the same table gives
the same bytes. Tasks write under temporary names only; their manifest is committed by
Spark with the tasks that succeeded, and then each file it lists is renamed. A reader
follows the manifest, so files of lost or repeated attempts never count. A driver lost
between the manifest and the last rename leaves an archive that `finish_archive` completes.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.llm.frames import narrowed, staged

_NAMESPACE = uuid.UUID("6f1d7c50-5f0a-4b5e-9d52-7a1f0b8f2c11")
_PLAIN = "%/:=&?~#+!$,;'@()*[]"
#: Bytes given to the inflater at once: what follows a record is copied once a record.
_CHUNK = 1 << 15
#: Bytes read from the store at once.
_BUFFER = 1 << 20
#: Tasks that write shards; more shards than that share tasks.
_WRITERS = 100_000


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {digest}')}>"


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One record as a gzip member. `refers_to`: the page whose response has the payload."""
    digest = payload_digest(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = f"urn:page:{page_id}" if url is None else quote(url, safe=_PLAIN)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    head.append(f"Content-Length: {len(block)}")
    return _member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _info(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = [
        "WARC/1.1",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>",
        f"WARC-Date: {date}",
        f"WARC-Filename: {name}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
    ]
    return _member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class _Roller:
    """Writes the records of one shard, a new file whenever one is full."""

    def __init__(self, path: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.root = _open(path)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.number, self.file = 0, None

    def add(self, data: bytes):
        if self.file is None:
            name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{uuid.uuid4().hex}-{name}"
            self.name, self.records, self.bytes = name, 0, 0
            self.file = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self._write(_info(name, self.date))
        self._write(data)
        self.records += 1
        return self.end() if self.bytes >= self.roll_bytes else None

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.bytes += len(data)

    def end(self):
        """The manifest row of the file that was open, if any."""
        if self.file is None:
            return None
        self.file.close()
        self.file = None
        self.number += 1
        return (self.temporary, self.name, self.records, self.bytes)


def _borders(ids: DataFrame, shards: int, total: int) -> list[int]:
    """Ids that part the shards: quantiles of the ids whose hash is small.

    The choice depends on the ids alone, so the same table has the same shards. The list
    has about 32 ids per shard, whatever the number of pages.
    """
    if shards < 2:
        return []
    share = max(1, total // (32 * shards))
    chosen = ids.filter(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select("id").distinct()
    values = np.sort(np.array([r["id"] for r in chosen.collect()], np.int64))
    at = (np.arange(1, shards) * len(values)) // shards
    return sorted(set(values[at].tolist())) if len(values) else []


def write_archive(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = 8 << 20,
    roll_bytes: int = 2 << 20,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one WARC record per row under `path`; returns the manifest.

    The payload is the html in UTF-8, empty where null. Of rows with equal payloads of
    `least_bytes` or more, those with the smallest id are responses and the others are
    revisits of it. Ids are integers; a row without an id is a response and is referred
    to by none. A null url becomes `urn:page:<id>`. Repeated rows are written each. An
    empty table gives a manifest without files. Other columns are not read. `path` is a
    folder that the executors and the driver share, in any store pyarrow can write to.
    """
    spark = df.sparkSession
    pages = narrowed(df, id=id_col, url=url_col, html=html_col).select(
        F.col("id").cast("long").alias("id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    facts = staged(pages.select("id", F.sha1("html").alias("sha"), F.octet_length("html").alias("size")))
    shape = facts.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    shards = max(1, math.ceil((shape["size"] or 0) / shard_bytes))
    known = facts.filter(f"id IS NOT NULL AND size >= {int(least_bytes)}")
    first = staged(
        known.groupBy("sha")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .filter("low < high")
        .select("sha", "low")
    )
    revisits = known.join(first, "sha").filter("id > low").select("id", "sha", F.col("low").alias("refers"))
    borders = spark.sparkContext.broadcast(np.array(_borders(facts.select("id").dropna(), shards, shape["n"]), np.int64))

    def shard(batches):
        for batch in batches:
            ids = batch["id"].fill_null(-(2**63)).to_numpy()
            at = np.searchsorted(borders.value, ids, side="right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "shard"])

    both = (
        revisits.distinct()
        .select("id", F.lit(0).alias("kind"), "refers", "sha", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
        .union(pages.select("id", F.lit(1), F.lit(None).cast("long"), F.sha1("html"), "url", "html"))
    )
    columns = "id long, kind int, refers long, sha string, url string, html string"
    target = path.rstrip("/")

    def write(batches):
        roller, at, refers = None, (None, None), {}
        for batch in batches:
            done = []
            for row in zip(*(batch[c].to_pylist() for c in ("shard", "id", "kind", "refers", "sha", "url", "html")), strict=True):
                number, page, kind, low, sha, url, html = row
                if (number, page) != at:
                    if roller is None or number != at[0]:
                        done.append(roller and roller.end())
                        roller = _Roller(target, number, roll_bytes, date)
                    at, refers = (number, page), {}
                if kind == 0:
                    refers[sha] = low
                else:
                    done.append(roller.add(record(page, url, html.encode(), refers.get(sha), date)))
            yield manifest(done)
        if roller:
            yield manifest([roller.end()])

    def manifest(rows: list) -> pa.RecordBatch:
        rows = [r for r in rows if r]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["temporary", "file", "records", "bytes"],
        )

    store, root = _open(target)
    store.create_dir(f"{root}/_temporary", recursive=True)
    written = (
        both.mapInArrow(shard, f"{columns}, shard long")
        .repartition(min(shards, _WRITERS), "shard")
        .sortWithinPartitions("shard", "id", "sha", "kind")
        .mapInArrow(write, "temporary string, file string, records long, bytes long")
    )
    # Spark commits this table with the rows of successful attempts only.
    written.write.parquet(f"{target}/_manifest")
    return finish_archive(spark, target)


def finish_archive(spark: SparkSession, path: str) -> DataFrame:
    """Give the files of a committed manifest their names; returns the manifest.

    Part of `write_archive`, and safe to call again at any time after the manifest is
    written: files that have their names already stay as they are.
    """
    target = path.rstrip("/")
    listed = spark.read.parquet(f"{target}/_manifest")

    def rename(batches):
        for batch in batches:
            store, root = _open(target)
            for temporary, name in zip(batch["temporary"].to_pylist(), batch["file"].to_pylist(), strict=True):
                # Running again after a rename finds the file in its place.
                if store.get_file_info(f"{root}/{temporary}").type.name != "NotFound":
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
            yield batch.select(["file"])

    listed.mapInArrow(rename, "file string").agg(F.count("file")).first()
    store, root = _open(target)
    if store.get_file_info(f"{root}/_temporary").type.name != "NotFound":
        store.delete_dir(f"{root}/_temporary")
    return listed.select("file", "records", "bytes")


def _records(stream):
    """Header lines and block of every record of an archive."""
    inflate, out, rest = zlib.decompressobj(31), [], b""
    while True:
        if not rest:
            rest = stream.read(_CHUNK)
            if not rest:
                break
        out.append(inflate.decompress(rest))
        rest = inflate.unused_data
        if inflate.eof:
            data = b"".join(out)
            head, _, block = data.partition(b"\r\n\r\n")
            lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield lines, block[: int(lines["Content-Length"])]
            inflate, out = zlib.decompressobj(31), []
        else:
            rest = b""
    if any(out):
        raise ValueError("the archive ends within a record")


RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long"
)


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of the files in the manifest; every payload and block is checked.

    `payload` (binary, on request) is the stored one: null for revisits, whose size and
    digest are those of the payload they refer to.
    """
    target = path.rstrip("/")

    def read(batches):
        for batch in batches:
            store, root = _open(target)
            for name in batch["file"].to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None, buffer_size=_BUFFER) as stream:
                    for head, block in _records(stream):
                        if head["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_row(head, block))
                        held += len(block)
                        if held > 8 << 20:
                            yield table(rows)
                            rows, held = [], 0
                yield table(rows)

    def _row(head: dict, block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rsplit(b"Content-Length: ", 1)[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = head["WARC-Type"] == "revisit"
        if head["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}" or not revisit and (
            payload_digest(payload) != digest or len(payload) != size
        ):
            raise ValueError(f"digest of {head['WARC-Record-ID']}")
        page, refers = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
        return (
            page and int(page),
            head["WARC-Target-URI"],
            size,
            digest,
            head["WARC-Type"],
            refers and int(refers),
            None if revisit else payload,
        )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"]
        batch = pa.RecordBatch.from_arrays(arrays, names=names)
        return batch if with_payload else batch.select(names[:-1])

    files = spark.read.parquet(f"{target}/_manifest").select("file")
    # A number of its own keeps the few small rows from being gathered into one task.
    files = files.repartition(max(1, min(files.count(), 10_000)), "file")
    return files.mapInArrow(read, RECORDS + ", payload binary" * with_payload)
