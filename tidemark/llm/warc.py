"""Web archives with a two-level capture index: sorted key blocks, a sparse directory, range reads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.scratch import fresh_path, written

FILE_BYTES = 256 << 20
BLOCK_LINES = 3000
#: the directory grows by one line per block, so lines per block grow once it would hold more than this
DIRECTORY_LINES = 1_000_000
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CAPTURES = (
    "key string, page_id bigint, url string, file string, start bigint, size bigint, digest string, "
    "payload_bytes bigint, record_type string, refers_to bigint"
)
LINE = ["key", "page_id", "url", "file", "start", "size", "digest", "payload_bytes", "record_type", "refers_to"]


def url_key(url: Column) -> Column:
    """Sort key of an address: host labels in reverse order, then the rest: ``org,example,www)/a?b``; '' for null."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    reverse = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(url.contains("://"), F.concat(reverse, F.lit(")"), rest)).otherwise(url)


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a 160-bit hex digest: five hex digits make four of base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789" + UPPER[:22], UPPER + "234567")


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _record(kind: str, row: dict, date: str) -> bytes:
    payload = row["payload"] if kind == "response" else b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{row['page_id']}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {row['target']}", f"WARC-Payload-Digest: sha1:{row['digest']}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}",
    ]
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    return {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])} | {"": lines[0]}, rest


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url: str = "url",
    html: str = "html",
    at_least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per page to ``folder`` and return the captures (CAPTURES), one row per record.

    Of records with equal payloads of ``at_least`` bytes, that with the smallest page_id (and every repeated row of it)
    is a response, the others are revisits that refer to it. Each task writes files of its own name, a gzip member per
    record; the captures come from the attempts Spark committed, so files of lost attempts are never read. Payloads are
    not shuffled unless the table of repeated digests is too large to be sent to the tasks. Null html is an empty
    payload; a null url an empty target and key; a null id is written as ``none`` and is never smallest.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("payload")
    )
    rows = rows.withColumns({
        "sha": F.sha1(F.col("payload").cast("binary")),
        "payload_bytes": F.octet_length("payload").cast("long"),
    })
    firsts = rows.where(F.col("payload_bytes") >= at_least).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    firsts = written(firsts.where("n > 1").select(F.col("sha").alias("__sha"), "first"), "repeated")
    rows = rows.join(firsts, rows["sha"] == firsts["__sha"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select(
        url_key(F.col("url")).alias("key"), "page_id", "url", F.col("payload").cast("binary").alias("payload"),
        base32(F.col("sha")).alias("digest"), "payload_bytes", F.when(again, F.col("first")).alias("refers_to"),
    )

    def write(batches):
        fs = out = None
        name, at = "", 0
        for batch in batches:
            found = batch.to_pydict()
            starts, sizes, names, kinds = [], [], [], []
            for i in range(batch.num_rows):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    fs, base = _files(folder)
                    fs.create_dir(base, recursive=True)
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                row = {c: found[c][i] for c in found}
                row["page_id"] = "none" if row["page_id"] is None else row["page_id"]
                row["target"] = " ".join((row["url"] or "").splitlines())
                kind = "response" if row["refers_to"] is None else "revisit"
                member = gzip.compress(_record(kind, row, date), 4, mtime=0)
                out.write(member)
                starts.append(at)
                sizes.append(len(member))
                names.append(name)
                kinds.append(kind)
                at += len(member)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([
                    batch.column("key"), batch.column("page_id"), batch.column("url"), pa.array(names, pa.string()),
                    pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), batch.column("digest"),
                    batch.column("payload_bytes"), pa.array(kinds, pa.string()), batch.column("refers_to"),
                ], names=LINE)
        if out is not None:
            out.close()

    return written(rows.mapInArrow(write, CAPTURES), "captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures by key into compressed blocks in ``folder`` and return the directory: the first and last key of
    each block, its file, start, size and number of lines. A key with very many captures fills several blocks."""
    total = captures.count()
    lines = max(block_lines, -(-total // DIRECTORY_LINES))
    order = ["key", "page_id", "file", "start"]
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.select(LINE).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def blocks(batches):
        out, at, name, base = None, 0, "", ""
        held: list[pa.RecordBatch] = []
        count = 0

        def flush(table: pa.Table) -> pa.RecordBatch:
            nonlocal out, at, name, base
            if out is None:
                fs, base = _files(folder)
                fs.create_dir(base, recursive=True)
                name = f"index-{uuid.uuid4().hex}.idx"
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            block = zlib.compress(sink.getvalue().to_pybytes(), 4)
            out.write(block)
            keys = table.column("key")
            made = {"first_key": [keys[0].as_py()], "last_key": [keys[-1].as_py()], "file": [name], "start": [at],
                    "size": [len(block)], "lines": [table.num_rows]}
            at += len(block)
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= lines:
                table = pa.Table.from_batches(held)
                full = count - count % lines
                for lo in range(0, full, lines):
                    yield flush(table.slice(lo, lines))
                rest = table.slice(full)
                held, count = rest.to_batches(), rest.num_rows
        if count:
            yield flush(pa.Table.from_batches(held))
        if out is not None:
            out.close()

    directory = ordered.mapInArrow(
        blocks, "first_key string, last_key string, file string, start bigint, size bigint, lines bigint"
    )
    return written(directory, "directory")


def lookup(spark: SparkSession, keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures (CAPTURES) of the distinct ``key`` values of ``keys``.

    The directory (at most about DIRECTORY_LINES entries) goes to every task, which finds the blocks that may hold a key
    by binary search; each block that any key needs is then read once, as one byte range, by one task, and searched
    for its keys. Keys without a capture give no row.
    """
    entries = directory.orderBy("first_key", "last_key", "file", "start").toArrow()
    sent = spark.sparkContext.broadcast(
        [entries.column(c).to_pylist() for c in ("first_key", "last_key", "file", "start", "size")]
    )

    def find(batches):
        first, last, files, starts, sizes = sent.value
        for batch in batches:
            wanted, block = [], []
            for key in batch.column("key").to_pylist():
                # blocks whose last key is not below, up to the last whose first key is not above
                for k in range(bisect_left(last, key), bisect_right(first, key)):
                    wanted.append(key)
                    block.append(k)
            if block:
                yield pa.RecordBatch.from_arrays([
                    pa.array(wanted, pa.string()), pa.array([files[k] for k in block], pa.string()),
                    pa.array([starts[k] for k in block], pa.int64()), pa.array([sizes[k] for k in block], pa.int64()),
                ], names=["key", "file", "start", "size"])

    asked = keys.select("key").where("key is not null").distinct()
    asked = asked.mapInArrow(find, "key string, file string, start bigint, size bigint")
    # a row here stands for a block to read, so the number of tasks must not follow the bytes of these rows
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = asked.repartition(tasks, "file", "start").sortWithinPartitions("file", "start", "key")

    def read(batches):
        fs = base = handle = None
        opened, at, table, places = "", None, None, []
        for batch in batches:
            picked: list[pa.Table] = []
            rows = batch.to_pydict()
            chosen: list[int] = []
            for key, file, start, size in zip(rows["key"], rows["file"], rows["start"], rows["size"]):
                if (file, start) != at:
                    if chosen:
                        picked.append(table.take(chosen))
                        chosen = []
                    if fs is None:
                        fs, base = _files(folder)
                    if file != opened:
                        handle = fs.open_input_file(f"{base}/{file}")
                        opened = file
                    block = zlib.decompress(handle.read_at(size, start))
                    table = pa.ipc.open_stream(block).read_all()
                    places = table.column("key").to_pylist()
                    at = (file, start)
                chosen.extend(range(bisect_left(places, key), bisect_right(places, key)))
            if chosen:
                picked.append(table.take(chosen))
            for one in picked:
                yield from one.combine_chunks().to_batches()

    return asked.mapInArrow(read, CAPTURES)


def _spans(starts: Sequence[int], sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Index ranges of records that one read fetches: neighbours in the file, up to READ_BYTES."""
    lo = 0
    for i in range(1, len(starts) + 1):
        if i == len(starts) or starts[i] - starts[i - 1] - sizes[i - 1] > GAP_BYTES or starts[i] - starts[lo] > READ_BYTES:
            yield lo, i
            lo = i


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """Read the records of ``captures`` back by byte ranges: page_id, url, payload (null for a revisit), payload_bytes,
    payload_digest, record_type, refers_to, all from the records themselves. A payload that does not match its digest
    raises. Ranges that are neighbours in a file are fetched together."""
    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = F.floor(F.col("start") / READ_BYTES)
    asked = captures.select("file", "start", "size").repartition(tasks, "file", near)
    asked = asked.sortWithinPartitions("file", "start")

    def parse(member: bytes):
        head, body = _headers(zlib.decompress(member, wbits=31))
        http, payload = _headers(body)
        kind = head["WARC-Type"]
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        number = lambda name: None if name not in head or head[name] == "<urn:page:none>" else int(head[name][10:-1])
        size = int(http["Content-Length"])
        if kind == "response":
            payload = payload[:size]
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        return (number("WARC-Record-ID"), head["WARC-Target-URI"], payload if kind == "response" else None, size, digest,
                kind, number("WARC-Refers-To"))

    def read(batches):
        fs = base = handle = None
        opened = ""
        for batch in batches:
            files = np.array(batch.column("file").to_pylist(), object)
            starts, sizes = batch.column("start").to_numpy(), batch.column("size").to_numpy()
            cut = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)]
            for a, b in zip(cut[:-1], cut[1:]):
                if a == b:
                    continue
                if fs is None:
                    fs, base = _files(folder)
                if files[a] != opened:
                    handle = fs.open_input_file(f"{base}/{files[a]}")
                    opened = files[a]
                own, many = starts[a:b].tolist(), sizes[a:b].tolist()
                for lo, hi in _spans(own, many):
                    data = handle.read_at(own[hi - 1] + many[hi - 1] - own[lo], own[lo])
                    made = [parse(data[s - own[lo] : s - own[lo] + n]) for s, n in zip(own[lo:hi], many[lo:hi])]
                    columns = list(zip(*made))
                    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                    )

    return asked.mapInArrow(
        read, "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint"
    )


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write archives and their index for ``pages``, look every address up through the index and read its records."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    captures = write_archives(pages, folder, **options)
    directory = build_index(captures, folder)
    keys = pages.select(url_key(F.col(options.get("url", "url"))).alias("key"))
    return read_records(lookup(spark, keys, directory, folder), folder)
