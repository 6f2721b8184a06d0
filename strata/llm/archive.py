"""WARC archives with a two-level capture index: sorted keys in compressed blocks, and a sparse directory of them."""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import new_path, staged

FILE_BYTES = 64 << 20
LINES_PER_BLOCK = 500
_ENTRY = "key string, page_id bigint, file string, at bigint, size bigint"
#: The date that records carry: the test pages have none, and archives of equal pages should be equal bytes.
DATE = "2020-01-01T00:00:00Z"


def reversed_host_key(url: str | None) -> str:
    """Key that sorts captures by host from the right, then port, path and query: com,example)/path?query."""
    if not url:
        return ")"
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:  # not a valid URL: kept whole, in a place of its own
        return f")!{url}"
    return (",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
            + (f"?{parts.query}" if parts.query else "") + (f"#{parts.fragment}" if parts.fragment else ""))


def capture_key(url: str | None, number: int) -> str:
    return f"{reversed_host_key(url)} {number:020d}"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(number: int, page_id: int | None, url: str | None, payload: bytes, original: int | None, is_revisit: bool) -> bytes:
    """One record, compressed as a gzip member of its own. A revisit has headers only and names the record it repeats."""
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:capture:{number}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if is_revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if original is not None:
            lines.append(f"WARC-Refers-To: <urn:page:{original}>")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if is_revisit else payload)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one compressed record."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def mark_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with number (unique), original (page_id of the first record with the same payload) and is_revisit.

    The first record of a payload is that with the smallest page_id (a null one comes last), then the smallest number.
    Payloads are equal when length and SHA-256 are. Only payloads that occur more than once reach the join.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
                        F.monotonically_increasing_id().alias("number"))
    keyed = rows.withColumns({"bytes": F.octet_length("payload"), "sum": F.sha2("payload", 256)})
    rank = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page"), F.col("number").alias("row"))
    first = staged(keyed.where(F.col("bytes") >= least_bytes).groupBy("sum", "bytes").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select(F.col("sum").alias("sum2"), F.col("bytes").alias("bytes2"), "first"))
    marked = keyed.join(first, (F.col("sum") == F.col("sum2")) & (F.col("bytes") == F.col("bytes2")), "left")
    return marked.select("page_id", "url", "payload", "number", F.col("first.page").alias("original"),
                         (F.col("first.row").isNotNull() & (F.col("first.row") != F.col("number"))).alias("is_revisit"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page into .warc.gz files under ``folder`` and return the index entries.

    ``folder`` is a place that all executors reach. A task writes under names of its own, so a repeated task leaves
    unused files behind but never half of a used one: what the index does not name is not part of the archive.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, top = open_folder(folder)
        system.create_dir(top, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            entries = []
            for page_id, url, payload, number, original, revisit in batch.itertuples(index=False):
                member = record(number, None if pd.isna(page_id) else int(page_id), url, payload, None if pd.isna(original) else int(original), revisit)
                if out is None or at + len(member) > file_bytes and at:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                out.write(member)
                entries.append((capture_key(url, number), page_id, name, at, len(member)))
                at += len(member)
            frame = pd.DataFrame(entries, columns=["key", "page_id", "file", "at", "size"])
            yield frame.astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    return staged(mark_revisits(pages, least_bytes).mapInPandas(run, _ENTRY))


def build_index(entries: DataFrame, lines: int = LINES_PER_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(blocks, directory). Entries are sorted by key across shards; a block is up to ``lines`` entries, compressed.

    blocks: shard, block, first_key, last_key, content. directory: the same without content, one row per block.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[str] = []
        number = 0

        def close(part: list[str]) -> pd.DataFrame:
            content = zlib.compress("\n".join(part).encode(), 6)
            keys = [x.split("\t", 1)[0] for x in (part[0], part[-1])]
            return pd.DataFrame({"block": [number], "first_key": [keys[0]], "last_key": [keys[1]], "content": [content]})

        for batch in batches:
            waiting += [f"{k}\t{f}\t{a}\t{s}" for k, f, a, s in zip(batch["key"], batch["file"], batch["at"], batch["size"], strict=True)]
            while len(waiting) >= lines:
                yield close(waiting[:lines])
                waiting, number = waiting[lines:], number + 1
        if waiting:
            yield close(waiting)

    ordered = entries.select(F.translate("key", "\t\n\r", "___").alias("key"), "file", "at", "size").repartitionByRange("key").sortWithinPartitions("key")
    blocks = ordered.mapInPandas(run, "block int, first_key string, last_key string, content binary")
    blocks = staged(blocks.withColumn("shard", F.spark_partition_id()))
    return blocks, blocks.drop("content")


def look_up(keys: DataFrame, blocks: DataFrame, directory: DataFrame) -> DataFrame:
    """Places of captures: rows of ``keys`` (key, ...) that the index has, with file, at, size.

    Level one: shard bounds, one row per shard (as many as there are shuffle partitions, not as data), are broadcast
    and binary-searched. Level two: the keys of a shard meet its directory and blocks in key order, where each block is opened once.
    """
    bounds = directory.groupBy("shard").agg(F.min("first_key").alias("first_key")).orderBy("first_key").collect()
    firsts, shards = [r["first_key"] for r in bounds], [r["shard"] for r in bounds]

    @F.pandas_udf("int")
    def shard_of(wanted: pd.Series) -> pd.Series:
        return wanted.map(lambda k: shards[bisect.bisect_right(firsts, k) - 1] if firsts and k >= firsts[0] else -1).astype("int32")

    wanted = keys.select(F.translate("key", "\t\n\r", "___").alias("key")).withColumn("shard", shard_of("key"))

    def run(_key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("first_key")
        starts, contents = right["first_key"].tolist(), right["content"].tolist()
        found, opened, lines = [], -1, []
        for key in left["key"].sort_values():
            i = bisect.bisect_right(starts, key) - 1
            if i < 0:
                continue
            if i != opened:
                opened, lines = i, zlib.decompress(contents[i]).decode().split("\n")
            j = bisect.bisect_left(lines, key + "\t")
            if j < len(lines) and lines[j].startswith(key + "\t"):
                _, file, at, size = lines[j].split("\t")
                found.append((key, file, int(at), int(size)))
        return pd.DataFrame(found, columns=["key", "file", "at", "size"])

    return wanted.groupBy("shard").cogroup(blocks.groupBy("shard")).applyInPandas(run, "key string, file string, at bigint, size bigint")


def read_captures(places: DataFrame, folder: str) -> DataFrame:
    """Read records by range: places (key, file, at, size) to key, page_id, payload, digest, record_type, refers_to.

    The ranges of a file are read in order through one open file. Digests are checked against the payloads.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, top = open_folder(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for key, file, at, size in batch[["key", "file", "at", "size"]].itertuples(index=False):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{top}/{file}")
                headers, payload = parse(source.read_at(size, at))
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = headers["WARC-Type"]
                if kind == "response" and sha1_base32(payload) != digest:
                    raise ValueError(f"damaged record {headers['WARC-Record-ID']} in {file}")
                refers = headers.get("WARC-Refers-To")
                rows.append((key, int(headers["X-Page-ID"]) if "X-Page-ID" in headers else None, headers.get("WARC-Target-URI"),
                             payload if kind == "response" else None, int(headers["X-Payload-Length"]), digest, kind,
                             int(refers[len("<urn:page:"):-1]) if refers else None))
            frame = pd.DataFrame(rows, columns=["key", "page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
        if source is not None:
            source.close()

    return places.repartition("file").sortWithinPartitions("file", "at").mapInPandas(
        run, "key string, page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and read every capture back through the index.

    A null html is an empty payload, a null url a capture without target, a null page_id stays null and is the last
    choice for an original; rows that repeat are captures each, told apart by the row's number in the key; an empty
    table gives no rows; other columns are ignored.
    """
    folder = folder or new_path(pages.sparkSession)
    entries = write_archives(pages, folder, least_bytes)
    blocks, directory = build_index(entries)
    return read_captures(look_up(entries.select("key"), blocks, directory), folder)
