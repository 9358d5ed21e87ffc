"""Operator 4: WARC archives, written and read back by boundary chains.

Reading never trusts a magic string alone. Tasks over byte ranges of the
archives list every place that looks like a record head, with the place where
its declared length says the next record begins. A record counts only if a chain
of such links leads to it from the start of its file, so a magic string inside a
payload, even with a whole false head, is rejected. Chains are followed inside a
range by the task, and over ranges by pointer jumping in Spark: each round
doubles the distance, so a file of n ranges takes about log2(n) rounds.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, materialise, scratch, text_steps, write_file

MAGIC = b"WARC/1.0\r\n"
#: Scanning reads this far beyond its range at first, and further while a head goes on.
HEAD_BYTES = 64 << 10
#: What a task reads at once, and the least that a further task is worth.
TASK_BYTES = 8 << 20
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, refers: int | None, revisit: bool) -> bytes:
    """One record; a revisit has no block and names the response it refers to."""
    told = digest(payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{told}')}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "Content-Type": "text/html",
        "X-Page-ID": "" if key is None else str(key),
        "WARC-Payload-Digest": f"sha1:{told}",
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        head |= {"WARC-Profile": _PROFILE, "X-Refers-To-Page": "" if refers is None else str(refers)}
    block = b"" if revisit else payload
    head["Content-Length"] = str(len(block))
    return MAGIC + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """Fields and length of the head at a place, or None if there is none."""
    if not data.startswith(MAGIC, at):
        return None
    fields, pos = {}, at + len(MAGIC)
    # line by line: what isn't a head mostly ends at once
    while (end := data.find(b"\r\n", pos)) != pos:
        name, sep, value = data[pos : max(end, pos)].partition(b":")
        if end < 0 or not sep:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
        pos = end + 2
    return (fields, end + 2 - at) if fields.get("content-length", "").isdecimal() else None


def first_of_equal(pages: DataFrame) -> DataFrame:
    """(_sha, _first) of payloads of several rows: the least page id of each.

    Narrow rows, summed before the shuffle, so a payload of a third of all rows
    costs one row a task.
    """
    found = pages.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    return found.where((F.col("_n") > 1) & F.col("_first").isNotNull()).select("_sha", "_first")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = 64 << 20, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row below ``path``; returns (path, bytes, records) per file.

    Of equal payloads of at least ``least_bytes`` bytes the row of the least id
    is the response and the others are revisits of it (rows that repeat that id
    are responses too); smaller payloads and groups without any id are all
    responses. Null html is an empty payload. The html isn't shuffled unless
    the table of repeated payloads is too large to broadcast, in which case
    Spark's skew join deals out a very common payload.
    """
    body = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), body.alias("_html"), F.sha2(body, 256).alias("_sha"))
    # the file's size tells Spark whether it can be broadcast
    again = materialise(first_of_equal(rows.where(F.octet_length("_html") >= least_bytes)), "warc-repeated")
    big = F.octet_length("_html") >= least_bytes
    rows = rows.join(again, "_sha", "left").select("_id", "_url", "_html", F.when(big, F.col("_first")).alias("_first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, made = TaskContext.get().partitionId(), 0, []
        held: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal seq, size
            uri = f"{path}/part-{part:08d}-{seq:06d}.warc"
            made.append((uri, write_file(uri, held), len(held)))
            held.clear()
            seq, size = seq + 1, 0

        for batch in batches:
            ids, urls, firsts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for a, b, texts in text_steps(batch, "_html"):
                for i, html in zip(range(a, b), texts, strict=True):
                    held.append(record(ids[i], urls[i], html, firsts[i], firsts[i] is not None and firsts[i] != ids[i]))
                    size += len(held[-1])
                if size >= file_bytes:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], ["path", "bytes", "records"])

    return materialise(rows.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


def _candidates(data: bytes, first: int, start: int, own: int) -> list[tuple[int, int]]:
    """(offset, offset of the successor) of what looks like a head in the ``own``
    bytes from ``start`` of a file, of which ``data`` is the part from ``first``."""
    out, at, end = [], data.find(MAGIC, start - first), start - first + own
    while 0 <= at < end:
        if head := parse_head(data, at):
            out.append((first + at, first + at + head[1] + int(head[0]["content-length"]) + 4))
        at = data.find(MAGIC, at + 1, end + len(MAGIC) - 1)
    return out


def leave(offsets: np.ndarray, successors: np.ndarray, end: int) -> np.ndarray:
    """For each candidate of a range, where its chain leaves the range: the first
    place at or after ``end``, or -1 if it breaks. Pointer jumping."""
    out = successors.copy()
    while True:
        inside = (out >= 0) & (out < end)
        if not inside.any():
            return out
        k = np.minimum(np.searchsorted(offsets, out[inside]), len(offsets) - 1)
        out[inside] = np.where(offsets[k] == out[inside], out[k], -1)


def _tasks(files: DataFrame, range_bytes: int) -> int:
    """Tasks for all bytes of the archives: by bytes, however small the ranges are."""
    size = files.agg(F.sum("bytes")).first()[0] or 0
    least = min(files.sparkSession.sparkContext.defaultParallelism, -(-size // range_bytes))
    return max(1, min(max(size // max(range_bytes, TASK_BYTES), least), 20_000))


def find_records(files: DataFrame, range_bytes: int = 8 << 20) -> DataFrame:
    """(path, offset, successor) of the records that a chain from the start of
    their file reaches. ``files``: path, bytes."""
    spans = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    unit = max(range_bytes, TASK_BYTES)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, handle, first, data = None, None, 0, b""
        for frame in frames:
            made = []
            for uri, size, start in frame.itertuples(index=False):
                if uri != name:
                    fs, path = filesystem(uri)
                    name, handle, first, data = uri, fs.open_input_file(path), 0, b""
                own = min(range_bytes, size - start)
                want = min(start + own + HEAD_BYTES, size)
                if not first <= start <= want <= first + len(data):
                    # neighbouring ranges are read at once
                    handle.seek(start)
                    first, data = start, handle.read(min(max(unit, want - start), size - start))
                # a head may begin in this range and end anywhere after it
                last = data.rfind(MAGIC, start - first, start - first + own + len(MAGIC) - 1)
                while last >= 0 and first + len(data) < size and data.find(b"\r\n\r\n", last) < 0:
                    handle.seek(first + len(data))
                    data += handle.read(min(len(data), size - first - len(data)))
                found = np.array(_candidates(data, first, start, own), np.int64).reshape(-1, 2)
                if len(found):
                    # a link past the end of the file leads nowhere
                    after = np.where(found[:, 1] <= size, found[:, 1], -1)
                    made.append(pd.DataFrame({"path": uri, "start": start, "offset": found[:, 0], "successor": after, "leave": leave(found[:, 0], after, start + own)}))
            if made:
                yield pd.concat(made)

    placed = spans.repartition(_tasks(files, range_bytes), "path", F.floor(F.col("start") / unit)).sortWithinPartitions("path", "start")
    links = materialise(placed.mapInPandas(scan, "path string, start long, offset long, successor long, leave long"), "warc-links")
    # pointer jumping over ranges, from the start of each file, by places where chains enter a range
    entered = links.where("offset = 0").select("path", "offset")
    places = links.where("leave >= 0").select("path", F.col("leave").alias("offset")).union(entered).distinct()
    jump = links.where("leave >= 0").join(places, ["path", "offset"], "left_semi").select("path", "offset", F.col("leave").alias("to"))
    jump = materialise(jump, "warc-jump")
    ranges = files.agg(F.max("bytes")).first()[0] or 0
    for _ in range(int(np.ceil(np.log2(max(1, -(-ranges // range_bytes)))))):
        step = entered.join(jump, ["path", "offset"]).select("path", F.col("to").alias("offset"))
        entered = materialise(entered.union(step).distinct(), "warc-entered")
        jump = materialise(jump.join(jump.select("path", F.col("offset").alias("to"), F.col("to").alias("far")), ["path", "to"]).select("path", "offset", F.col("far").alias("to")), "warc-jump")
        if jump.isEmpty():
            break
    # inside each range, the chain from where it is entered
    entries = entered.join(links, ["path", "offset"]).select("path", "start", F.col("offset").alias("entry"))

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("offset", ignore_index=True)
        offsets, after = frame["offset"].to_numpy(), frame["successor"].to_numpy()
        keep = np.zeros(len(frame), bool)
        k = int(np.searchsorted(offsets, frame["entry"].iat[0]))
        while k < len(offsets):
            keep[k] = True
            to = after[k]
            k = int(np.searchsorted(offsets, to)) if to >= 0 else len(offsets)
            if k < len(offsets) and offsets[k] != to:
                break
        return frame.loc[keep, ["path", "offset", "successor"]]

    # a group is one range, so its size has a bound
    return links.join(entries, ["path", "start"]).groupBy("path", "start").applyInPandas(walk, "path string, offset long, successor long")


def read_warc(files: DataFrame, range_bytes: int = 8 << 20) -> DataFrame:
    """The records of the archives: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, path, offset.

    For a response both payload columns are computed from the bytes read, and
    must agree with the head (else the row says ``corrupt``); a revisit's are
    its head's. A file whose chain of records stops before its end is an error, and
    so is another number of records than ``files`` say were written, if they do.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, name = None, None
        for batch in batches:
            out: list[tuple] = []
            for uri, offset, successor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if uri != name:
                    fs, path = filesystem(uri)
                    handle, name = fs.open_input_file(path), uri
                handle.seek(offset)
                data = handle.read(successor - offset)
                fields, n = parse_head(data, 0)
                payload = data[n : n + int(fields["content-length"])]
                kind = fields.get("warc-type")
                told, size = fields.get("warc-payload-digest", "").removeprefix("sha1:"), int(fields.get("x-payload-length") or 0)
                if kind == "response":
                    own = digest(payload)
                    kind = kind if (own, len(payload)) == (told, size) else "corrupt"
                    told, size = own, len(payload)
                number = lambda k: int(fields[k]) if fields.get(k) else None
                out.append((number("x-page-id"), fields.get("warc-target-uri"), kind, number("x-refers-to-page"), size, told, uri, offset))
            cols = list(zip(*out, strict=True)) or [[]] * 8
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "path", "offset"])

    found = materialise(find_records(files, range_bytes), "warc-found")
    if "records" in files.columns:
        written, read_back = files.agg(F.sum("records")).first()[0] or 0, found.count()
        if written != read_back:
            raise ValueError(f"{written} records were written, but {read_back} are found")
    last = found.groupBy("path").agg(F.max("successor").alias("last"))
    short = files.where("bytes > 0").join(last, "path", "left").where(~F.col("last").eqNullSafe(F.col("bytes"))).select("path", "last", "bytes").first()
    if short:
        raise ValueError(f"the records of {short['path']} end at {short['last']} of {short['bytes']} bytes")
    # these rows are narrow, but what they name is not: tasks by bytes
    unit = max(range_bytes, TASK_BYTES)
    found = found.repartition(_tasks(files, range_bytes), "path", F.floor(F.col("offset") / unit)).sortWithinPartitions("path", "offset")
    return found.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, path string, offset long")


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0, **options) -> DataFrame:
    """Write the archives (to a scratch folder if no ``path`` is given) and read
    them back. An empty table gives no rows; repeated rows are records each."""
    return read_warc(write_warc(pages, path or scratch(pages.sparkSession, "warc"), least_bytes, **options))
