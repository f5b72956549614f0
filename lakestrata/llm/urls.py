"""Allow and block rules for urls, held as a sorted digest array that tasks map into memory."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import hadoop_path, scratch_path
from .store import ready

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ADDRESS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def _key(host: str, length: int, path: str) -> bytes:
    return f"{host}\0{length}\0{path}".encode()


class DigestArray:
    """Sorted 64-bit xxhash keys with the full strings they stand for.

    Layout of the file, all little-endian: number of keys; keys; for each key the end of its string in the
    text that follows and a value; text. It is mapped, so all workers of a machine share one copy of it.
    """

    def __init__(self, path: str):
        n = int(np.memmap(path, "<u8", "r", 0, 1)[0])
        self.keys = np.memmap(path, "<u8", "r", 8, n) if n else np.zeros(0, "<u8")
        self.ends = np.memmap(path, "<i8", "r", 8 + 8 * n, n) if n else np.zeros(0, "<i8")
        self.values = np.memmap(path, "<i8", "r", 8 + 16 * n, n) if n else np.zeros(0, "<i8")
        self.text = np.memmap(path, "u1", "r", 8 + 24 * n) if n else np.zeros(0, "u1")

    @staticmethod
    def packed(entries: dict[bytes, int], digest=xxhash.xxh64_intdigest) -> bytes:
        rows = sorted((digest(k), k, v) for k, v in entries.items())
        ends = np.cumsum([len(k) for _, k, _ in rows], dtype="<i8")
        columns = (np.array([len(rows)], "<u8"), np.array([r[0] for r in rows], "<u8"), ends, np.array([r[2] for r in rows], "<i8"))
        return b"".join(c.tobytes() for c in columns) + b"".join(r[1] for r in rows)

    def find(self, wanted: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """The value of each string, -1 where it is not held: one binary search for all digests, then the
        stored string decides; strings that share a digest lie side by side and are tried in turn."""
        digests = np.fromiter(map(digest, wanted), np.uint64, len(wanted))
        low, high = np.searchsorted(self.keys, digests), np.searchsorted(self.keys, digests, "right")
        out = np.full(len(wanted), -1, np.int64)
        for i in np.flatnonzero(low < high):
            for j in range(low[i], high[i]):
                start = int(self.ends[j - 1]) if j else 0
                if self.text[start : int(self.ends[j])].tobytes() == wanted[i]:
                    out[i] = self.values[j]
        return out


@lru_cache(maxsize=4)
def _mapped(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def _probe(name: str, lengths: list[int], labels: int, verdicts: list[str], otherwise: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _mapped(name)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            # hosts first: only suffixes that have a rule are tried with their path prefixes
            suffixes, owner = [], []
            for i, host in enumerate(hosts):
                parts = host.split(".")
                for k in range(max(0, len(parts) - labels), len(parts)):
                    suffixes.append(".".join(parts[k:]))
                    owner.append(i)
            tried = []
            for j in np.flatnonzero(index.find([_key(s, -1, "") for s in suffixes]) >= 0):
                path = paths[owner[j]]
                tried += [(owner[j], suffixes[j], path[:n]) for n in lengths if n <= len(path)]
            found = index.find([_key(host, len(path), path) for _, host, path in tried])
            best: dict[int, tuple] = {}
            for j in np.flatnonzero(found >= 0):
                i, host, path = tried[j]
                best[i] = max(best.get(i, (-1,)), (len(host) + len(path), len(host), host + path, verdicts[found[j]]))
            rule = [best[i][2] if i in best else None for i in range(len(hosts))]
            verdict = [best[i][3] if i in best else otherwise for i in range(len(hosts))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return run


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
    max_bytes: int = 256 << 20,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    ``rules`` are (``host/path``, verdict). A rule fits its host and all subdomains when the url's path starts
    with the rule's path; the longest rule wins, of equally long ones that with the longer host. A url
    without a rule gets ``otherwise``: the digest array does not hold any part of it. Of a rule given
    twice the last verdict holds.

    The rules become one file of sorted 64-bit xxhash keys and full strings in the shared folder. Spark hands it
    to each executor once, also to one that joins later, and all workers there map the same copy. A url is
    looked up by its host's suffixes and, for each that has a rule, by its path prefixes of the
    lengths that occur among the rules. The file may have ``max_bytes``; a larger set is refused, since every executor
    holds it whole.

    NULL urls and urls without ``://`` have an empty host and path, and match no rule unless one has an empty
    host. Repeated rows give repeated results, a NULL id stays NULL, other columns are not read. An empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    ready(spark)
    split = [(*r.partition("/"), v) for r, v in rules]
    table = {(host, slash + path): v for host, slash, path, v in split}
    verdicts = sorted(set(table.values()))
    entries = {_key(host, -1, ""): 0 for host, _ in table}
    entries |= {_key(host, len(path), path): verdicts.index(v) for (host, path), v in table.items()}
    data = DigestArray.packed(entries)
    if len(data) > max_bytes:
        raise ValueError(f"the rules take {len(data)} bytes, more than max_bytes = {max_bytes}")
    folder = scratch_path(spark, "rules")
    name = f"rules-{uuid.uuid4().hex}.bin"
    fs, target = hadoop_path(spark, f"{folder}/{name}")
    stream = fs.create(target)
    stream.write(bytearray(data))
    stream.close()
    spark.sparkContext.addFile(fs.makeQualified(target).toString())

    url = F.col(url_col).cast("string")
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    labels = max((host.count(".") + 1 for host, _ in table), default=1)
    lengths = sorted({len(path) for _, path in table})
    return read.mapInArrow(
        _probe(name, lengths, labels, verdicts, otherwise), "page_id long, host string, path string, rule string, verdict string"
    )
