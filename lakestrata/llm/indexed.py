"""Token ids as raw binary shards with a minimal perfect hash index from document keys to their places."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import ready, saved
from .tokens import ByteIds, table
from .words import mixed
from .workers import tidy

_WORD = np.dtype("<u8")


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, local or any that Arrow knows by its URI."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


class PerfectHash:
    """Numbers 0 .. n-1 for n distinct 64-bit keys, without the keys.

    On each level a key that no other key shares a bit with sets that bit; the others go on to the next level with another
    hash. A key's number is the count of bits set before its own. Some four bits a key; most keys end on the first
    level. A key that was never put gives any number or none, so the caller keeps a fingerprint for each.
    """

    def __init__(self, levels: list[np.ndarray], sizes: list[int]):
        self.levels, self.sizes = levels, sizes
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.words, self.starts = words, np.cumsum([0, *map(len, levels)])

    @staticmethod
    def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, sizes = [], []
        while len(keys):
            size = max(64, -(-len(keys) * 5 // 4 // 64) * 64)
            bit = cls._bit(keys, len(levels), size)
            alone = np.bincount(bit, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[bit]]
        return cls(levels, sizes)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for a key that is surely not among those given."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            bit = self._bit(keys[left], level, size)
            word, mask = self.starts[level] + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64)
            held = (self.words[word] & mask) != 0
            below = np.bitwise_count(self.words[word] & (mask - np.uint64(1)))
            out[left[held]] = (self.ranks[word] + below)[held]
            left = left[~held]
        return out

    def write(self, out: io.BytesIO) -> None:
        out.write(np.array([len(self.sizes), *self.sizes], _WORD).tobytes())
        out.write(self.words.astype(_WORD).tobytes())

    @classmethod
    def read(cls, data: memoryview) -> tuple[PerfectHash, int]:
        n = int(np.frombuffer(data, _WORD, 1)[0])
        sizes, at, levels = np.frombuffer(data, _WORD, n, 8).tolist(), 8 * (n + 1), []
        for size in sizes:
            levels.append(np.frombuffer(data, _WORD, size // 64, at))
            at += size // 8
        return cls(levels, sizes), at


def _as_keys(ids: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(ids, np.int64).view(np.uint64)


def _print_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def _shards(path: str, folder: str, end_id: int, width: int, cached: int):
    """Each task writes its rows, in order, as one shard: raw ids in one file, where each document begins in another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        context = TaskContext.get()
        # an attempt has files of its own; only those of the one that succeeds are named in the table of shards
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}"
        ids, docs, counts, out = None, [], [], None
        for batch in batches:
            if ids is None:
                ids, out = table(ByteIds, path, cached), system.open_output_stream(f"{base}/{name}.ids")
            own = list(ids.of([t or "" for t in batch.column(1).to_pylist()]))
            end = np.array([end_id], np.uint32)
            counts.append(np.array([len(o) + 1 for o in own], np.int64))
            docs += batch.column(0).to_pylist()
            out.write(np.concatenate([p for o in own for p in (o, end)]).astype(f"<u{width}").tobytes())
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        nulls = sum(d is None for d in docs)
        keys = np.array([d or 0 for d in docs], np.int64)
        with system.open_output_stream(f"{base}/{name}.docs") as more:
            more.write(np.array([len(docs), nulls], _WORD).tobytes() + offsets.astype("<i8").tobytes() + keys.astype("<i8").tobytes())
        # rows come ordered by key, those without one first; equal keys are one run
        begin = np.flatnonzero(np.append(True, keys[nulls + 1 :] != keys[nulls:-1])) + nulls if len(keys) > nulls else np.zeros(0, np.int64)
        run_keys, sizes = keys[begin], np.diff(np.append(begin, len(keys)))
        entries = [(name, int(context.partitionId()), int(offsets[-1]), None, 0, nulls)]
        entries += [(name, int(context.partitionId()), 0, k, b, n) for k, b, n in zip(run_keys.tolist(), begin.tolist(), sizes.tolist(), strict=True)]
        for start in range(0, len(entries), 50_000):
            columns = zip(*entries[start : start + 50_000], strict=True)
            types = (pa.string(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "shard", "ids", "key", "doc", "n"])

    return tidy(run, keeps=True)


def _buckets(folder: str):
    """Each group of rows with one bucket number becomes one index file."""

    def write(system: fs.FileSystem, base: str, bucket: int, rows: list[np.ndarray]) -> tuple:
        keys, shard, doc, n = (np.concatenate(c) for c in zip(*rows, strict=True))
        order = np.lexsort((shard, keys))
        keys, shard, doc, n = keys[order], shard[order], doc[order], n[order]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        distinct = _as_keys(keys[begin])
        perfect = PerfectHash.build(distinct)
        number = perfect.numbers(distinct)
        prints, first = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.int64)
        size = np.zeros(len(distinct), np.int64)
        prints[number], first[number], size[number] = _print_of(distinct), begin, np.diff(np.append(begin, len(keys)))
        out = io.BytesIO()
        perfect.write(out)
        out.write(np.array([len(distinct), len(keys)], _WORD).tobytes())
        for column, kind in ((first, "<i8"), (size, "<i8"), (shard, "<i8"), (doc, "<i8"), (n, "<i8"), (prints, "<u4")):
            out.write(column.astype(kind).tobytes())
        context = TaskContext.get()
        name = f"index-{bucket:06d}-{context.taskAttemptId()}"
        with system.open_output_stream(f"{base}/{name}.mph") as file:
            file.write(out.getvalue())
        return bucket, name, len(distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        now, held, done = None, [], []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cuts = np.flatnonzero(np.diff(columns[0])) + 1
            for part in zip(*(np.split(c, cuts) for c in columns), strict=True) if batch.num_rows else ():
                if now is not None and part[0][0] != now:
                    done.append(write(system, base, int(now), held))
                    held = []
                now = part[0][0]
                held.append(part[1:])
        if held:
            done.append(write(system, base, int(now), held))
        if done:
            types = (pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], ["bucket", "file", "keys"])

    return tidy(run)


class _Index:
    """One index file: key to the shards that hold it, and which of their documents."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        self.perfect, at = PerfectHash.read(view)
        self.n, m = (int(x) for x in np.frombuffer(view, _WORD, 2, at))
        at += 16
        parts = []
        for count in (self.n, self.n, m, m, m):
            parts.append(np.frombuffer(view, "<i8", count, at))
            at += 8 * count
        self.first, self.size, self.shard, self.doc, self.count = parts
        self.prints = np.frombuffer(view, "<u4", self.n, at)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each key held: its place in ``ids``, shard, first document and number of documents; a row for each shard."""
        keys = _as_keys(ids)
        number = self.perfect.numbers(keys)
        own = np.flatnonzero(number >= 0)
        own = own[self.prints[number[own]] == _print_of(keys[own])]
        first, size = self.first[number[own]], self.size[number[own]]
        rows = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(own, size), self.shard[rows], self.doc[rows], self.count[rows]


def write_index(
    docs: DataFrame,
    path: str,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    shards: int | None = None,
    cached: int = 1_000_000,
) -> DataFrame:
    """Write all rows as shards and index files below ``folder``; returns ``shard, file, start, ids, nulls``, a row a shard.

    Rows are dealt to ``shards`` shards (None: as many as Spark makes of a shuffle of that size) by ranges of the id, so shards in order hold the documents in ascending order; equal ids are told
    apart by their text's hash and a row number, so an id that very many rows share is spread over shards. A shard is
    ``.ids`` (the ids of its documents and ``end_id`` after each, as 16-bit numbers where the vocabulary allows, else 32-bit,
    little-endian, nothing between) and ``.docs`` (their number, the number without id, places of their first ids, their keys). The
    shards that hold a key are looked up by its hash: ``index-*.mph`` has a minimal perfect hash of its keys, and for each key a 32-bit
    fingerprint and the runs (shard, first document, number). A shard gives one run a key, so no key is large in the index.

    Rows with a NULL id come first and have no key; NULL text is empty; repeated rows stay. Other columns are not read. An
    empty table gives no shard. Files of attempts that did not finish lie beside the others and are named nowhere.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ready(spark)
    system, base = _files(folder)
    system.create_dir(base, recursive=True)
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()
    width = 2 if max(max(vocabulary), end_id) < 1 << 16 else 4
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = read.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "hash", "row"]
    dealt = keyed.repartitionByRange(*([shards] if shards else []), *order).sortWithinPartitions(*order).select("doc_id", "text")
    entries = saved(dealt.mapInArrow(_shards(path, folder, end_id, width, cached), "file string, shard long, ids long, key long, doc long, n long"), "entries")
    found, start = [], 0
    for r in entries.where("key IS NULL").orderBy("shard").collect():
        found.append((r.shard, f"{base}/{r.file}", start, r.ids, r.n, width))
        start += r.ids
    schema = "shard long, file string, start long, ids long, nulls long, width int"
    shard_table = saved(spark.createDataFrame(found, schema), "shards")
    buckets = max(1, len(found))
    keys = entries.where("key IS NOT NULL").select(_bucket(F.col("key"), buckets), "key", "shard", "doc", "n")
    index = saved(
        keys.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_buckets(folder), "bucket long, file string, keys long"), "index"
    )
    index.write.mode("overwrite").parquet(f"{folder}/index")
    shard_table.write.mode("overwrite").parquet(f"{folder}/shards")
    return shard_table


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")


def _looked_up(folder: str, files: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        now, index = None, None
        for batch in batches:
            bucket, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for part in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(bucket)) + 1) if len(ids) else ():
                if bucket[part[0]] != now:
                    now = bucket[part[0]]
                    index = None
                    if int(now) in files:
                        with system.open_input_stream(f"{base}/{files[int(now)]}.mph") as file:
                            index = _Index(file.read())
                if index is not None:
                    own, shard, doc, n = index.find(ids[part])
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (ids[part][own], shard, doc, n)], ["key", "shard", "doc", "n"])

    return tidy(run)


def _fetched(shards: dict[int, tuple], chunk: int, whole: bool):
    """Documents of the places asked for, read from the raw files in pieces of some MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, raw = None, None
        for batch in batches:
            key, shard, doc, n = batch.columns
            for k, s, d, count in zip(key.to_pylist(), *(c.to_pylist() for c in (shard, doc, n)), strict=True):
                if s != now:
                    if raw is not None:
                        raw.close()
                    now, (file, start, width) = s, shards[s]
                    system, base = _files(file)
                    with system.open_input_stream(f"{base}.docs") as docs:
                        head = docs.read()
                    m, _ = np.frombuffer(head, _WORD, 2)
                    offsets = np.frombuffer(head, "<i8", int(m) + 1, 16)
                    keys = np.frombuffer(head, "<i8", int(m), 16 + 8 * (int(m) + 1))
                    raw, window, held = system.open_input_file(f"{base}.ids"), 0, b""
                out = []
                for i in range(d, d + count):
                    # the fingerprint may err once in 2**32: the key itself is in the shard
                    if k is not None and keys[i] != k:
                        continue
                    a, b = int(offsets[i]) * width, int(offsets[i + 1]) * width
                    if not window <= a <= b <= window + len(held):
                        window, held = a, raw.read_at(max(b - a, min(chunk, int(offsets[-1]) * width - a)), a)
                    own = np.frombuffer(held, f"<u{width}", (b - a) // width, a - window).astype("<u4").tobytes()
                    out.append((k, start + int(offsets[i]), len(own) // 4, zlib.crc32(own), own if whole else None))
                    if len(out) >= 1000 or (whole and sum(len(o[4]) for o in out[-1:]) > chunk):
                        yield _documents(out)
                        out = []
                if out:
                    yield _documents(out)
        if raw is not None:
            raw.close()

    return tidy(_grouped(run))


def _grouped(run):
    """Small batches as larger ones."""

    def whole(batches):
        held, rows, size = [], 0, 0
        for batch in run(batches):
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= 5000 or size > 8 << 20:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows, size = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return whole


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    types = (*[pa.int64()] * 4, pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    )


def fetch(spark: SparkSession, folder: str, keys: DataFrame | None, *, nulls: bool = False, whole: bool = False, chunk: int = 4 << 20) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of the documents with the given keys (first column), from the files alone.

    A key goes to the index file of its hash, the perfect hash gives its number there in constant time, the fingerprint confirms
    it, and its documents are read from the raw ids at the places found. ``start`` counts the ids of all documents before it;
    ``ids`` are little-endian 32-bit numbers (NULL unless ``whole``); the digest is that of those bytes. A key given twice is
    fetched once, one that is not held gives no row, one that n documents share gives n rows. Documents without a
    key are read with ``nulls``. The driver and the tasks hold the names of the files: two a shard.
    """
    ready(spark)
    shard_rows = spark.read.parquet(f"{folder}/shards").collect()
    files = {r.bucket: r.file for r in spark.read.parquet(f"{folder}/index").collect()}
    shards = {r.shard: (r.file, r.start, r.width) for r in shard_rows}
    places, schema = None, "key long, shard long, doc long, n long"
    if keys is not None:
        asked = keys.select(F.col(keys.columns[0]).cast("long").alias("key")).where("key IS NOT NULL").distinct()
        dealt = asked.select(_bucket(F.col("key"), max(1, len(shards))), "key").repartition(F.col("bucket")).sortWithinPartitions("bucket")
        places = dealt.mapInArrow(_looked_up(folder, files), schema)
    if nulls:
        none = spark.createDataFrame([(None, r.shard, 0, r.nulls) for r in shard_rows if r.nulls], schema)
        places = none if places is None else places.unionByName(none)
    if places is None:
        places = spark.createDataFrame([], schema)
    # a row of places is small and its documents are not: one task a shard, whatever the bytes of the places
    dealt = saved(places, "places").repartition(max(1, len(shards)), "shard").sortWithinPartitions("shard", "doc")
    return dealt.mapInArrow(_fetched(shards, chunk, whole), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
