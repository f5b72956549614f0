"""Near-duplicate documents by min-max hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import rows_with, saved
from .words import WordHashes, ascii_words, fold, shingles
from .workers import tidy

ROWS = 8
BANDS = 64
_BLOCK = 512
_GROUP = 65_536
_TILE = 4_096


def _multipliers(count: int) -> np.ndarray:
    """Odd 64-bit numbers: x -> a * x is a permutation of the 64-bit numbers."""
    return np.random.default_rng(20_240_517).integers(0, 2**64, count, np.uint64, endpoint=False) | np.uint64(1)


def extremes(values: np.ndarray, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the set under each permutation."""
    low, high = np.full(len(multipliers), 2**64 - 1, np.uint64), np.zeros(len(multipliers), np.uint64)
    for start in range(0, len(values), _BLOCK):
        permuted = np.multiply.outer(multipliers, values[start : start + _BLOCK])
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    return low, high


def _sketch(size: int, rows: int, bands: int):
    multipliers = _multipliers(rows * bands // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            counts, digests, lows, highs = [], [], [], []
            for text in batch.column(1):
                own = shingles(words.of(ascii_words(text.as_py() or "")), size)
                counts.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                if len(own):
                    low, high = extremes(own, multipliers)
                    lows.append(low)
                    highs.append(high)
            keys = []
            for side, values in enumerate((lows, highs)):
                table = np.array(values, np.uint64).reshape(-1, bands // 2, rows)
                for band in range(bands // 2):
                    keys.append(fold(list(table[:, band, :].T), seed=2 * band + side))
            flat = np.stack(keys, axis=1).ravel().view(np.int64)
            ends = np.cumsum([0] + [bands if n else 0 for n in counts]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["id", "n", "digest", "bands"],
            )

    return tidy(run)


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """``id, n, digest, bands``: shingle count, digest of the whole set, band keys (NULL digest: empty set)."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _sketch(size, rows, bands), "id long, n long, digest binary, bands array<long>"
    )


def _similar(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        last, first = None, None
        for batch in batches:
            keep = []
            for a, one, two in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                one = one.as_py()
                if (a, one) != last:
                    last, first = (a, one), shingles(words.of(ascii_words(one)), size)
                second = shingles(words.of(ascii_words(two.as_py())), size)
                shared = len(np.intersect1d(first, second, assume_unique=True))
                keep.append(100 * shared >= percent * (len(first) + len(second) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return tidy(run)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets reach the similarity; ``texts`` has ``id, text``.

    The text of ``b`` travels to ``a``: many documents may have one leader, whose text is then not
    copied for each of them before the shuffle.
    """
    second = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_similar(size, percent), "a long, b long").distinct()


def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``one`` with each of ``two``, by products of 0/1 matrices."""
    shared = np.intersect1d(np.concatenate(one), np.concatenate(two))
    total = np.zeros((len(one), len(two)))
    for start in range(0, len(shared), _TILE):
        tile = shared[start : start + _TILE]
        sides = []
        for sets in (one, two):
            side = np.zeros((len(sets), len(tile)), np.float32)
            for row, values in zip(side, sets, strict=True):
                row[np.isin(tile, values, assume_unique=True)] = 1
            sides.append(side)
        total += sides[0] @ sides[1].T
    return total


def _linked_groups(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at, first = WordHashes(), None, []

        def sets(rows: list[dict]) -> list[np.ndarray]:
            return [shingles(words.of(ascii_words(r["text"])), size) for r in rows]

        for batch in batches:
            out = []
            for a, b, left, right in zip(*(batch.column(i) for i in range(4)), strict=True):
                a, b, right = a.as_py(), b.as_py(), right.as_py()
                if a != at:
                    at, left = a, left.as_py()
                    first = (left, sets(left))
                left, one = first
                two = one if a == b else sets(right)
                same = _common(one, two)
                sizes = np.add.outer([len(s) for s in one], [len(s) for s in two])
                found = 100 * same >= percent * (sizes - same)
                for i, j in zip(*np.nonzero(found), strict=True):
                    if left[i]["part"] != right[j]["part"]:
                        out.append((left[i]["id"], right[j]["id"]))
            columns = list(zip(*out, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return tidy(run)


def links_across(rest: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Every link ``a, b`` between different parts among documents that share a bucket.

    ``rest`` has ``key, id, n, part, lo`` (bucket, document, set size, part so far, smallest part in the
    bucket). Documents are put into groups of about ``_GROUP`` shingles, large parts into groups of their own,
    small ones with those they met; two groups that share a bucket are then compared as a block of sets, and
    only links leave it. So no pair of documents is ever a row, and no group grows with the data.
    """
    nodes = rest.groupBy("id", "part", "n").agg(F.min("lo").alias("lo"))
    sizes = nodes.groupBy("part").agg(F.count(F.lit(1)).alias("members"))
    label = F.when(F.col("members") >= 128, F.col("part")).otherwise(F.col("lo"))
    named = saved(nodes.join(sizes, "part").select("id", "part", "n", label.alias("label")), "named")
    loads = named.groupBy("label").agg(F.ceil(F.sum("n") / _GROUP).alias("slots"))
    group = F.xxhash64("label", F.pmod(F.xxhash64("id"), F.col("slots")))
    homes = saved(named.join(loads, "label").select("id", "part", group.alias("group")), "homes")
    met = (
        rest.select("key", "id").join(homes, "id")
        .groupBy("key", "group").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    )
    other = met.select("key", F.col("group").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    several = F.least("lo", "lo_b") < F.greatest("hi", "hi_b")
    blocks = met.withColumnRenamed("group", "a").join(other, "key").where((F.col("a") <= F.col("b")) & several)
    row = F.struct("id", "part", "text")
    content = saved(texts.join(homes, "id").groupBy("group").agg(F.collect_list(row).alias("rows")), "groups")
    pairs = blocks.select("a", "b").distinct()
    left = pairs.join(content.select(F.col("group").alias("a"), F.col("rows").alias("left")), "a")
    both = left.join(content.select(F.col("group").alias("b"), F.col("rows").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_linked_groups(size, percent), "a long, b long").distinct()


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents whose sets of ``size``-word shingles have 100 * intersection >= ``percent`` * union are
    linked; a component is named by its smallest id, and that document is kept. Each of
    ``rows * bands / 2`` permutations is evaluated once and gives two signature values, its minimum and
    its maximum; half of the bands are cut from the minima and half from the maxima. With the defaults a
    pair at exactly 0.80 is missed with probability 8e-6, one at 0.85 with 1.4e-9; candidates are then
    confirmed on full sets.

    No bucket is expanded into all its pairs. Equal sets are one node from the start. In each bucket
    every node is first compared with the smallest one, so a bucket of one large group costs one pair per
    node; then only nodes that share a bucket and are still in different components are compared, in blocks.

    NULL and empty texts, and texts of blanks only, have an empty set: linked with nothing and kept.
    A row with NULL id is linked with nothing and kept, its component is NULL. Rows that share an id are
    one document: all of them are in one component and all carry the same ``kept``. Other columns are
    not read. An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = saved(sketches(own, "id", "text", size, rows, bands), "sketch")
    linked = sketch.where("digest IS NOT NULL AND id IS NOT NULL")
    leaders = linked.groupBy("digest").agg(F.min("id").alias("leader"))
    placed = saved(linked.select("id", "digest").distinct().join(leaders, "digest").select("id", "leader"), "placed")

    nodes = linked.join(placed.where("id = leader").select("id").distinct(), "id", "left_semi")
    keys = nodes.select("id", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"), F.count(F.lit(1)).alias("size"))
    members = saved(
        keys.join(shared.where("size > 1").drop("size"), "key")
        .select("key", "id", "n", F.col("first.id").alias("lead"), F.col("first.n").alias("lead_n")),
        "members",
    )
    texts = saved(rows_with(own.where(F.col("text").isNotNull()), "id", members.select("id")), "texts")
    stars = (
        members.where("id <> lead").where(_sizes_fit(F.col("n"), F.col("lead_n"), percent))
        .select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    )
    links = saved(confirmed(stars, texts, size, percent), "links")

    # nodes of one bucket that the first round has left in different components
    found = saved(components(links), "found")
    labelled = members.join(found, F.col("id") == F.col("node"), "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("part")
    )
    open_keys = labelled.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    rest = saved(labelled.join(open_keys.select("key", "lo"), "key"), "rest")
    links = links.unionByName(saved(links_across(rest, texts, size, percent), "links"))

    # rows that share an id but not the text
    split = placed.groupBy("id").agg(F.min("leader").alias("a"), F.max("leader").alias("z")).where("a <> z")
    same_id = placed.join(split.select("id", "a"), "id").select("a", F.col("leader").alias("b"))
    final = saved(components(links.unionByName(same_id)), "components")

    owner = placed.groupBy("id").agg(F.min("leader").alias("leader"))
    named = owner.join(final, F.col("leader") == F.col("node"), "left").select(
        F.col("id").alias("owner"), F.coalesce("component", "leader").alias("component_id")
    )
    return (
        sketch.select("id", "n").join(named, F.col("id") == F.col("owner"), "left")
        .select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
