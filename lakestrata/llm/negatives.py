"""Hard negatives for contrastive training: rows of another label that score close to an anchor's positives."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import ready, saved

_EXACT = 2**53
_PLANES = 4


def rotated(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """The rows turned by a fixed orthogonal map: random signs and a Hadamard transform, twice. Zeros fill up the
    width to a power of two. Needs no matrix, so any width will do."""
    width = 1 << max(3, (max(1, x.shape[1]) - 1).bit_length())
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    rng = np.random.default_rng(seed)
    for _ in range(2):
        out *= rng.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            pairs = out.reshape(len(x), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), width)
            step *= 2
        out /= math.sqrt(width)
    return out


def _bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    packed = np.packbits(signs, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class Codes:
    """One sign bit per rotated component; with the code's unit vector ``c``: ``aligned`` = o . c and the norm of what is left of o."""

    def __init__(self, x: np.ndarray):
        turned = rotated(x)
        self.width = turned.shape[1]
        self.words = _bits(turned >= 0)
        self.aligned = np.abs(turned).sum(axis=1) / math.sqrt(self.width)
        self.square = (x * x).sum(axis=1)
        self.rest = np.sqrt(np.maximum(self.square - self.aligned**2, 0))

    def rows(self, which: np.ndarray) -> Codes:
        out = object.__new__(Codes)
        out.width = self.width
        out.words, out.aligned, out.square, out.rest = (a[which] for a in (self.words, self.aligned, self.square, self.rest))
        return out


class Anchors:
    """Anchors as bit planes: each rotated component is a number of ``_PLANES`` bits on an even scale of its own row."""

    def __init__(self, x: np.ndarray):
        turned = rotated(x)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / (2**_PLANES - 1), 1e-300)
        number = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = np.stack([_bits((number >> t & 1).astype(bool)) for t in range(_PLANES)])
        self.total = number.sum(axis=1)
        self.error = np.linalg.norm(turned - (self.low[:, None] + self.step[:, None] * number), axis=1)
        self.square = (x * x).sum(axis=1)

    def interval(self, some: slice | np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that each (anchor, row) can have.

        o = aligned * c + r with r at right angles to c, so o . q = aligned * (c . q) + r . (q - (c . q) c). c . q is counted by
        AND and popcount on the planes and is off by ``error`` at most; by Cauchy-Schwarz the second
        part is at most |r| * sqrt(|q|^2 - (c . q)^2). Nothing is left to chance; a margin covers floating point.
        """
        ones = np.zeros((len(self.low[some]), len(codes.words)))
        for t in range(_PLANES):
            for w in range(codes.words.shape[1]):
                ones += np.bitwise_count(self.planes[t][some][:, w, None] & codes.words[None, :, w]) * float(1 << t)
        set_bits = np.bitwise_count(codes.words).sum(axis=1, dtype=np.int64)
        dot = self.low[some][:, None] * (2 * set_bits - codes.width)[None, :]
        dot += self.step[some][:, None] * (2 * ones - self.total[some][:, None])
        dot /= math.sqrt(codes.width)
        error, square = self.error[some][:, None], self.square[some][:, None]
        least = np.maximum(np.abs(dot) - error, 0)
        slack = codes.aligned * error + codes.rest * np.sqrt(np.maximum(square - least**2, 0))
        slack += 1e-9 * np.sqrt(square * codes.square) + 1e-6
        dot *= codes.aligned
        return dot - slack, dot + slack


class Firsts:
    """The first ``k`` (score, smaller id first) of each slot, an id once."""

    def __init__(self, slots: int, k: int):
        self.k, self.least = k, np.full(slots, -np.inf)
        self.slot, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((-score, ids, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        new = np.append(True, (slot[1:] != slot[:-1]) | (ids[1:] != ids[:-1]))[: len(slot)]
        slot, score, ids = slot[new], score[new], ids[new]
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        self.slot, self.score, self.ids = (a[place < self.k] for a in (slot, score, ids))
        last = place == self.k - 1
        self.least[slot[last]] = score[last]


class Wave:
    """A bounded number of anchors, as they go to all tasks. ``windows`` (score from, score to) per anchor and positive."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, positives: int):
        self.ids, self.labels, self.x, self.positives = ids, labels, x, positives
        self.coded = Anchors(x)
        self.windows: tuple[np.ndarray, np.ndarray] | None = None


def _scores(x: np.ndarray, matrix: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Exact inner products where ``alive``; minus infinity elsewhere."""
    if alive.mean() > 0.05:
        return np.where(alive, x @ matrix.T, -np.inf)
    out = np.full(alive.shape, -np.inf)
    rows, places = np.nonzero(alive)
    out[rows, places] = np.einsum("ij,ij->i", x[rows], matrix[places])
    return out


def _positives(wave: Wave, firsts: Firsts, ids, labels, matrix, codes, tile: int) -> tuple[int, int]:
    judged = scored = 0
    for label in np.intersect1d(labels, wave.labels):
        rows, anchors = np.flatnonzero(labels == label), np.flatnonzero(wave.labels == label)
        for start in range(0, len(anchors), tile):
            some = anchors[start : start + tile]
            alive = wave.coded.interval(some, codes.rows(rows))[1] >= firsts.least[some][:, None]
            alive &= wave.ids[some][:, None] != ids[rows][None, :]
            judged, scored = judged + alive.size, scored + int(alive.sum())
            score = _scores(wave.x[some], matrix[rows], alive)
            a, b = np.nonzero((score >= firsts.least[some][:, None]) & alive)
            firsts.offer(some[a], score[a, b], ids[rows[b]])
    return judged, scored


def _negatives(wave: Wave, firsts: Firsts, ids, labels, matrix, codes, tile: int) -> tuple[int, int]:
    judged = scored = 0
    low, high = wave.windows
    for start in range(0, len(wave.ids), tile):
        some = np.arange(start, min(start + tile, len(wave.ids)))
        slots = some[:, None] * wave.positives + np.arange(wave.positives)
        least = np.where(low[some] <= high[some], np.maximum(low[some], firsts.least[slots]), np.inf)
        below, above = wave.coded.interval(some, codes)
        alive = (above >= least.min(axis=1)[:, None]) & (below <= high[some].max(axis=1)[:, None])
        alive &= (wave.labels[some][:, None] != labels[None, :]) & (wave.ids[some][:, None] != ids[None, :])
        judged, scored = judged + alive.size, scored + int(alive.sum())
        score = _scores(wave.x[some], matrix, alive)
        found = []
        for j in range(wave.positives):
            a, b = np.nonzero(alive & (score >= least[:, j, None]) & (score <= high[some][:, j, None]))
            found.append((slots[a, j], score[a, b], ids[b]))
        firsts.offer(*(np.concatenate(f) for f in zip(*found, strict=True)))
    return judged, scored


def _scan(shared, step: Callable, slots_each: int, k: int, block: int, tile: int, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave: Wave = shared.value
        width = wave.x.shape[1]
        firsts, judged, scored = Firsts(len(wave.ids) * slots_each, k), 0, 0
        for batch in batches:
            ids, labels, vectors = batch.columns
            for start in range(0, batch.num_rows, block):
                matrix = _padded(vectors.slice(start, block).to_pylist(), width)
                if np.abs(matrix).max(initial=0) * most * max(1, width) >= _EXACT:
                    raise ValueError("inner products of these vectors do not fit 53 bits")
                own = (c.slice(start, block).to_numpy(zero_copy_only=False) for c in (ids, labels))
                more = step(wave, firsts, *own, matrix, Codes(matrix), tile)
                judged, scored = judged + more[0], scored + more[1]
        n = len(firsts.slot)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(firsts.slot, -1)), pa.array(np.append(firsts.ids, judged)), pa.array(np.append(firsts.score, scored).astype(np.int64))],
            ["slot", "vec_id", "score"],
        ) if n or judged else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["slot", "vec_id", "score"])

    return run


def _padded(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _best(parts: DataFrame, k: int) -> DataFrame:
    once = parts.where("slot >= 0").groupBy("slot", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("slot").orderBy(F.col("score").desc(), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    band: tuple[int, int] = (50, 95),
    block: int = 256,
    tile: int = 512,
    wave_bytes: int = 4 << 20,
    tally: dict | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a row's score is its integer inner product with the anchor. An anchor's
    positives are its ``positives`` best other rows of its label; each positive's negatives are the ``negatives`` best
    rows of other labels that score from ``band[0]`` to ``band[1]`` per cent of it (ties: smaller id). Anchors are the rows where
    ``is_anchor`` (on ``vec_id``) holds.

    Each row has a one-bit code of its rotated vector with the stored alignment of the two; popcounts against an anchor's bit
    planes give an estimate and a certain interval of the score (``Anchors.interval``). Pairs whose interval cannot
    reach a place are dropped, all others are scored exactly, so the result is that of comparing all.
    Anchors go to all tasks in waves of about ``wave_bytes`` of vectors; a wave reads the table twice, for the positives and then
    for the negatives; no vector is shuffled, only the tasks' best rows. ``tally`` is given the pairs judged and scored.

    NULL labels and ids, and vectors that are NULL or hold a NULL, NaN or infinite component take no part. Shorter vectors are
    compared as if they ended in zeros. Rows repeating id, label and vector count once; of other rows with one id the best
    counts as candidate, as anchor each is one, and a row with the anchor's id is never its candidate. Windows of a positive below 0
    are empty. Products beyond 53 bits raise an error. Other columns are not read. An empty table gives an empty result.
    """
    spark = df.sparkSession
    ready(spark)
    odd = F.exists(vector_col, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    rows = saved(
        df.where(usable).where(~odd).select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
            F.transform(vector_col, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double")).alias("x"),
        ),
        "rows",
    )
    anchors = saved(rows.where(is_anchor).distinct(), "anchors")
    n = anchors.count()
    width = rows.agg(F.max(F.size("x"))).first()[0]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    waves, parts = math.ceil(n * max(1, width) * 8 / wave_bytes), None
    for number in range(waves):
        own = F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(waves)) == number
        part = _wave(spark, rows, anchors.where(own).orderBy("vec_id", "label", "x").collect(), width, positives, negatives, band, block, tile, tally)
        if part is not None:
            parts = part if parts is None else parts.unionByName(part)
    return spark.createDataFrame([], schema) if parts is None else parts


def _wave(spark: SparkSession, rows, found, width, positives, negatives, band, block, tile, tally) -> DataFrame | None:
    """All rows of the result for the anchors of one wave."""
    if not found:
        return None
    wave = Wave(np.array([r.vec_id for r in found]), np.array([r.label for r in found]), _padded([r.x for r in found], width), positives)
    most, slots = float(np.abs(wave.x).max(initial=0)), "slot long, vec_id long, score long"

    def scan(step: Callable, each: int, k: int) -> DataFrame:
        shared = spark.sparkContext.broadcast(wave)
        parts = saved(rows.mapInArrow(_scan(shared, step, each, k, block, tile, most), slots), "wave")
        if tally is not None:
            judged, scored = parts.where("slot < 0").agg(F.sum("vec_id"), F.sum("score")).first()
            tally.setdefault(step.__name__.strip("_"), []).append((judged or 0, scored or 0))
        return _best(parts, k)

    # at most ``positives`` rows an anchor of the wave
    best = scan(_positives, 1, positives).collect()
    if not best:
        return None
    low, high = np.full((len(found), positives), np.inf), np.full((len(found), positives), -np.inf)
    for r in best:
        low[r.slot, r["rank"] - 1] = -(-band[0] * r.score // 100)
        high[r.slot, r["rank"] - 1] = band[1] * r.score // 100
    wave.windows = (low, high)
    names = [(r.slot * positives + r["rank"] - 1, found[r.slot].vec_id, r.vec_id, r.score) for r in best]
    named = spark.createDataFrame(names, "slot long, anchor_id long, positive_id long, positive_score long")
    return scan(_negatives, positives, negatives).join(named, "slot").select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
