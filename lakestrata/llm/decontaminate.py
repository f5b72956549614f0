"""Documents that hold passages of a benchmark, found by spaced seeds."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import HashFilter, ready, saved
from .words import WordHashes
from .workers import tidy

# scripts without blanks between words: Thai, Lao, Tibetan, Myanmar, Khmer and others, kana, Han
_UNSPACED = (
    "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\ua9e0-\ua9ff\uaa60-\uaadf"
    "\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035\u3038-\u303c\u3041-\u30ff\u3100-\u312f\u31a0-\u31bf\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua48f\uf900-\ufaff\uff66-\uff9f\U00016fe0-\U00018dff\U0001aff0-\U0001b2ff\U00020000-\U0003ffff"
)


def _marks() -> str:
    """Combining marks, as the inside of a character class: they belong to the letter before them."""
    points = [i for i in range(0x300, 0xE01F0) if (i < 0x20000 or i >= 0xE0100) and unicodedata.category(chr(i))[0] == "M"]
    starts = [i for i, before in zip(points, [-1, *points], strict=False) if i != before + 1]
    ends = [i for i, after in zip(points, [*points[1:], -1], strict=True) if i + 1 != after]
    return "".join(f"{chr(a)}-{chr(z)}" for a, z in zip(starts, ends, strict=True))


_MARK = _marks()
_TOKEN = re.compile(rf"(?:[^\W_{_UNSPACED}{_MARK}]+[{_MARK}]*)+|[^\W_{_MARK}][{_MARK}]*")
# in such texts the letters are known by their bytes: ASCII and Latin letters
_LATIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]*")
_LATIN_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")
_FACTOR = 0x9E3779B97F4A7C15


def tokens(text: str) -> list[bytes]:
    """Runs of letters and digits in lower case, each with its combining marks; in scripts without blanks each letter."""
    text = text.lower()
    if _LATIN.fullmatch(text):
        return _LATIN_TOKEN.findall(text.encode())
    return [t.encode() for t in _TOKEN.findall(text)]


def covering(penalty: int, min_match: int) -> list[str]:
    """Masks (1: the token counts, 0: it may be any token) of which one fits in every stretch that is accepted.

    A best stretch with x substitutions has runs r0 .. rx of equal tokens. No part at its start scores below 0, so
    r0 + .. + r(x-1) >= penalty * x; none scores as much as the whole, so r1 + .. + rx > penalty * x. Both sums
    together are those of the x pairs of adjacent runs, so one pair has 2 * penalty + 1 equal tokens or more, with one
    token between. Without a substitution it is a run of ``min_match``.
    """
    n = min(min_match, 2 * penalty + 1)
    return ["1" * n, *("1" * i + "0" + "1" * (n - i) for i in range(1, n))]


def seeds(hashes: np.ndarray, masks: Iterable[str]) -> list[np.ndarray]:
    """For each mask the hash of the tokens it looks at, at each place it fits: a sum with odd factors.

    The sum over all tokens of a span is made once; a mask takes off what it does not look at.
    """
    masks, factor = list(masks), _FACTOR
    products, sums = [], [np.zeros(len(hashes), np.uint64)]
    for i in range(min(max(map(len, masks)), len(hashes))):
        products.append(hashes[i:] * np.uint64(factor))
        sums.append(sums[-1][: len(products[-1])] + products[-1])
        factor = factor * 0xD1342543DE82EF95 % 2**64
    out = []
    for mask in masks:
        count = len(hashes) - len(mask) + 1
        total = sums[len(mask)] if count > 0 else sums[0][:0]
        for i, c in enumerate(mask):
            if c == "0" and count > 0:
                total = total - products[i][:count]
        out.append(total)
    return out


def _first_row() -> int:
    """Rows are numbered within their task, so those with one id or none are told apart."""
    return TaskContext.get().partitionId() << 40


def _filter_bits(seeds: int) -> int:
    """Bits of the table for so many seeds: eight or more for each (three places in a hundred at most pass by chance), from 2 to 64 MB.

    Beyond 64 million seeds the table stays at 64 MB and lets more places through to the join, which is exact.
    """
    return 1 << min(29, max(24, (8 * seeds - 1).bit_length() if seeds else 0))


def _items(masks: Sequence[str], least: int):
    """``short`` is the length of an item of fewer than ``least`` tokens, which is looked for by all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = WordHashes(), _first_row()
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = words.of(tokens(text or ""))
                short = len(hashes) if len(hashes) < least else None
                for found in seeds(hashes, masks if short is None else ["1" * short]) if len(hashes) else ():
                    out += [(row, item, short, k, i, hashes.tobytes() if not i else None) for i, k in enumerate(found.view(np.int64).tolist())]
                row += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)] if out else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["item_row", "item_id", "short", "seed", "item_at", "item_tokens"])

    return tidy(run)


def _hits(masks: Sequence[str], short: Sequence[int], known: HashFilter):
    looks = dict.fromkeys([*masks, *("1" * n for n in short)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = WordHashes(), _first_row()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = words.of(tokens(text.as_py() or ""))
                found, places = [], []
                for own in seeds(hashes, looks):
                    hit = known.held(own)
                    found.append(own[hit])
                    places.append(hit)
                found = np.concatenate(found)
                if len(found):
                    out.append((row, doc, found.view(np.int64), np.concatenate(places), hashes.tobytes()))
                row += 1
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    ["doc_row", "doc_id", "seeds", "places", "doc_tokens"],
                )

    return tidy(run)


def best_segment(match: np.ndarray, penalty: int) -> tuple[int, int, int]:
    """Start, end and matches of the stretch with most ``matches - penalty * mismatches`` (ties: the first)."""
    score = np.concatenate([[0], np.cumsum(np.where(match, 1, -penalty))])
    gain = score - np.minimum.accumulate(score)
    end = int(np.argmax(gain))
    start = int(np.argmin(score[: end + 1]))
    return start, end, int(match[start:end].sum())


def _overlaps(min_match: int, penalty: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, item, shift, doc_bytes, item_bytes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, test = np.frombuffer(doc_bytes, np.uint64), np.frombuffer(item_bytes, np.uint64)
                low, high = max(0, -shift), min(len(test), len(own) - shift)
                start, end, same = best_segment(test[low:high] == own[low + shift : high + shift], penalty)
                # a short item: whole and word for word; others: the usual 13 tokens, less when the item has less
                need = len(test) if len(test) < min_match else min_match
                if same >= need:
                    out.append((doc, item, low + start + shift, low + start, end - start, same, same / len(test)))
            types = (*[pa.int64()] * 6, pa.float64())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    ["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_same", "coverage"],
                )

    return tidy(run)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: Sequence[str] | None = None,
    min_match: int = 13,
    penalty: int = 3,
) -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n_tokens, n_same, coverage`` of each overlap, best per pair.

    Tokens are runs of letters and digits in lower case, whatever blanks, quotes or dashes are around them; in scripts
    that put no blanks between words (Han, kana, Thai, ...) each letter is a token. Each mask hashes the tokens it looks at, at every
    place of every item and document; equal hashes are joined, and each hit is verified on its diagonal:
    the stretch with most ``matches - penalty * mismatches`` must hold ``min_match`` equal tokens. With the masks
    of ``covering`` (the default) the result is that of comparing all diagonals of all pairs: a run of
    ``min_match`` equal tokens is always found, and so is a passage with every fifth token replaced or fewer, once
    13 tokens are left in the stretch. With every fourth replaced no stretch scores more than three tokens, so only what
    else is equal counts. Items of fewer tokens than ``min_match`` (or than the longest of other ``masks``) are looked
    for by all their tokens: those of fewer than ``min_match`` must occur whole and word for word.

    A bit table of the benchmark's hashes (``_filter_bits``: 2 to 64 MB) goes to all tasks and drops the places
    without a partner; the join by hash that follows is a plain one, so a benchmark of any size gives
    the same rows. Documents without a hit are read once and never shuffled.

    NULL and empty texts on either side match nothing. Every row is compared by itself, so rows that share an id, or
    have none, cost no more than others; of the overlaps of rows with one id the best is reported. Overlaps of a row with NULL id are reported with NULL.
    Other columns are not read. An empty table on either side gives an empty result.
    """
    ready(docs.sparkSession)
    masks = list(masks or covering(penalty, min_match))
    least = max(min_match, *map(len, masks))
    item_rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    tests = saved(
        item_rows.mapInArrow(_items(masks, least), "item_row long, item_id long, short int, seed long, item_at long, item_tokens binary"), "tests"
    )
    # fewer lengths than ``least``
    short = sorted(r.short for r in tests.where("short IS NOT NULL").select("short").distinct().collect())
    known = HashFilter(tests.select("seed"), _filter_bits(tests.count()))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hits = saved(
        read.mapInArrow(_hits(masks, short, known), "doc_row long, doc_id long, seeds array<long>, places array<long>, doc_tokens binary"),
        "hits",
    )
    places = hits.select("doc_row", F.explode(F.arrays_zip("seeds", "places")).alias("z"))
    shifts = (
        places.select("doc_row", F.col("z.seeds").alias("seed"), F.col("z.places").alias("at"))
        .join(tests.select("seed", "item_row", "item_at"), "seed")
        .select("doc_row", "item_row", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    items = tests.where("item_tokens IS NOT NULL").dropDuplicates(["item_row"]).select("item_row", "item_id", "item_tokens")
    pairs = (
        shifts.join(hits.select("doc_row", "doc_id", "doc_tokens"), "doc_row")
        .join(items, "item_row")
        .select("doc_id", "item_id", "shift", "doc_tokens", "item_tokens")
    )
    schema = "doc_id long, item_id long, doc_start long, item_start long, n_tokens long, n_same long, coverage double"
    best = F.max(F.struct("n_same", "coverage", "n_tokens", -F.col("doc_start"), -F.col("item_start"))).alias("b")
    return (
        pairs.mapInArrow(_overlaps(min_match, penalty), schema)
        .groupBy("doc_id", "item_id").agg(best)
        .select(
            "doc_id", "item_id", (-F.col("b.col4")).alias("doc_start"), (-F.col("b.col5")).alias("item_start"),
            F.col("b.n_tokens").alias("n_tokens"), F.col("b.n_same").alias("n_same"), F.col("b.coverage").alias("coverage"),
        )
    )
