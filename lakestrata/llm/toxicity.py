"""Toxicity scores from gradient-boosted trees over dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import sampled, saved
from .workers import tidy

# fixed values: words of address in the languages of the corpus
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves ya u ur du dich dir dein deine deiner deinem deinen ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
# fixed values: characters that stand for letters
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})
_EDGE = ".,;:?\"'()[]{}<>«»„“”…*_-"
_STRETCH = re.compile(r"(.)\1{2,}")
_PREFIX = (4, 5)
FEATURES = (
    "log_words", "word_hits", "word_density", "stem_hits", "stem_density", "weight_sum", "weight_max", "weight_density",
    "hidden_hits", "second_person", "near_second_person", "capitals", "shouted", "exclaimed", "questioned",
    "punctuation", "obfuscated", "stretched", "other_characters", "digits",
)
_NEAR = 5
_PARTS = 16
_MIXED = re.compile(r"\w[^\w\s'’.,:;-]+\w|[^\W\d_]\d+[^\W\d_]|\d[^\W\d_]{2}")


def _plain(token: str) -> str:
    return token.strip(_EDGE).rstrip("!").lower()


def _unhidden(token: str) -> str:
    """The word an obfuscated spelling may stand for: look-alikes, fillers and stretched letters undone."""
    word = re.sub(r"[^\w]|_", "", token.strip(_EDGE).lower().translate(_LEET))
    return _STRETCH.sub(r"\1", word)


def lexicon_keys(token: str) -> list[str]:
    """What a token counts for in the lexicon: itself and its stems."""
    word = _plain(token)
    return [f"w:{word}"] * bool(word) + [f"s:{word[:n]}" for n in _PREFIX if len(word) > n]


class Features(dict):
    """Dense features of whole texts; a token's part in them is worked out once and looked up afterwards."""

    def __init__(self, lexicon: dict[str, float], limit: int = 250_000):
        super().__init__()
        self.lexicon, self.limit = lexicon, limit
        self.rows = np.zeros((1024, _PARTS), np.float32)

    def __missing__(self, token: str) -> int:
        code = self[token] = len(self)
        if code >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[code] = self._parts(token)
        return code

    def _parts(self, token: str) -> tuple:
        word, plain = _plain(token), token.isalpha()
        whole = self.lexicon.get(f"w:{word}")
        stems = [w for n in _PREFIX if len(word) > n and (w := self.lexicon.get(f"s:{word[:n]}"))]
        stretched = bool(_STRETCH.search(token))
        best, hidden = max([whole or 0.0, *stems]), False
        if not best and (stretched or not plain) and (open_word := _unhidden(token)) != word:
            best = self.lexicon.get(f"w:{open_word}", 0.0)
            hidden = best > 0
        upper, letters = 0, len(token)
        if not token.islower():
            upper, letters = sum(map(str.isupper, token)), sum(map(str.isalpha, token))
        elif not plain:
            letters = sum(map(str.isalpha, token))
        odd = (0, 0, 0, False, 0, 0)
        if not plain or not token.isascii():
            odd = (
                token.count("!"), token.count("?"), sum(not c.isalnum() for c in token), bool(_MIXED.search(token)),
                sum(ord(c) > 0x24F for c in token), sum(map(str.isdigit, token)),
            )
        return (
            whole is not None, whole is None and bool(stems), best, hidden, word in SECOND_PERSON, letters, upper,
            letters > 2 and upper == letters, *odd, stretched, len(token),
        )

    def of(self, text: str) -> np.ndarray:
        tokens = text.split()
        if not tokens:
            return np.zeros(len(FEATURES))
        if len(self) > self.limit:
            self.clear()
        codes = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        parts = self.rows[codes]
        total = parts.sum(axis=0, dtype=np.float64)
        (whole, stem, weight, hidden, you, letters, upper, shouted, exclaimed, questioned, marks, mixed, others, digits,
         stretched, size) = total.tolist()
        n, near = len(tokens), 0
        if you and weight:
            at, to = np.flatnonzero(parts[:, 2]), np.flatnonzero(parts[:, 4])
            place = np.searchsorted(to, at)
            before, after = at - to[np.maximum(place - 1, 0)], to[np.minimum(place, len(to) - 1)] - at
            near = int((((before >= 0) & (before <= _NEAR)) | ((after >= 0) & (after <= _NEAR))).sum())
        return np.array([
            math.log1p(n), math.log1p(whole), whole / n, math.log1p(stem), stem / n, math.log1p(weight),
            float(parts[:, 2].max()), weight / n, math.log1p(hidden), you / n, near, upper / max(1.0, letters), shouted / n,
            exclaimed / n, questioned / n, marks / size, mixed / n, stretched / n, others / size, digits / size,
        ])


def _featured(lexicon):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(lexicon.value)
        for texts in batches:
            yield pd.Series([features.of(t or "") for t in texts])

    return F.pandas_udf(tidy(run), "array<double>")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, every = Counter(), Counter()
        for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            keys = {k for t in set((text.as_py() or "").split()) for k in lexicon_keys(t)}
            every.update(keys)
            if label:
                toxic.update(keys)
        rows = [(k, toxic[k], every[k]) for k in toxic]
        # a key of no toxic text cannot enter the lexicon, but its other counts are needed where it is toxic elsewhere
        rows += [(k, 0, n) for k, n in every.items() if k not in toxic]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["key", "toxic", "n"]
        )


def learn_lexicon(labelled: DataFrame, size: int, least: int) -> dict[str, float]:
    """Words and stems with the largest log odds of toxic against other texts.

    ``labelled`` has ``text, label``. A key must occur in at least ``least`` toxic texts and be at least eight
    times as frequent there; at most ``size`` keys come to the driver.
    """
    n, toxic = labelled.agg(F.count(F.lit(1)), F.sum("label")).first()
    counts = labelled.select("text", "label").mapInArrow(tidy(_counted), "key string, toxic long, n long").groupBy("key")
    odds = F.log(((F.col("toxic") + 0.5) / (toxic + 1.0)) / ((F.col("n") - F.col("toxic") + 0.5) / (n - toxic + 1.0)))
    rows = (
        counts.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        .where(F.col("toxic") >= least).withColumn("odds", odds).where(F.col("odds") >= math.log(8))
        .orderBy(F.col("odds").desc(), "key").limit(size).collect()
    )
    return {r.key: r.odds for r in rows}


@dataclass
class Model:
    """What was learned; ``trees`` is None when the labels held fewer than two classes, ``base`` is then the score."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    base: float


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    seen = trees.transform(rows.withColumn("v", array_to_vector("x")))
    return seen.withColumn("raw", vector_to_array("probability")[1]).drop("v", "rawPrediction", "probability", "prediction")


def train(
    labelled: DataFrame,
    *,
    max_rows: int = 30_000,
    lexicon_size: int = 4_000,
    least: int = 4,
    rounds: int = 20,
    depth: int = 4,
) -> Model:
    """Fit on ``id, text, label``; a fifth of the rows is kept for the calibration.

    Of more than ``max_rows`` labelled rows a share is taken by a hash of the id, so the fit costs the same for a
    corpus of any size. Lexicon and trees are fitted on one part, the isotonic steps on the other. With labels
    of fewer than two classes the score is a constant: the smoothed share of toxic rows (0 without rows).
    """
    n = labelled.count()
    picked = labelled.where(sampled(F.xxhash64("id", F.lit("toxicity sample")), max_rows, n))
    rows = saved(picked.withColumn("fold", F.pmod(F.xxhash64("id", F.lit("toxicity fold")), F.lit(5))), "labelled")
    fit, check = rows.where("fold <> 0"), rows.where("fold = 0")
    seen, toxic = fit.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not toxic or toxic == seen:
        return Model({}, None, None, float(toxic / (seen + 1)) if seen else 0.0)
    lexicon = learn_lexicon(fit, lexicon_size, min(least, max(1, toxic // 8)))
    shared = labelled.sparkSession.sparkContext.broadcast(lexicon)
    features = _featured(shared)
    points = saved(
        rows.select(F.col("label").cast("double").alias("label"), "fold", features("text").alias("x")).coalesce(16), "features"
    )
    trees = GBTClassifier(
        featuresCol="v", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.3, minInstancesPerNode=5, checkpointInterval=-1, seed=7
    ).fit(points.where("fold <> 0").select("label", array_to_vector("x").alias("v")))
    scored = saved(_raw(trees, points.where("fold = 0")).select("label", "raw"), "calibration")
    kinds = scored.agg(F.count_distinct("label")).first()[0]
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(scored) if kinds == 2 else None
    return Model(lexicon, trees, steps, 0.0)


def _judged(rows: DataFrame, model: Model, text: Column) -> DataFrame:
    """The rows with ``x`` and ``score`` beside their struct ``row``."""
    shared = rows.sparkSession.sparkContext.broadcast(model.lexicon)
    raw = _raw(model.trees, rows.select("row", _featured(shared)(text).alias("x")))
    out = model.steps.transform(raw) if model.steps else raw.withColumn("score", F.col("raw"))
    return out.select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row; NULL text counts as empty and gets the score of a text without words."""
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if model.trees is None:
        return read.select("id", F.lit(model.base).alias("score"))
    rows = read.select(F.struct("id", "text").alias("row"))
    return _judged(rows, model, F.col("row.text")).select("row.id", "score")


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows that score below ``limit``, with all their columns. A model without trees rejects nothing."""
    if model.trees is None:
        return docs
    rows = docs.select(F.struct("*").alias("row"))
    return _judged(rows, model, F.col("row")[text_col].cast("string")).where(F.col("score") < limit).select("row.*")


def held_out(id_col: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id, text, label`` of the labelled documents that are not held out; labels other than 0 and 1 are left out.

    An id that is labelled twice counts as toxic if any label says so.
    """
    marks = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.where(~held_out(F.col("id"))).join(marks, "id").select("id", "text", "label")


def toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: float = 0.5
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Features: densities of a lexicon of words and stems learned from the labels, its hits near a word of
    address, capitals, punctuation, obfuscated and stretched spellings. Gradient-boosted trees turn
    them into a raw score, isotonic regression on rows the trees have not seen into a probability. Labels are
    learned only from rows that are not held out; scores use the text alone, whole.

    NULL and empty texts get the score of a text without words. Repeated rows give repeated results; a NULL id
    stays NULL and is never held out or used for training. Other columns are not read. Without labels of both
    kinds the score is constant (see ``train``). An empty table gives an empty result.
    """
    model = train(training_rows(docs, labels, id_col, text_col, label_col))
    return score(docs, model, id_col, text_col).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )
