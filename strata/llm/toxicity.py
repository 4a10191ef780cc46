"""Toxicity by subword embeddings averaged into a linear softmax.

A word is the bag of its character n-grams, a text the average of its words, and the label a softmax over that average;
embeddings and softmax are learned together. An unseen misspelling shares most n-grams with the word it came from, and
with them its vector.

Learning uses a bounded sample of labelled rows: Spark turns their texts into n-gram weights, numpy fits them on the
driver. Scoring needs one number per n-gram bucket, because the softmax of two classes only sees the projection of the
average on one direction, and the average of projections is the projection of the average.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import append_columns, arrow_map, positional, stored
from strata.llm.vocab import WordCache

#: At most about this many labelled rows are learned from (see `sample`), the size of the hashed n-gram table, and the
#: length of its vectors. The driver holds the buckets that the texts of the sample have, and as many shares.
SAMPLE, BUCKETS, DIM = 8192, 1 << 14, 8
NGRAMS = (3, 6)
EPOCHS, BATCHES, RATE, DECAY, SEED = 30, 16, 0.01, 3e-4, 7
THRESHOLD = 0.3

WORD = re.compile(r"[^\W\d_]+")


def subwords(word: str, buckets: int = BUCKETS) -> list[int]:
    """Buckets of a word's n-grams, its borders included."""
    marked, crc32 = f"<{word}>", zlib.crc32
    spans = [(i, i + n) for n in range(NGRAMS[0], NGRAMS[1] + 1) for i in range(len(marked) - n + 1)]
    if marked.isascii():
        plain = marked.encode()
        return [crc32(plain[a:b]) % buckets for a, b in spans]
    return [crc32(marked[a:b].encode()) % buckets for a, b in spans]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def weights(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """What each bucket adds to a text's average: its share in each word, averaged over the words."""
    counts = Counter(words(text))
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    total = sum(counts.values())
    rows = [(subwords(w, buckets), n) for w, n in counts.items()]
    index = np.fromiter((g for grams, _ in rows for g in grams), np.int64)
    share = np.repeat([n / total / len(g) for g, n in rows], [len(g) for g, _ in rows])
    found, place = np.unique(index, return_inverse=True)
    return found.astype(np.int32), np.bincount(place, share, len(found)).astype(np.float32)


@dataclass
class Model:
    """Embeddings (bucket, dim), softmax weights (dim, 2) and its offsets."""

    embeddings: np.ndarray
    softmax: np.ndarray
    offsets: np.ndarray
    toward: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.toward = (self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float64)

    def scorer(self):
        """The function from texts to scores. Words are scored once per task."""
        toward, offset, n = self.toward, float(self.offsets[1] - self.offsets[0]), len(self.toward)

        pull = toward.tolist()

        def of_word(word: str) -> float:
            grams = subwords(word, n)
            return sum(map(pull.__getitem__, grams)) / len(grams)

        def of_token(token: str) -> complex:
            found = words(token)
            return complex(sum(map(by_word.__getitem__, found)), len(found))

        by_word, tokens = WordCache(of_word), WordCache(of_token)

        def score(text: str) -> float:
            # Sum of word scores and number of words, carried together.
            total = sum(map(tokens.__getitem__, text.split()), 0j)
            logit = (total.real / total.imag if total.imag else 0.0) + offset
            return 1.0 / (1.0 + float(np.exp(min(50.0, max(-50.0, -logit)))))

        return score


@dataclass
class Features:
    """Rows of n-gram shares, one after the other: row k has the entries from ``starts[k]`` to ``starts[k + 1]``."""

    starts: np.ndarray
    places: np.ndarray
    shares: np.ndarray
    buckets: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, rows: Iterator[tuple[np.ndarray, np.ndarray]], buckets: int) -> Features:
        places, shares, starts = bytearray(), bytearray(), [0]
        small = np.uint16 if buckets <= 1 << 16 else np.int32
        for found, weight in rows:
            places += found.astype(small).tobytes()
            shares += weight.astype(np.float16).tobytes()
            starts.append(starts[-1] + len(found))
        return cls(np.asarray(starts), np.frombuffer(places, small), np.frombuffer(shares, np.float16), buckets)

    def squares(self) -> np.ndarray:
        """Sums of squares per bucket."""
        out = np.zeros(self.buckets)
        for i in range(0, len(self.places), 1 << 18):
            out += np.bincount(self.places[i : i + (1 << 18)], self.shares[i : i + (1 << 18)].astype(np.float64) ** 2, self.buckets)
        return out

    def dense(self, chosen: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Some rows in full, scaled."""
        out = np.zeros((len(chosen), self.buckets), np.float32)
        for row, k in zip(out, chosen.tolist(), strict=True):
            entries = slice(self.starts[k], self.starts[k + 1])
            row[self.places[entries]] = self.shares[entries] * scale[self.places[entries]]
        return out


def fit(features: Features, labels: np.ndarray, dim: int = DIM, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Learn embeddings and softmax together by Adam. Columns are scaled by their size while learning.

    Without rows of both labels every text gets the share of label 1 (0 without any row).
    """
    n, buckets = len(features), features.buckets
    share = float(labels.mean()) if n else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros((buckets, dim)), np.zeros((dim, 2)), np.array([0.0, 50.0 if share else -50.0]))
    scale = (0.1 / (np.sqrt(features.squares() / n) + 1e-5)).astype(np.float32)
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.01, (buckets, dim)).astype(np.float32), rng.normal(0, 0.5, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)]
    mean, spread = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(n), min(n, BATCHES)):
            step += 1
            embeddings, softmax, offsets = parts
            rows = features.dense(chosen, scale)
            average = rows @ embeddings
            logits = average @ softmax + offsets
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            p /= len(chosen)
            slopes = [rows.T @ (p @ softmax.T) + DECAY * embeddings, average.T @ p + DECAY * softmax, p.sum(axis=0)]
            for part, slope, m, v in zip(parts, slopes, mean, spread, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                part -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(parts[0] * scale[:, None], parts[1], parts[2])


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def sample(labels: DataFrame, id_col: str, label_col: str, size: int) -> DataFrame:
    """``id, label`` of about ``size`` labelled rows outside fold 2, picked by a hash of the id; never more than twice
    ``size``. An id with several labels counts as its largest. NULL ids and labels other than 0 and 1 are left out."""
    usable = labels.where((fold(F.col(id_col)) != 2) & F.col(label_col).isin(0, 1))
    usable = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    usable = stored(usable, "labels")
    share = min(1.0, size / max(1, usable.count()))
    return usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * size)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", size: int = SAMPLE, buckets: int = BUCKETS
) -> Model:
    """The model of a bounded sample of labelled rows outside fold 2, of which it sees whole texts and labels alone. Of rows
    with one id and different texts one is learned from, always the same."""
    chosen = sample(labels, id_col, label_col, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weights(t or "", buckets) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary()),
                    pa.array([(w * FEATURE_UNIT).astype(np.float16).tobytes() for _, w in found], pa.binary()),
                ],
                ["id", "label", "buckets", "shares"],
            )

    # `chosen` has at most 2 * size rows of two numbers, so it may be broadcast.
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")
    rows = stored(arrow_map(picked, run, "id bigint, label int, buckets binary, shares binary"), "features")
    # Of rows with one id the same one always stays.
    rows = rows.groupBy("id").agg(F.min(F.struct("buckets", "shares", "label")).alias("row")).select("id", "row.*")
    found: list[int] = []

    def read() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # One partition at a time, so that the driver holds little beside the features.
        for row in rows.orderBy("id").toLocalIterator():
            found.append(row.label)
            yield np.frombuffer(row.buckets, np.int32), np.frombuffer(row.shares, np.float16)

    features = Features.of(read(), buckets)
    model = fit(features, np.array(found, np.int64))
    model.toward *= FEATURE_UNIT
    return model


# Shares are below one thousandth as a rule, where half precision is coarse.
FEATURE_UNIT = 1000.0


def scored(docs: DataFrame, model: Model, text_col: str = "text", column: str = "score") -> DataFrame:
    """Adds ``column``, 0 to 1, higher for label 1. NULL and empty texts get the score of a text without words. All
    rows and columns stay; a column with the name of the new one gives way to it."""

    def make():
        score = model.scorer()
        return lambda texts: (np.fromiter(map(score, texts), np.float64, len(texts)),)

    return append_columns(docs, text_col, make, **{column: "double"})


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, held_out, score, predicted``, one row per row of ``docs``.

    Learns as `train` does. Repeated rows are scored alike. Columns but id and text are not looked at. A NULL id is not
    held out. An empty table gives an empty result.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    rows = scored(docs.select(id_col, text_col), model, text_col).drop(text_col)
    held = F.coalesce(fold(F.col(id_col)) == 2, F.lit(False))
    return rows.select(id_col, held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, with all their columns."""
    model = train(docs, labels, id_col, text_col, label_col)
    rows, (text,) = positional(docs, text_col)
    return scored(rows, model, text, "score").where(F.col("score") < threshold).drop("score").toDF(*docs.columns)
