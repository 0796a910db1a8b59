"""Operator 7: quality rules, and a classifier of hashed n-grams.

Rules are counts over the whole text.  The classifier is a logistic regression
over hashed word and byte n-grams (relative frequencies, so that a document's
score is the mean weight of its n-grams), fitted on a bounded sample of labelled
documents, calibrated on a part of the sample that the fit has not seen, and
applied to Arrow batches.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import kernels as K
from quern.store import table


@dataclass(frozen=True)
class QualityConfig:
    sample_rows: int = 3000  # labelled documents to fit and calibrate on, by a hash of their ids
    held_out: int = 4  # one in so many of them calibrates
    bits: int = 15  # of the hash of either kind of n-gram
    word_sizes: tuple[int, ...] = (1, 2)
    byte_sizes: tuple[int, ...] = (2, 3)
    steps: int = 80
    rate: float = 8.0
    penalty: float = 1e-6
    least_good: float = 0.25  # calibrated probability of good quality that is kept: in doubt a document stays
    least_words: int = 10
    repeat_percent: int = 20
    repeat_window: int = 5


_SYMBOL = K.byte_table(b"#*$%&|<>")


def _byte_grams(raw: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Hashed places of the k bytes from each place on (32-bit arithmetic)."""
    x = raw.astype(np.uint32)
    m = max(0, len(x) - k + 1)
    h = x[:m].copy()
    for i in range(1, k):
        h = (h << np.uint32(8)) | x[i : i + m]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int32)


def _grams(raw: np.ndarray, bounds: np.ndarray, h: np.ndarray, first: np.ndarray, config: QualityConfig):
    """For each kind of n-gram: slots, and which of them stay in one document, with document bounds.

    Byte n-grams go across a document's bound into the next; ``keep`` marks those that don't.
    """
    n = 1 << config.bits
    for k in config.word_sizes:
        slots = (K.window_hashes(h, k) >> K.U64(64 - config.bits)).astype(np.int32)
        yield slots, K.window_starts(first, k, len(h)), np.minimum(first, len(slots))
    for k in config.byte_sizes:
        slots = _byte_grams(raw, k, config.bits) + np.int32(n)
        yield slots, K.window_starts(bounds, k, len(raw)), np.minimum(bounds, len(slots))


_FEATURES = "doc_id long, good int, idx binary, val binary"
#: bytes of features that go on together, and entries of features that the fit holds at once
_BATCH_BYTES, _BLOCK = 8 << 20, 1 << 20


def _slot_type(config: QualityConfig) -> type:
    return np.uint16 if config.bits < 16 else np.int32


def _features(config: QualityConfig):
    """Sparse features of labelled documents."""

    def run(batches):
        for batch in batches:
            index, value, size, begin = [], [], 0, 0
            for i, text in enumerate(batch.column(2).cast(pa.binary())):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                bounds = np.array([0, len(raw)])
                starts, ends, first = K.words(raw, bounds, K.NON_SPACE)
                h = K.span_hashes(raw, starts, ends)
                counts = np.zeros(2 << config.bits, np.float32)
                for half in (0, 1):
                    own = [s for i, (s, _, _) in enumerate(_grams(raw, bounds, h, first, config)) if (i >= len(config.word_sizes)) == half]
                    slots = np.concatenate(own)
                    if len(slots):
                        counts += np.bincount(slots, minlength=2 << config.bits).astype(np.float32) / len(slots)
                at = np.flatnonzero(counts)
                index.append(at.astype(_slot_type(config)).tobytes())
                value.append(counts[at].tobytes())
                size += len(index[-1]) + len(value[-1])
                if size >= _BATCH_BYTES or i == batch.num_rows - 1:
                    ids, good = (batch.column(c).slice(begin, len(index)) for c in (0, 1))
                    yield pa.RecordBatch.from_arrays([ids, good, pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["doc_id", "good", "idx", "val"])
                    index, value, size, begin = [], [], 0, i + 1

    return run


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    offset: float
    accuracy: float  # on the part held out
    rows: int

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _calibrate(score: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Platt's scaling: Newton steps on two numbers, targets drawn in a little."""
    up, down = good.sum(), (1 - good).sum()
    aim = np.where(good > 0, (up + 1) / (up + 2), 1 / (down + 2))
    scale = score.std() or 1.0
    x = np.stack([score / scale, np.ones_like(score)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - aim) + 1e-3 * np.array([w[0], 0.0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
    return float(w[0] / scale), float(w[1])


def _row_sums(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums, some = np.zeros(len(sizes)), sizes > 0
    if len(x):
        sums[some] = np.add.reduceat(x, (np.cumsum(sizes) - sizes)[some])
    return sums


class _Spilled:
    """Features of the labelled documents in a file of the task's own, in the order of their identifiers."""

    def __init__(self, batches: Iterator[pa.RecordBatch], file: BinaryIO, config: QualityConfig):
        self.file, self.slot = file, np.dtype(_slot_type(config))
        found, at = [], 0
        for batch in batches:
            for doc_id, good, idx, val in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                idx, val = idx.as_buffer(), val.as_buffer()
                file.write(idx)
                file.write(val)
                found.append((doc_id, good, at, len(val) // 4))
                at += len(idx) + len(val)
        file.flush()
        found.sort()
        self.good = np.array([x[1] for x in found], np.float64)
        self.at, self.n = [x[2] for x in found], [x[3] for x in found]

    def blocks(self, docs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``docs`` in runs of about _BLOCK entries: the run, how many entries each has, and the entries' slots and values."""
        ends = np.cumsum([0] + [self.n[i] for i in docs])
        a = 0
        while a < len(docs):
            b = min(len(docs), max(a + 1, int(np.searchsorted(ends, ends[a] + _BLOCK, side="right")) - 1))
            run, each = docs[a:b], self.slot.itemsize + 4
            raw = [os.pread(self.file.fileno(), self.n[i] * each, self.at[i]) for i in run]
            sizes = [self.n[i] for i in run]
            slots = np.frombuffer(b"".join([r[: n * self.slot.itemsize] for r, n in zip(raw, sizes, strict=True)]), self.slot)
            values = np.frombuffer(b"".join([r[n * self.slot.itemsize :] for r, n in zip(raw, sizes, strict=True)]), np.float32)
            yield run, np.array(sizes), slots.astype(np.int64), values.astype(np.float64)
            a = b

    def margins(self, docs: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.concatenate([_row_sums(values * w[slots], sizes) for _, sizes, slots, values in self.blocks(docs)])


_MODEL = "weights binary, slope double, offset double, accuracy double, rows long"


def _fit(config: QualityConfig):
    """The model, from the features of the whole sample; no row if a class is missing."""

    def run(batches):
        with tempfile.TemporaryFile() as file:
            found = _Spilled(batches, file, config)
            good = found.good
            if len(set(good)) < 2 or len(good) < 20:
                return
            held = np.arange(len(good)) % config.held_out == 0
            fit = np.flatnonzero(~held)
            w, bias, squares = np.zeros(2 << config.bits), 0.0, np.full(2 << config.bits, 1e-8)
            for _ in range(config.steps):
                gradient, errors = np.zeros(len(w)), 0.0
                for docs, sizes, slots, values in found.blocks(fit):
                    error = _sigmoid(_row_sums(values * w[slots], sizes) + bias) - good[docs]
                    gradient += np.bincount(slots, weights=values * np.repeat(error, sizes), minlength=len(w))
                    errors += error.sum()
                gradient = gradient / len(fit) + config.penalty * w
                squares += gradient**2
                w -= config.rate * gradient / np.sqrt(squares)
                bias -= 0.5 * errors / len(fit)
            score = found.margins(np.arange(len(good)), w)
            out = np.flatnonzero(held)
            if len(set(good[out])) < 2:
                out = np.arange(len(good))
            slope, offset = _calibrate(score[out], good[out])
            model = Model(w.astype(np.float32), slope, offset, 0.0, len(good))
            accuracy = float(((model.probability(score[out]) >= config.least_good) == (good[out] > 0)).mean())
            yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "slope": [slope], "offset": [offset], "accuracy": [accuracy], "rows": [len(good)]})

    return run


def train(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> Model | None:
    """Fits on at most ``sample_rows`` labelled documents; None if a class is missing.

    One task fits, with the features (up to 400 KB a document) in a file of its own, a block in memory:
    the driver gets the model alone, however long the documents are.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("good"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.sample_rows)
    chosen = chosen.withColumnRenamed("doc_id", "labelled")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))  # at most sample_rows rows
    rows = rows.groupBy("doc_id").agg(F.min(F.col("good").cast("int")).alias("good"), F.min("text").alias("text"))
    found = rows.mapInArrow(_features(config), _FEATURES).repartition(1).mapInArrow(_fit(config), _MODEL).collect()
    return Model(np.frombuffer(found[0].weights, np.float32), *found[0][1:]) if found else None


_SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, good double"


def _score(shared, config: QualityConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        k = config.repeat_window
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            for _, _, raw, bounds in K.chunks(*K.utf8(batch.column(1))):
                starts, ends, first = K.words(raw, bounds, K.NON_SPACE)
                h = K.span_hashes(raw, starts, ends)
                n_words = np.diff(first)
                chars = K.per_document(K.NON_SPACE[raw] & K.CODE_POINT[raw], bounds)
                symbols = K.per_document(_SYMBOL[raw], bounds)
                repeats = np.zeros(len(n_words), np.int64)
                inside = np.flatnonzero(K.window_starts(first, k, len(h)))
                if len(inside):
                    owner = np.searchsorted(first, inside, side="right") - 1
                    key = K.mix(K.window_hashes(h, k)[inside] ^ K.mix(owner.astype(np.uint64) + K.U64(1)))
                    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
                    again = inside[count[place] > 1]
                    change = np.zeros(len(h) + 1, np.int32)
                    change[: len(h)] += np.bincount(again, minlength=len(h)).astype(np.int32)
                    change += -np.bincount(again + k, minlength=len(h) + 1).astype(np.int32)
                    repeats = K.per_document(np.cumsum(change[:-1]) > 0, first)
                lines = []
                text = raw.tobytes()
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    own = [x for x in text[a:b].split(b"\n") if x.strip()]
                    lines.append(len(own) - len(set(own)))
                good = np.ones(len(n_words))
                if model is not None:
                    score = np.zeros(len(n_words))
                    sums, totals = [np.zeros(len(n_words)) for _ in range(2)], [np.zeros(len(n_words)) for _ in range(2)]
                    for i, (slots, keep, doc) in enumerate(_grams(raw, bounds, h, first, config)):
                        half = int(i >= len(config.word_sizes))
                        run_sum = np.concatenate(([0.0], np.cumsum(np.where(keep, model.weights[slots], 0), dtype=np.float64)))
                        sums[half] += run_sum[doc[1:]] - run_sum[doc[:-1]]
                        totals[half] += K.per_document(keep, doc)
                    for s, t in zip(sums, totals, strict=True):
                        score += s / np.maximum(t, 1)
                    good = model.probability(score)
                for column, x in zip(columns, (n_words, chars, symbols, np.array(lines), repeats, good), strict=True):
                    column.append(x)
            whole = [np.concatenate(x) if x else np.zeros(0) for x in columns]
            arrays = [pa.array(x, pa.int64()) for x in whole[:5]] + [pa.array(whole[5], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "good"])

    return run


def judge(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, good (calibrated probability), base_failed, kept.

    * null or empty text: no words, so base_failed and not kept.
    * labels: null ids and values other than 0 and 1 are ignored; of several for a
      document the worst counts.  Without two classes and 20 labelled documents,
      good is 1 and the rules alone decide.
    * very long texts: rules, fit and scores take the whole text.  Ties: a probability
      equal to ``least_good`` keeps a document, a share equal to ``repeat_percent`` does not fail it.
    * repeated rows and null ids are kept; an empty table gives no rows; further
      columns are ignored.
    """
    model = train(docs, labels, config)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = read.mapInArrow(_score(shared, config), _SCORED)
    failed = (F.col("n_words") < config.least_words) | (100 * F.col("n_repeat_words") > config.repeat_percent * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("good") >= config.least_good))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("good")


def good_documents(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The pipeline's stage: documents that the rules or the classifier reject go.

    Each row is judged by its own whole text, as ``judge`` does; an empty table stays empty.
    """
    model = train(docs, labels, config)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    score = _score(shared, config)
    schema = docs.schema

    def keep(batches):
        for batch in batches:
            text = batch.column(schema.names.index("text"))
            ids = pa.array(np.zeros(batch.num_rows, np.int64))
            for found in score(iter([pa.RecordBatch.from_arrays([ids, text], names=["doc_id", "text"])])):
                n, repeats, good = (found.column(i).to_numpy(zero_copy_only=False) for i in (1, 5, 6))
                ok = (n >= config.least_words) & (100 * repeats <= config.repeat_percent * n) & (good >= config.least_good)
                yield batch.filter(pa.array(ok))

    return docs.mapInArrow(keep, schema)
