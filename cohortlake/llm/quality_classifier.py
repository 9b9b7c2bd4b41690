"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A labelled document has a grade: 0 toxic, 1 poor, 2 good. With a document's hashed features x, shared
weights w and ordered thresholds, P(grade <= k) = sigmoid(threshold_k - w.x). Features are the words that
occur (lower case, without outer signs) and the beginnings of longer words, and how large a share of the
words has a shape (several trailing signs, signs alone, capitals) or repeats the word before.

A word's value is the logarithm of how much more often it occurs below a threshold than above, so that the
many words that tell nothing weigh nothing however long a text is; shares are real values. Words in fewer than
``min_docs`` documents of the sample, and those whose ratio is within chance, get no weight. Of the
penalties the one with the least loss on a fifth of the labels, held out by hash, is taken.

Training uses at most ``max_rows`` labelled documents, those with the smallest hashes of their ids; every
other bound follows from it: the features of the sample are written, and each step of the quasi-Newton
search sums gradients over its partitions. Scoring runs over all documents in one scan, without a shuffle.

Defined cases: null labels, labels of unknown documents and of ids that several rows share are left out of
training; of several labels of a document the lowest grade counts; a null or blank text has no features, and
so the grade the thresholds imply; with no labels at all every document gets null scores and is selected; null
ids and repeated rows are scored like any other row; an empty table gives an empty result; other columns, whatever
their names, pass through in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import released, text_of, written
from cohortlake.llm.tokens import hashes_of, pieces, raw, word_places, words_of

BITS = 22
MAX_ROWS = 20_000
MIN_DOCS = 4
CHANCE = 6.0  # squared standard errors that a ratio must lie from one
PENALTIES = (100.0, 10.0, 1.0)
BEGINNINGS = (5, 7)  # bytes
SHARES = 4
STEEP = 64


def _capitals(column: pa.Array) -> np.ndarray:
    """Words with several capital letters of ASCII and no small one."""
    data, rows = raw(column)
    starts, stops = word_places(data, rows)
    large, small = (np.r_[0, np.cumsum((data >= low) & (data < low + 26))] for low in (0x41, 0x61))
    return (large[stops] - large[starts] > 1) & (small[stops] == small[starts])


def features(column: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and features of whole texts, each pair once in order, of ``used`` features only if given; and the shares of each row."""
    cells, counts, total = [], np.zeros((len(column), SHARES)), np.zeros(len(column))
    for begin, part, _ in pieces(column):
        small = pc.utf8_lower(part)
        w = words_of(small)
        data = raw(small)[0]
        rows, found = [w.row], [w.hash]
        for k in BEGINNINGS:
            some = np.flatnonzero(w.bare > k)
            rows.append(w.row[some])
            found.append(hashes_of(data, w.first[some], w.first[some] + k) ^ np.uint64(k))
        row, feature = np.concatenate(rows).astype(np.uint64) + np.uint64(begin), np.concatenate(found) >> np.uint64(64 - BITS)
        if used is not None:
            row, feature = (x[used[feature]] for x in (row, feature))
        cells.append(np.unique(row << np.uint64(BITS) | feature))
        again = np.r_[False, (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])][: len(w.row)]
        n = len(part)
        for k, is_so in enumerate((w.trailing > 1, w.bare == 0, _capitals(part), again)):
            counts[begin : begin + n, k] += np.bincount(w.row[is_so], minlength=n)
        total[begin : begin + n] += np.bincount(w.row, minlength=n)
    every = np.unique(np.concatenate(cells)) if cells else np.empty(0, np.uint64)
    shares = np.log1p(STEEP * counts / np.maximum(total, 1)[:, None]) / np.log1p(STEEP)
    return (every >> np.uint64(BITS)).astype(np.int64), (every & np.uint64((1 << BITS) - 1)).astype(np.int64), shares


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def partial_loss(scores: np.ndarray, grades: np.ndarray, thresholds: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood, its derivative in each score, and its gradient in the thresholds."""
    edge = np.r_[-40.0, thresholds, 40.0]
    s = np.clip(scores, -30, 30)
    high, low = _sigmoid(edge[grades + 1] - s), _sigmoid(edge[grades] - s)
    p = np.maximum(high - low, 1e-12)
    dh, dl = high * (1 - high) / p, low * (1 - low) / p
    by_edge = np.bincount(grades, dl, len(edge)) - np.bincount(grades + 1, dh, len(edge))
    return float(-np.log(p).sum()), dh - dl, by_edge[1:-1]


def _gradient_batches(at: np.ndarray):
    """held, loss, gradient: sums over a partition's rows, of those held out the loss only. ``at``: two thresholds, then the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, held_loss, weights = 0.0, np.zeros(len(at)), 0.0, at[2:]
        for batch in batches:
            if not batch.num_rows:
                continue
            places, values = batch.column("places"), batch.column("vals").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(places).to_numpy())
            feature = places.flatten().to_numpy()
            held = batch.column("held").to_numpy(zero_copy_only=False)
            grades = batch.column("grade").to_numpy().astype(np.int64)
            scores = np.bincount(row, values * weights[feature], batch.num_rows)
            held_loss += partial_loss(scores[held], grades[held], at[:2])[0]
            more, by_score, by_edge = partial_loss(scores[~held], grades[~held], at[:2])
            slope = np.zeros(batch.num_rows)
            slope[~held] = by_score
            loss += more
            gradient += np.r_[by_edge, np.bincount(feature, values * slope[row], len(weights))]
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([held_loss]), pa.array([gradient.tobytes()], pa.binary())], ["loss", "held_loss", "gradient"])

    return run


def minimise(f, x: np.ndarray, steps: int, memory: int = 8, tolerance: float = 1e-4) -> np.ndarray:
    """Limited-memory quasi-Newton search with backtracking."""
    value, slope = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = -slope, []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            d = d - a * y
            kept.append(a)
        if past:
            d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        else:
            d /= max(1.0, np.linalg.norm(slope))
        for (s, y), a in zip(past, reversed(kept), strict=True):
            d = d + s * (a - (y @ d) / (s @ y))
        step, down = 1.0, slope @ d
        while True:
            there = x + step * d
            new, new_slope = f(there)
            if new <= value + 1e-4 * step * down or step < 1e-4:
                break
            step /= 2
        if step < 1e-4 or value - new < tolerance * abs(value):
            return x if new > value else there
        if (there - x) @ (new_slope - slope) > 1e-10:
            past = [*past[1 - memory :], (there - x, new_slope - slope)]
        x, value, slope = there, new, new_slope
    return x


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade: 0 toxic, 1 poor, 2 good."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.expr("CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 ELSE 1 END")).cast("int").alias("grade"))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, feature, shares = features(batch.column("text"))
        ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(feature.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("grade"), batch.column("held"), lists, pa.array(shares.tolist(), pa.list_(pa.float64()))], ["grade", "held", "features", "shares"])
        released()


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """grade, held, features, shares of the sample: documents that have a label and an id of their own."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n")).where("n = 1").drop("n")
    sample = graded(labels).join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = F.broadcast(sample.withColumnRenamed("doc_id", "label_id"))  # max_rows rows at most
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).join(sample, F.col("doc_id") == F.col("label_id"))
    texts = texts.select("grade", F.expr("pmod(xxhash64(doc_id, 1), 5) = 0").alias("held"), "text")
    return written(texts.mapInArrow(_feature_batches, "grade int, held boolean, features array<int>, shares array<double>"), "labelled-features")


def telling(rows: DataFrame, spread: dict[int, int], min_docs: int, chance: float) -> list[tuple[int, float]]:
    """The features whose ratio at one of the thresholds is beyond chance, with its logarithm's size; bounded by the words of the sample."""
    counts = rows.where("NOT held").select("grade", F.explode("features").alias("feature")).groupBy("feature").agg(*[F.count_if(F.col("grade") <= k).alias(f"to{k}") for k in (0, 1, 2)]).where(F.col("to2") >= min_docs)
    best = None
    for k in (0, 1):
        low, high = F.col(f"to{k}") + 0.5, F.col("to2") - F.col(f"to{k}") + 0.5
        ratio = F.abs(F.log(low / F.lit(spread[k] + 1.0)) - F.log(high / F.lit(spread[2] - spread[k] + 1.0)))
        this = F.struct((ratio * ratio / (1 / low + 1 / high)).alias("by_chance"), ratio.alias("size"))
        best = this if best is None else F.greatest(best, this)
    found = counts.select("feature", best.alias("best")).where(F.col("best.by_chance") >= chance)
    return sorted((r["feature"], r["size"]) for r in found.select("feature", "best.size").collect())


def _valued_batches(used: np.ndarray, sizes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, np.int32)
        place[used] = np.arange(len(used))
        for batch in batches:
            out_places, out_values = [], []
            for feature, shares in zip(batch.column("features"), batch.column("shares").to_pylist(), strict=True):
                at = place[feature.values.to_numpy()] if len(feature) else np.empty(0, np.int32)
                at = at[at >= 0]
                out_places.append(np.r_[at, len(used) + np.arange(SHARES)].astype(np.int32))
                out_values.append(np.r_[sizes[at], SHARES * np.array(shares)])
            yield pa.RecordBatch.from_arrays([batch.column("grade"), batch.column("held"), pa.array(out_places, pa.list_(pa.int32())), pa.array(out_values, pa.list_(pa.float64()))], ["grade", "held", "places", "vals"])
            released()

    return run


Model = tuple[np.ndarray, np.ndarray, np.ndarray]  # thresholds; used features; their weights, then those of the shares


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, steps: int = 40, min_docs: int = MIN_DOCS, chance: float = CHANCE, penalties: tuple[float, ...] = PENALTIES, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """None without labels."""
    rows = labelled(docs, labels, max_rows, id_col, text_col)
    seen = rows.where("NOT held").agg(F.count("*").alias("to2"), *[F.count_if(F.col("grade") <= k).alias(f"to{k}") for k in (0, 1)]).first()
    spread = {k: seen[f"to{k}"] for k in (0, 1, 2)}
    if not spread[2]:
        return None
    chosen = telling(rows, spread, min_docs, chance)
    used, sizes = np.array([f for f, _ in chosen], np.int64), np.array([s for _, s in chosen])
    # Few files, since every step reads them: the sample is bounded.
    parts = written(rows.mapInArrow(_valued_batches(used, sizes), "grade int, held boolean, places array<int>, vals array<double>").repartition(8), "labelled-values").cache()
    share = np.clip([(spread[k] + 0.5) / (spread[2] + 1.5) for k in (0, 1)], 0.001, 0.999)
    start = np.sort(np.log(share / (1 - share)))
    held_loss = 0.0

    def loss(at: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
        nonlocal held_loss
        # The gap between the thresholds is kept above zero by its logarithm.
        real = at.copy()
        real[1] = at[0] + np.exp(at[1])
        total, gradient, held_loss = 0.0, np.zeros(len(at)), 0.0
        for r in parts.mapInArrow(_gradient_batches(real), "loss double, held_loss double, gradient binary").collect():  # 8 rows of the weights' size
            total, held_loss, gradient = total + r["loss"], held_loss + r["held_loss"], gradient + np.frombuffer(r["gradient"])
        gradient[0] += gradient[1]
        gradient[1] *= np.exp(at[1])
        gradient[2:] += penalty * at[2:]
        return total + 0.5 * penalty * float(at[2:] @ at[2:]), gradient

    best, least = None, np.inf
    at = np.r_[start[0], np.log(max(start[1] - start[0], 1e-3)), np.zeros(len(used) + SHARES)]
    for penalty in penalties:
        at = minimise(lambda x, p=penalty: loss(x, p), at, steps)
        loss(at, penalty)
        if held_loss >= least and best is not None:
            break
        best, least = at, held_loss
    parts.unpersist()
    weights = best[2:].copy()
    weights[: len(used)] *= sizes
    weights[len(used) :] *= SHARES
    return np.array([best[0], best[0] + np.exp(best[1])]), used, weights


def scored(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """Struct of expected_grade and tail_probability (of the best grade) for a text column."""
    kind = "struct<expected_grade:double,tail_probability:double>"
    if model is None:
        return F.lit(None).cast(kind)
    thresholds, used, weights = model  # as large as the sample's words at most

    @F.arrow_udf(kind)
    def score(texts: pa.Array) -> pa.Array:
        weight = np.zeros(1 << BITS, np.float32)
        weight[used] = weights[: len(used)]
        row, feature, shares = features(texts, weight != 0)
        s = np.bincount(row, weight[feature], len(texts)) + shares @ weights[len(used) :]
        above = _sigmoid(s[:, None] - thresholds)  # P(grade > k)
        released()
        return pa.StructArray.from_arrays([pa.array(above.sum(axis=1)), pa.array(above[:, 1])], ["expected_grade", "tail_probability"])

    return score(text)


def select_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), expected_grade, tail_probability of the selected documents."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **training)
    packed = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("text"))
    with_score = packed.withColumn("score", scored(docs.sparkSession, model, F.col("text"))).select("row", "score.*")
    return with_score.where(F.col("tail_probability").isNull() | (F.col("tail_probability") >= least))
