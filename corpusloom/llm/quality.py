"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = 1 / (1 + exp(score - threshold_k)) with ordered thresholds and one score, a sum of
shared weights of hashed features: which words, runs of punctuation and traits (capitals, share of
punctuation, repetition, length) a text has. Fitted on ``TRAIN_ROWS`` rated documents at most, the
ones whose ids hash lowest; every document is scored over its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.wordhash import U64, byte_table, fmix, hash_words, slices, text_buffers

SLOTS = 1 << 18
TRAIN_ROWS = 12_000
#: Features in fewer training texts have no weight.
MIN_TEXTS = 8
#: Others too, of which the share of low grades is within so many standard errors of the usual one.
LEAST_Z = 5.0
GRADES = 3
_TRAITS = 64


def _punctuation() -> np.ndarray:
    table = fmix(np.arange(1000, 1256, dtype=U64) * U64(0xD6E8FEB86659FD93))
    table[[b for b in range(256) if not (32 < b < 127 and not chr(b).isalnum())]] = 0
    return table


def features(column: pa.Array):
    """Distinct feature slots of each text, in order; the last ``_TRAITS`` slots are traits."""
    data, offsets = text_buffers(column)
    upper = np.zeros(256, np.int64)
    upper[65:91] = 1
    for i, j in slices(offsets):
        part = offsets[i : j + 1]
        words, _, first = hash_words(data, part, byte_table("alnum"))
        marks, _, first_mark = hash_words(data, part, _punctuation())
        caps = np.concatenate([[0], np.cumsum(upper[data[part[0] : part[-1]]])])
        for k in range(j - i):
            mine, signs = words[first[k] : first[k + 1]], marks[first_mark[k] : first_mark[k + 1]]
            size = max(1, int(part[k + 1] - part[k]))
            kinds, times = np.unique(mine, return_counts=True)
            slots = np.unique(np.concatenate([kinds, np.unique(signs)]) & U64(SLOTS - 1)).astype(np.int64)
            slots = slots[slots < SLOTS - _TRAITS]
            capitals = int(caps[part[k + 1] - part[0]] - caps[part[k] - part[0]])
            traits = [
                min(9, int(20 * capitals / size)),
                10 + min(9, int(10 * len(signs) / max(1, len(mine)))),
                20 + min(9, int(10 * (1 - len(kinds) / max(1, len(mine))))),
                30 + min(11, len(mine).bit_length()),
                42 + min(9, int(40 * (times.max() if len(times) else 0) / max(1, len(mine)))),
                52 + min(9, int(len(mine) and (size - len(signs)) / len(mine) / 2)),
            ]
            yield np.concatenate([slots, SLOTS - _TRAITS + np.array(traits)])


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, steps: int = 200, l2: float = 5e-5, rate: float = 0.1) -> OrdinalModel:
    """Maximum likelihood by Adam over all rows; classes count alike. Without rows every grade is
    as likely; a grade that no row has only moves its threshold."""
    weights, raw = np.zeros(SLOTS), np.zeros(n_grades - 1)
    raw[0] = -1.0
    if not len(rows):
        return OrdinalModel(weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))
    flat, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    seen = np.bincount(flat, minlength=SLOTS)
    holder = grades[np.repeat(np.arange(len(rows)), sizes)]
    telling = np.zeros(SLOTS, bool)
    for cut in range(n_grades - 1):
        below, share = np.bincount(flat, holder <= cut, minlength=SLOTS), (grades <= cut).mean()
        telling |= np.abs(below - seen * share) > LEAST_Z * np.sqrt(seen * share * (1 - share) + 1e-12)
    used = np.flatnonzero(telling & (seen >= min(MIN_TEXTS, max(2, len(rows) // 40))))
    place = np.full(SLOTS, len(used))
    place[used] = np.arange(len(used))
    flat = place[flat]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(rows)), sizes)
    keep = flat < len(used)
    flat, owner = flat[keep], owner[keep]
    share = np.bincount(grades, minlength=n_grades).astype(float)
    weight = (1 / np.maximum(share, 1) / (share > 0).sum())[grades]
    w = np.zeros(len(used))
    state = [np.zeros(len(used) + n_grades - 1) for _ in range(2)]
    del starts
    for step in range(1, steps + 1):
        cuts = np.concatenate([[-np.inf], np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])), [np.inf]])
        score = np.bincount(owner, w[flat], minlength=len(rows))
        high = 1 / (1 + np.exp(-np.clip(cuts[grades + 1] - score, -40, 40)))
        low = 1 / (1 + np.exp(-np.clip(cuts[grades] - score, -40, 40)))
        inside = np.maximum(high - low, 1e-9)
        slope_high, slope_low = high * (1 - high) / inside, low * (1 - low) / inside
        on_score = weight * (slope_high - slope_low)
        on_cut = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            on_cut[k] = (weight * (slope_low * (grades == k + 1) - slope_high * (grades == k))).sum()
        tail = np.cumsum(on_cut[::-1])[::-1]
        on_raw = np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])
        grad = np.concatenate([np.bincount(flat, on_score[owner], minlength=len(used)) + l2 * w, on_raw])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad * grad
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        w -= move[: len(used)]
        raw -= move[len(used) :]
    weights[used] = w
    return OrdinalModel(weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 low quality, 2 good; rows with a null are left out, and of
    several ratings of a document the lowest counts."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("doc_id is not null and grade is not null")
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, grades: DataFrame, n_grades: int = GRADES, most: int = TRAIN_ROWS, seed: int = 0) -> OrdinalModel:
    """Fits on at most ``most`` rated documents, in one task; their number bounds what is broadcast
    and what that task holds. Only the weights come to the driver."""
    sample = grades.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")

    def run(batches):
        for batch in batches:
            rows = [f.astype(np.int32) for f in features(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "grade", "slots"])

    def fit(batches):
        if not (batches := [b for b in batches if b.num_rows]):
            return
        table = pa.Table.from_batches(batches)
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        slots = table.column("slots").combine_chunks()
        model = fit_ordinal([slots[int(k)].values.to_numpy() for k in order], table.column("grade").to_numpy()[order].astype(np.int64), n_grades)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in (model.weights, model.thresholds)], ["weights", "thresholds"])

    rows = texts.select("doc_id", "text", F.col("grade").cast("int")).mapInArrow(run, "doc_id long, grade int, slots array<int>")
    found = rows.repartition(1).mapInArrow(fit, "weights binary, thresholds binary").first()
    return OrdinalModel(*(np.frombuffer(bytes(x)) for x in found)) if found else fit_ordinal([], np.empty(0, np.int64), n_grades)


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` (0 to the highest grade) and ``tail_probability`` (of the
    highest grade). A null text is scored as empty and stays null; columns of ``docs`` with these
    names are replaced."""
    out = [c for c in docs.columns if c not in ("expected_grade", "tail_probability")]
    at = out.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        held = shared.value
        for batch in batches:
            scores = np.array([held.weights[f].sum() for f in features(batch.column(at))])
            tails = held.tails(scores) if len(scores) else np.empty((0, len(held.thresholds)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(1)), pa.array(tails[:, -1])], [*out, "expected_grade", "tail_probability"])

    rows = docs.select(*(F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in out))
    schema = StructType(list(rows.schema.fields)).add("expected_grade", "double").add("tail_probability", "double")
    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, least_tail: float = 0.25) -> DataFrame:
    """``score`` by a model trained on ``labels``, and ``keep``: whether the probability of the
    highest grade is ``least_tail`` or more. Without labels nothing is rejected."""
    grades = graded(labels)
    known = grades.limit(1).count()
    scored = score(docs.drop("keep"), train(docs, grades))
    return scored.withColumn("keep", F.col("tail_probability") >= least_tail if known else F.lit(True))
