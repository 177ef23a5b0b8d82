"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

A word's vector is the sum of hashed embeddings of the word and of its first four and five letters. Filters over one, two
and three words are pooled by their maximum over the whole text, and a logistic unit reads the pooled values. The
model is trained in numpy, in one task, on a bounded sample of labelled texts. Thresholds are chosen for each language from the scores
of all labelled texts that are not held out, counted in Spark. A score depends on the text alone; the language only
chooses the threshold of ``flagged``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.common import slices, stored, strings

#: Bounds of the training sample: rows of each label, and characters of a text that may be learned from.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 2000, 4000, 8000
BUCKETS, SIZE, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 8
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.01, 1e-4
CUT = 0.3
#: Toxic texts that a language needs for a threshold of its own; the others share that of all languages together.
LEAST_CALIBRATED = 15
#: Scores are counted in so many steps.
STEPS = 1024
MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_"


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each distinct word, code of each word, words per text)."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    flat = lists.flatten().dictionary_encode()
    words = pc.utf8_trim(flat.dictionary, MARKS)
    parts = [words, pc.utf8_slice_codeunits(words, 0, 4), pc.utf8_slice_codeunits(words, 0, 5)]
    hashed = [pd.util.hash_array(p.to_numpy(zero_copy_only=False).astype(object), hash_key=f"{k:016d}", categorize=False) % BUCKETS for k, p in enumerate(parts)]
    return np.stack(hashed, 1).astype(np.int64), flat.indices.to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


@dataclass
class ToxicModel:
    embed: np.ndarray
    filters: list[np.ndarray]
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    pooled_threshold: float = CUT

    def pooled(self, texts: pa.Array) -> np.ndarray:
        """The maximum of each filter over each text; 0 for texts without words."""
        ids, codes, n = word_ids(texts)
        words = self.embed[ids].sum(1)
        start = np.cumsum(n) - n
        some = np.flatnonzero(n > 0)
        left = np.repeat(np.cumsum(n), n) - np.arange(len(codes))
        result = []
        for w, kernel, b in zip(WIDTHS, self.filters, self.shift):
            z = (words @ kernel[0] + b).astype(np.float32)[codes]
            for k in range(1, w):
                part = (words @ kernel[k]).astype(np.float32)
                z[:-k] += np.where((left > k)[:-k, None], part[codes[k:]], 0)
            got = np.zeros((len(n), FILTERS))
            if len(some):
                got[some] = np.maximum.reduceat(z, start[some])
            result.append(np.maximum(got, 0))
        return np.concatenate(result, 1)

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.pooled(texts) @ self.out + self.bias, -50, 50)))


def train(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, seed: int = 5) -> ToxicModel:
    """Adam on the weighted log loss. Embeddings start from the log odds of their buckets."""
    rng = np.random.default_rng(seed)
    ids, codes, n = word_ids(texts)
    ids, start = ids.astype(np.int32)[codes], np.cumsum(n) - n
    counts = np.zeros((2, BUCKETS))
    for d in np.flatnonzero(n):
        counts[labels[d]][np.unique(ids[start[d]:start[d] + n[d]])] += 1
    odds = np.log((counts[1] + 0.5) / ((labels == 1).sum() + 1)) - np.log((counts[0] + 0.5) / ((labels == 0).sum() + 1))
    odds[counts.sum(0) < 3] = 0
    embed = rng.normal(0, 0.05, (BUCKETS, SIZE))
    embed[:, 0] += odds / 4
    filters = [rng.normal(0, 0.2, (w, SIZE, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0, 0] += 1 / len(f)
    model = ToxicModel(embed, filters, [np.zeros(FILTERS) for _ in WIDTHS], rng.normal(0, 0.2, FILTERS * len(WIDTHS)), -1.0)
    for k in range(len(WIDTHS)):
        model.out[k * FILTERS] = 1.0
    params = [model.embed, *model.filters, *model.shift, model.out]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    offset, steps = np.zeros(3), 0
    for _ in range(EPOCHS):
        order = rng.permutation(np.flatnonzero(n > 0))
        for a in range(0, len(order), BATCH):
            batch = order[a:a + BATCH]
            pools, where = np.zeros((len(batch), len(model.out))), np.zeros((len(batch), len(model.out)), np.int64)
            for i, d in enumerate(batch):
                e = np.concatenate([model.embed[ids[start[d]:start[d] + n[d]]].sum(1), np.zeros((max(WIDTHS) - 1, SIZE))])
                for k, w in enumerate(WIDTHS):
                    z = sum(e[j:j + n[d]] @ model.filters[k][j] for j in range(w)) + model.shift[k]
                    s = slice(k * FILTERS, (k + 1) * FILTERS)
                    where[i, s], pools[i, s] = z.argmax(0), z.max(0)
            act = np.maximum(pools, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ model.out + model.bias, -50, 50)))
            g = weights[batch] * (p - labels[batch]) / weights[batch].sum()
            grads = [np.zeros(0)] + [np.zeros_like(x) for x in (*model.filters, *model.shift)] + [act.T @ g]
            back = g[:, None] * model.out * (pools > 0)
            rows, moves = [], []
            for k, w in enumerate(WIDTHS):
                s = slice(k * FILTERS, (k + 1) * FILTERS)
                grads[1 + len(WIDTHS) + k] = back[:, s].sum(0)
                for j in range(w):
                    at = where[:, s] + j
                    inside = at < n[batch][:, None]
                    word = ids[np.minimum(start[batch][:, None] + at, len(ids) - 1)]
                    scale = back[:, s] * inside
                    grads[1 + k][j] = np.einsum("bf,bfd->df", scale, model.embed[word].sum(2))
                    rows.append(word.reshape(-1))
                    moves.append(np.repeat((scale[:, :, None] * model.filters[k][j].T).reshape(-1, SIZE), 3, axis=0))
            rows, moves = np.concatenate(rows), np.concatenate(moves)
            touched, place = np.unique(rows, return_inverse=True)
            grads[0] = np.zeros((len(touched), SIZE))
            np.add.at(grads[0], place, moves)
            steps += 1
            fix = np.sqrt(1 - 0.999 ** steps) / (1 - 0.9 ** steps)
            for q, (x, gr, m, v) in enumerate(zip(params, grads, first, second)):
                r = touched if q == 0 else slice(None)
                gr = gr + DECAY * x[r]
                m[r] = 0.9 * m[r] + 0.1 * gr
                v[r] = 0.999 * v[r] + 0.001 * gr * gr
                x[r] -= RATE * fix * m[r] / (np.sqrt(v[r]) + 1e-8)
            offset[0] = 0.9 * offset[0] + 0.1 * g.sum()
            offset[1] = 0.999 * offset[1] + 0.001 * g.sum() ** 2
            model.bias -= RATE * fix * offset[0] / (np.sqrt(offset[1]) + 1e-8)
    return model


def best_threshold(score: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None) -> float:
    """The cut with the highest F1, in the middle of the scores between which it may lie.

    ``toxic`` of the ``rows`` (one, where not given) with a score are toxic.
    """
    order = np.argsort(-score, kind="stable")
    s, y = score[order], toxic[order]
    n = np.ones(len(y), np.int64) if rows is None else rows[order]
    f1 = 2 * np.cumsum(y) / (np.cumsum(n) + y.sum())
    last = np.append(s[1:] != s[:-1], True)
    best = int(np.flatnonzero(last)[np.argmax(f1[last])])
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0.0)) / 2)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel | None:
    """Train on a bounded sample of labelled rows that are not held out, in one task; None without both labels. Only the model reaches the driver.

    The sample takes, by hash of the id, SAMPLE_TOXIC and SAMPLE_CLEAN labelled ids and of their texts those of at most
    SAMPLE_CHARS characters. Weights restore the share of each label. The thresholds come from all labelled rows that are
    not held out, see ``calibrate``. Repeated labels of a document count once; any toxic one wins.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .where(~held_out()))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if set(total) != {0, 1}:
        return None
    by_hash = known.orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = by_hash.where("toxic = 1").limit(SAMPLE_TOXIC).union(by_hash.where("toxic = 0").limit(SAMPLE_CLEAN))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), lang.cast("string").alias("lang")).where(F.length("text").between(1, SAMPLE_CHARS))
    rows = (texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("t"))
            .select("doc_id", "toxic", "t.text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        sample = pa.Table.from_batches(held).sort_by("doc_id")
        y = sample.column("toxic").to_numpy().astype(np.int64)
        if 0 < y.sum() < len(y):
            weight = np.where(y == 1, total[1] / (y == 1).sum(), total[0] / (y == 0).sum())
            texts = sample.column("text").cast(pa.large_string()).combine_chunks()
            made = train(texts, y, weight / weight.mean())
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(made))], pa.binary())], names=["model"])

    got = rows.repartition(1).mapInArrow(learn, "model binary").collect()
    if not got:
        return None
    model = ToxicModel(**pickle.loads(got[0]["model"]))
    calibrate(model, docs, known)
    return model


def calibrate(model: ToxicModel, docs: DataFrame, known: DataFrame) -> None:
    """Set the thresholds from every row of ``docs`` with a label in ``known`` (doc_id, toxic), whatever its length.

    The rows are scored in Spark and counted by language, step of the score and label; only counts reach the driver.
    Rows that the model was trained on count like the others, so that each label has its true share. A language with
    fewer than LEAST_CALIBRATED toxic rows, or that no label names, takes the threshold of all rows together.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    plain = docs.where(~held_out()).select("doc_id", lang.cast("string").alias("lang"), "text")
    step = F.least(F.floor(F.col("score") * STEPS), F.lit(STEPS - 1)).cast("int").alias("step")
    counts = stored(scored(plain, model).select("doc_id", "lang", step).join(known, "doc_id")
                    .groupBy("lang", "step").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")), "scores")

    def best(got: pd.DataFrame) -> float:
        return best_threshold((got["step"].to_numpy() + 0.5) / STEPS, got["toxic"].to_numpy(np.int64), got["n"].to_numpy(np.int64))

    pooled = counts.groupBy("step").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).toPandas()
    if pooled["toxic"].sum() > 0:
        model.pooled_threshold = best(pooled)
    enough = counts.groupBy("lang").agg(F.sum("toxic").alias("all")).where(F.col("all") >= LEAST_CALIBRATED).select("lang")
    own = counts.join(enough, "lang").toPandas()
    model.thresholds = {str(name): best(part) for name, part in own.groupby("lang")}


def _judged(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """row (the columns of ``docs``), score, predicted, flagged. The text goes through Python once, as a part of the row."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)
    held = docs.select(F.struct(*docs.columns).alias("row"))
    schema = held.withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "flagged": F.lit(True)}).schema
    names, text, lang = docs.columns, docs.columns.index("text"), docs.columns.index("lang") if "lang" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicModel(**shipped.value) if shipped.value else None

        def rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = batch.column(0).flatten()
                yield pa.RecordBatch.from_arrays([parts[text].cast(pa.string()), *parts], names=["_text", *(f"c{i}" for i in range(len(parts)))])

        for batch in slices(rows(), "_text", 2 << 20):
            score = m.score(strings(batch, "_text")) if m else np.zeros(batch.num_rows)
            of = batch.column(1 + lang).cast(pa.string()).to_pylist() if lang is not None else [None] * batch.num_rows
            cut = np.array([m.thresholds.get(x, m.pooled_threshold) if m else CUT for x in of])
            row = pa.StructArray.from_arrays(batch.columns[1:], names=names)
            yield pa.RecordBatch.from_arrays([row, pa.array(score), pa.array((score >= CUT).astype(np.int32)), pa.array(score >= cut)],
                                             names=["row", "score", "predicted", "flagged"])

    return held.mapInArrow(run, schema)


def scored(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """The documents with score, predicted and flagged. Null and empty texts are scored as having no words.

    ``predicted`` cuts all scores at CUT; ``flagged`` at the language's own threshold, the pooled one where it has none.
    Without a model all scores are 0. Other columns with these names are replaced; rows stay as they are.
    """
    return _judged(docs.drop("score", "predicted", "flagged"), model).select("row.*", "score", "predicted", "flagged")


def unflagged(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """The documents that are not flagged, with their own columns, whatever these are called."""
    return _judged(docs, model).where("not flagged").select("row.*")
