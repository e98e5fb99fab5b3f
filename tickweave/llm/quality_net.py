"""Quality classifier: a convolutional network over the bytes of a whole text.

The UTF-8 bytes are cut into chunks of ``CHUNK`` that overlap by ``OVERLAP``.
Each byte has a learned vector, each filter spans ``WIDTH`` bytes, and the
largest answer of a filter in a chunk is the chunk's feature (max pooling).  The
mean and the maximum of the features over all chunks of the document, and two
functions of its length, go through one logistic layer.  Only numpy is used.

The network is fitted in one task on at most ``SAMPLE`` labelled rows, the ones
with the smallest hash of their id, so the sample is the same for the same table
in any order.  Scoring reads every text from beginning to end, a bounded number
of chunks at a time.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import map_arrow, steps, text_col

CHUNK = 512
OVERLAP = 64
WIDTH = 12
DIMS = 4
FILTERS = 24
#: Labelled rows to fit on at most.
SAMPLE = 4000
#: Steps of the fit, each on BATCH rows; a small sample is gone through more often.
STEPS = 500
BATCH = 64
RATE = 0.01
DECAY = 1e-4
#: Chunks in one matrix product.
STEP_CHUNKS = 64
#: Scores from here on are predicted to be good.
THRESHOLD = 0.7
MODEL = ("bytes", "filters", "bias", "weights", "offset")


def chunks(text: str) -> np.ndarray:
    """The bytes of a text in overlapping rows, the last one filled with zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    step = CHUNK - OVERLAP
    n = max(1, -(-max(0, len(data) - OVERLAP) // step))
    padded = np.zeros((n - 1) * step + CHUNK, np.uint8)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def _pooled(model: dict, rows: np.ndarray, places: bool = False):
    """For each chunk the largest answer of each filter (and where it begins)."""
    top, where = np.empty((len(rows), FILTERS), np.float32), np.empty((len(rows), FILTERS), np.int64)
    for k in range(0, len(rows), STEP_CHUNKS):
        vectors = model["bytes"][rows[k: k + STEP_CHUNKS]].reshape(len(rows[k: k + STEP_CHUNKS]), -1)
        windows = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH * DIMS, axis=1)[:, ::DIMS]
        answer = np.ascontiguousarray(windows).reshape(-1, WIDTH * DIMS) @ model["filters"]
        answer = answer.reshape(len(vectors), -1, FILTERS)
        if places:
            where[k: k + STEP_CHUNKS] = answer.argmax(axis=1)
        top[k: k + STEP_CHUNKS] = answer.max(axis=1)
    return top + model["bias"], where


def _features(model: dict, texts: list[str], places: bool = False):
    parts = [chunks(t) for t in texts]
    rows = np.concatenate(parts)
    top, where = _pooled(model, rows, places)
    active = np.tanh(top)
    begin = np.cumsum([0, *map(len, parts)])[:-1]
    count = np.array([len(p) for p in parts], np.float32)
    mean = np.add.reduceat(active, begin) / count[:, None]
    high = np.maximum.reduceat(active, begin)
    length = np.array([len(t) for t in texts], np.float32)[:, None]
    return np.concatenate([mean, high, np.log1p(length) / 10, 64 / (64 + length)], axis=1), rows, active, where, begin, count


def scores(model: dict, texts: list[str]) -> np.ndarray:
    """The probability that each text is good."""
    if not texts:
        return np.zeros(0)
    x = _features(model, texts)[0]
    return 1 / (1 + np.exp(-(x @ model["weights"] + model["offset"]).astype(np.float64)))


def fit(texts: list[str], labels: np.ndarray, n_steps: int = STEPS, seed: int = 0) -> dict:
    """The network for labelled texts, by Adam on the log loss."""
    rng = np.random.default_rng(seed)
    labels = labels.astype(np.float32)
    model = {"bytes": rng.normal(0, 0.5, (256, DIMS)), "filters": rng.normal(0, 0.3, (WIDTH * DIMS, FILTERS)),
             "bias": np.full(FILTERS, -1.0), "weights": np.zeros(2 * FILTERS + 2), "offset": np.zeros(1)}
    model = {k: v.astype(np.float32) for k, v in model.items()}
    if not len(texts):
        return model
    share = min(0.99, max(0.01, float(labels.mean())))
    model["offset"][0] = np.log(share / (1 - share))
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    order = np.zeros(0, np.int64)
    for step in range(n_steps):
        if not len(order):
            order = rng.permutation(len(texts))
        some, order = order[:BATCH], order[BATCH:]
        x, rows, active, where, begin, count = _features(model, [texts[i] for i in some], True)
        p = 1 / (1 + np.exp(-(x @ model["weights"] + model["offset"])))
        error = (p - labels[some]) / len(some)
        grad = {"weights": x.T @ error, "offset": np.array([error.sum()], np.float32)}
        # Back to the chunks: the mean reaches all of them, the maximum the first chunk that has it.
        doc = np.repeat(np.arange(len(some)), count.astype(int))
        back = (error / count)[doc, None] * model["weights"][:FILTERS]
        highest = active == x[doc, FILTERS: 2 * FILTERS]
        seen = np.cumsum(highest, axis=0)
        before = np.concatenate([np.zeros((1, FILTERS), seen.dtype), seen])[begin]
        back = back + np.where(highest & (seen - before[doc] == 1), error[doc, None] * model["weights"][FILTERS: 2 * FILTERS], 0)
        back = (back * (1 - active ** 2)).astype(np.float32)
        grad["bias"] = back.sum(axis=0)
        hit = rows[np.arange(len(rows))[:, None, None], where[:, :, None] + np.arange(WIDTH)]  # chunk, filter, byte
        vectors = model["bytes"][hit].reshape(len(rows), FILTERS, -1)
        grad["filters"] = np.einsum("cf,cfw->wf", back, vectors)
        toward = back[:, :, None, None] * model["filters"].T.reshape(FILTERS, WIDTH, DIMS)[None]
        grad["bytes"] = np.stack([np.bincount(hit.ravel(), toward[..., d].ravel(), 256) for d in range(DIMS)], axis=1)
        for k, g in grad.items():
            g = g.astype(np.float32) + DECAY * model[k]
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            model[k] -= RATE * (1 - step / n_steps) * (first[k] / (1 - 0.9 ** (step + 1))) / (np.sqrt(second[k] / (1 - 0.999 ** (step + 1))) + 1e-8)
    return model


def dump(model: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def load(data: bytes) -> dict:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in MODEL}


def fit_sample(labelled: DataFrame, sample: int = SAMPLE) -> bytes:
    """Fit on at most ``sample`` rows (``doc_id``, ``text``, ``label``) in one task;
    the stored network.  Rows without a label are left out; without any row the
    network answers one half for all texts."""
    rows = labelled.where("label IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text"), F.col("label").cast("int").alias("label"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample).repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label")))
        held.sort(key=lambda r: (r[0] is None, r[0], r[1], r[2]))
        model = fit([r[1] for r in held], np.array([r[2] for r in held], np.float32))
        yield pa.RecordBatch.from_pydict({"model": [dump(model)]})

    made = map_arrow(chosen, run, "model binary").collect()
    return bytes(made[0]["model"]) if made else dump(fit([], np.zeros(0)))


def score_documents(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row; null and empty texts get a score too."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = load(model)
        for batch, texts in steps(batches, 250_000):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(net, texts), pa.float64())], names=["doc_id", "score"])

    return map_arrow(rows, run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that the labels are never learnt from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of
    ``docs``, learnt from ``labels`` (``doc_id``, ``quality``) outside the held-out
    rows.  Repeated labels of an id count as one row each."""
    known = labels.where(~held_out() & F.col("quality").isNotNull()).select(F.col("doc_id").alias("l_id"), F.col("quality").alias("label"))
    # Which rows: by the ids alone; their texts are joined to at most ``sample`` rows, a table of bounded size.
    chosen = known.orderBy(F.xxhash64("l_id"), "l_id", "label").limit(sample)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "label")
    model = fit_sample(labelled, sample)
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
