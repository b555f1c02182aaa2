"""Language identification by sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Inverse document frequencies are counted over all training texts. The weights are learned by follow-the-regularised-
leader (per-coordinate steps, elastic-net penalty) on a sample of training texts bounded by ``max_train``: in each
round every shard runs the updates from the common state, and the changes of the state (sums of gradients and of their
squares) are averaged over the shards. A temperature, fitted on a part of the sample that the weights never saw, turns
scores into probabilities. Prediction reads whole texts, in blocks of bounded size.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.sources.scratch import materialised

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Code points that are held at once.
BLOCK = 1 << 19
SHARDS = 4
SCALE = 40.0


@dataclass(frozen=True)
class Training:
    """``max_train`` bounds the sampled texts; l1 and l2 are the penalties, alpha and beta set the steps."""

    max_train: int = 8000
    rounds: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    max_languages: int = 500


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(repr=False)
    temperature: float = 1.0


def _grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the n-gram that starts at each code point, for each order; BUCKETS where it would cross a zero."""
    x, total, inside = points.astype(np.uint32), None, None
    for order in ORDERS:
        step = x if order == 1 else np.concatenate([x[order - 1 :], np.zeros(order - 1, np.uint32)])
        total = step * np.uint32(2654435761) if total is None else (total ^ (total >> np.uint32(15))) * np.uint32(2246822519) + step * np.uint32(3266489917)
        inside = step > 0 if inside is None else inside & (step > 0)
        h = (total ^ (total >> np.uint32(13))) * np.uint32(668265263 + 2 * order)
        yield np.where(inside, h >> np.uint32(16), BUCKETS).astype(np.int32)


def _blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number of each piece, code points of the pieces joined with zeros, as (numbers, bounds, points))."""
    pieces: list[str] = []
    numbers: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        text = (text or "").lower().replace("\0", " ")
        for at in range(0, max(len(text), 1), BLOCK):
            # neighbouring pieces share the last n-1 characters, so no n-gram is lost and none counted twice
            pieces.append(text[at : at + BLOCK + max(ORDERS) - 1])
            numbers.append(i)
            size += len(pieces[-1])
            if size >= BLOCK:
                yield _joined(numbers, pieces)
                pieces, numbers, size = [], [], 0
    if pieces:
        yield _joined(numbers, pieces)


def _joined(numbers: list[int], pieces: list[str]):
    points = np.frombuffer("\0".join([*pieces, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    return np.asarray(numbers), np.cumsum(lengths) - lengths, points


def _counts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, buckets, counts) of each text; pieces of one very long text are added up."""
    held: dict[int, np.ndarray] = {}
    for numbers, starts, points in _blocks(texts):
        grams = np.stack(list(_grams(points)), 1)
        for number, a, b in zip(numbers, starts, [*starts[1:], len(points)]):
            vector = np.bincount(grams[a:b].ravel(), minlength=BUCKETS + 1)
            held[number] = held[number] + vector if number in held else vector
        for number in [n for n in held if n != numbers[-1]]:
            vector = held.pop(number)[:BUCKETS]
            at = np.flatnonzero(vector)
            yield number, at, vector[at]
    for number, vector in held.items():
        at = np.flatnonzero(vector[:BUCKETS])
        yield number, at, vector[at]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        texts += batch.num_rows
        seen = np.zeros(BUCKETS + 1, np.int64)
        # a piece that another one follows closes its block, so only the first of a block may continue a text
        open_text, shown = None, np.zeros((len(ORDERS), BUCKETS + 1), bool)
        for numbers, starts, points in _blocks(batch.column(0).to_pylist()):
            ends = [*starts[1:], len(points)]
            which = np.repeat(np.arange(len(numbers)), np.diff([*starts, len(points)]))
            continued = open_text == numbers[0]
            for order, gram in enumerate(_grams(points)):
                if len(numbers) < 64:
                    mask = np.zeros((len(numbers), BUCKETS + 1), bool)
                    mask[which, gram] = True
                    seen += mask.sum(0)
                else:
                    pairs = np.unique(which.astype(np.int64) * (BUCKETS + 1) + gram)
                    seen += np.bincount(pairs % (BUCKETS + 1), minlength=BUCKETS + 1)
                if continued:
                    first = np.zeros(BUCKETS + 1, bool)
                    first[gram[: ends[0]]] = True
                    seen -= first & shown[order]
                if not (continued and len(numbers) == 1):
                    shown[order] = False
                shown[order, gram[starts[-1] :]] = True
            open_text = numbers[-1]
        total += seen[:BUCKETS]
    at = np.flatnonzero(total)
    at = np.concatenate([[-1], at])
    values = np.concatenate([[texts], total[at[1:]]])
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(values, pa.int64())], ["bucket", "texts"])


def inverse_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Smoothed inverse document frequency of each bucket over all training texts, and the number of texts.

    Orders share the buckets, so a bucket may count up to once per order and text. A row per bucket comes back.
    """
    rows = train.select("text").mapInArrow(_document_frequencies, "bucket int, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts")).collect()
    found = {r.bucket: r.texts for r in rows}
    n = found.pop(-1, 0)
    counts = np.zeros(BUCKETS)
    counts[list(found)] = list(found.values())
    return (np.log((1 + n * len(ORDERS)) / (1 + counts)) + 1).astype(np.float32), n


def _weights(z: np.ndarray, n: np.ndarray, t: Training) -> np.ndarray:
    return np.where(np.abs(z) <= t.l1, 0.0, -(z - np.sign(z) * t.l1) / ((t.beta + np.sqrt(n)) / t.alpha + t.l2))


def _features(texts: list[str], idf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for number, at, counts in _counts(texts):
        x = counts * idf[at]
        yield number, at, SCALE * x / max(x.sum(), 1e-9)


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _learner(state: tuple[np.ndarray, np.ndarray], idf: np.ndarray, languages: list[str], t: Training):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        z, n = state[0].copy(), state[1].copy()
        labels = frame.lang.map({x: i for i, x in enumerate(languages)}).to_numpy()
        for number, at, x in _features(frame.text.tolist(), idf):
            w = _weights(z[at], n[at], t)
            g = x[:, None] * (_softmax(x @ w) - np.eye(len(languages))[labels[number]])
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / t.alpha
            z[at] += g - sigma * w
            n[at] += g * g
        return pd.DataFrame({"change": [pickle.dumps(((z - state[0]).astype(np.float32), (n - state[1]).astype(np.float32)))]})

    return run


def _scorer(model: Model):
    table = np.vstack([model.idf[:, None] * model.weights, np.zeros((1, len(model.languages)))]).astype(np.float32)
    idf = np.append(model.idf, 0).astype(np.float32)

    def scores(texts: list[str | None]) -> np.ndarray:
        total = np.zeros((len(texts), len(model.languages)))
        norm = np.zeros(len(texts))
        for numbers, starts, points in _blocks(texts):
            for gram in _grams(points):
                np.add.at(total, numbers, np.add.reduceat(np.take(table, gram, axis=0), starts, axis=0))
                np.add.at(norm, numbers, np.add.reduceat(np.take(idf, gram), starts))
        return SCALE * total / np.maximum(norm, 1e-9)[:, None]

    return scores


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(scores / math.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, g = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def sampled(train: DataFrame, texts: int, max_train: int) -> DataFrame:
    """(text, lang, aside, shard): about ``max_train`` of ``texts`` rows; a tenth is set aside for the temperature.

    Drawn by a hash of id and text, so that it is the same whenever it is computed. Rows that are equal in id, text and
    lang count once, so that no group of copies can exceed the bound, and rows of one id, null included, are drawn apart.
    """
    def drawn(label: str, parts: int) -> Column:
        return F.pmod(F.xxhash64("doc_id", "text", F.lit(label)), F.lit(parts))

    chosen = train.where(drawn("sample", 1 << 40) / (1 << 40) < max_train / max(texts, 1)).distinct()
    return chosen.select("text", "lang", (drawn("aside", 10) == 0).alias("aside"), drawn("shard", SHARDS).alias("shard"))


def fit(train: DataFrame, settings: Training = Training()) -> Model | None:
    """Learn from (doc_id, text, lang); rows with a null text or lang are left out. None without any row.

    Languages beyond ``max_languages`` are an error, as the learner's state grows with them.
    """
    train = train.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    languages = [r.lang for r in train.select("lang").distinct().orderBy("lang").limit(settings.max_languages + 1).collect()]
    if len(languages) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages; raise max_languages")
    if not languages:
        return None
    idf, texts = inverse_frequencies(train)
    chosen = materialised(sampled(train, texts, settings.max_train), "sample")
    sample = chosen.where("not aside").groupBy("shard")
    z = np.zeros((BUCKETS, len(languages)))
    n = np.zeros_like(z)
    for _ in range(settings.rounds):
        changes = [pickle.loads(r.change) for r in sample.applyInPandas(_learner((z, n), idf, languages, settings), "change binary").collect()]
        if changes:
            z = z + sum(c[0] for c in changes) / len(changes)
            n = n + sum(c[1] for c in changes) / len(changes)
    model = Model(languages, idf, _weights(z, n, settings).astype(np.float32))
    score = _scorer(model)

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"lang": frame.lang, "scores": list(score(frame.text.tolist()))})

    kept = chosen.where("aside").mapInPandas(held, "lang string, scores array<double>").toPandas()
    labels = kept.lang.map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)
    t = _temperature(np.stack(kept.scores.to_list()) if len(kept) else np.zeros((0, len(languages))), labels)
    return Model(languages, idf, model.weights, t)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score; both columns replace earlier ones of these names.

    A null text, a text without a letter, or a model that learned nothing gives ``und`` and score 0. Ties go to the
    language that comes first in order of code points.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    score = _scorer(model)

    @F.pandas_udf("lang_pred string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        p = _softmax(score(texts.tolist()) / model.temperature)
        at = p.argmax(1)
        return pd.DataFrame({"lang_pred": [model.languages[i] for i in at], "score": p[np.arange(len(at)), at]})

    judged = docs.withColumn("__found", best("text"))
    letter: Column = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return judged.withColumns({
        "lang_pred": F.when(letter, F.col("__found.lang_pred")).otherwise("und"),
        "score": F.when(letter, F.col("__found.score")).otherwise(0.0),
    }).drop("__found")
