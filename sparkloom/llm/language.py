"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import hashlib
import zlib
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.llm.words import mix

BUCKETS = 1 << 14         # hashed n-grams
ORDERS = (1, 2, 3)        # characters of an n-gram
CHUNK_CHARS = 1 << 19
UNKNOWN = "und"
SLICES = 64               # tasks that first look for a language's sample
SNIPPET = 48              # characters of the short piece that each training text adds
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray       # buckets x languages
    idf: np.ndarray
    temperature: float


def _is_letter(points: np.ndarray) -> np.ndarray:
    known = _LETTER[np.minimum(points, (1 << 16) - 1)]
    for p in np.unique(points[points >= 1 << 16]):
        known[points == p] = chr(int(p)).isalpha()
    return known


def _grams(texts: list[str | None]):
    """Per text the buckets of its n-grams (letters in lower case, all else one blank); None: none."""
    begin = 0
    while begin < len(texts):
        parts, size, end = [], 0, begin
        while end < len(texts) and (size < CHUNK_CHARS or end == begin):
            parts.append((" " + (texts[end] or "").lower() + " ").encode("utf-32-le"))
            size += len(parts[-1]) // 4
            end += 1
        points = np.frombuffer(b"".join(parts), np.uint32)
        owner = np.repeat(np.arange(len(parts)), [len(p) // 4 for p in parts])
        letter = _is_letter(points)
        points = np.where(letter, points, 32)
        keep = letter | np.concatenate(([True], letter[:-1] | (owner[1:] != owner[:-1])))
        points, owner, letter = points[keep].astype(np.uint64), owner[keep], letter[keep]
        found, owners = [], []
        for order in ORDERS:
            last = len(points) - order + 1
            if last <= 0:
                continue
            total, some = np.zeros(last, np.uint64), np.zeros(last, bool)
            for k in range(order):
                total = total * np.uint64(0x100000001B3) + points[k:k + last] + np.uint64(1)
                some |= letter[k:k + last]
            whole = some & (owner[:last] == owner[order - 1:])
            found.append((mix(total[whole] + np.uint64(order)) & np.uint64(BUCKETS - 1)).astype(np.int64))
            owners.append(owner[:last][whole])
        for k in range(len(parts)):
            yield np.concatenate([f[np.searchsorted(o, k):np.searchsorted(o, k + 1)]
                                  for f, o in zip(found, owners)] or [np.empty(0, np.int64)])
        begin = end


def _document_counts(batches):
    """Texts of the partition that have each bucket, and in the last row how many there are."""
    counts, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for grams in _grams(batch.column(0).to_pylist()):
            counts[np.unique(grams)] += 1
            n += 1
    have = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(have, -1)),
                                      pa.array(np.append(counts[have], n))], ["bucket", "n"])


def _vector(grams: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.bincount(grams, minlength=BUCKETS) * idf
    return x / (np.sqrt(x @ x) or 1.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _examples(batches):
    """``(lang, mark, buckets, counts)``: the grams of each text and of one piece of it, as numbers only."""
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        pieces = []
        for text in texts:
            at = zlib.crc32(text.encode()) % max(1, len(text) - SNIPPET)
            pieces += [text, text[at:at + SNIPPET]]
        marks, buckets, counts = [], [], []
        for piece, grams in zip(pieces, _grams(pieces)):
            have, n = np.unique(grams, return_counts=True)
            marks.append(hashlib.md5(piece.encode()).digest())
            buckets.append(have.astype(np.int32).tobytes())
            counts.append(n.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang for lang in langs for _ in range(2)]),
             pa.array([m for m in marks[::2] for _ in range(2)], pa.binary()), pa.array([0, 1] * len(langs), pa.int32()),
             pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())],
            ["lang", "mark", "piece", "buckets", "counts"])


def train(examples: list[tuple[str, bytes, bytes]], idf: np.ndarray, epochs: int = 4, alpha: float = 2.0,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 3) -> Model:
    """Fit by follow-the-regularised-leader with elastic-net penalties, then fit the temperature.

    Examples are language, buckets and counts, a text and its piece after each other. Every fifth text is kept
    from training; the temperature minimises their log loss.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _, _ in examples})
    labels, rows = [languages.index(lang) for lang, _, _ in examples], []
    for _, buckets, counts in examples:
        at = np.frombuffer(buckets, np.int32)
        x = np.frombuffer(counts, np.int32) * idf[at]
        rows.append((at, x / (np.sqrt(x @ x) or 1.0)))
    held = (np.arange(len(rows)) // 2) % 5 == 4
    z, n = np.zeros((BUCKETS, len(languages))), np.zeros((BUCKETS, len(languages)))

    def weights(at):
        rate = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(z[at]) <= l1, 0.0, (np.sign(z[at]) * l1 - z[at]) / rate)

    for _ in range(epochs):
        for i in rng.permutation(np.flatnonzero(~held)):
            at, x = rows[i]
            w = weights(at)
            slope = _softmax(x @ w)
            slope[labels[i]] -= 1
            g = x[:, None] * slope[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    logits = np.array([rows[i][1] @ w[rows[i][0]] for i in np.flatnonzero(held)])
    truth = np.array(labels)[held]
    heat = 1.0
    if len(truth):
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
        loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
                for t in grid]
        heat = float(grid[int(np.argmin(loss))])
    return Model(languages, w, idf, heat)


def _predict(batches, model: Model, names: list[str]):
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        lang, score = [], []
        for text, grams in zip(texts, _grams(texts)):
            if not len(grams) or not model.languages:
                lang.append(UNKNOWN)
                score.append(0.0)
                continue
            p = _softmax(_vector(grams, model.idf) @ model.weights / model.temperature)
            best = int(np.argmax(p))
            lang.append(model.languages[best])
            score.append(float(p[best]))
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names]
                                         + [pa.array(lang), pa.array(score)],
                                         [*names, "lang_pred", "score"])


def fit_language(docs: DataFrame, learn: Column, per_language: int = 400, text_col: str = "text",
                 lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """A model from the rows where ``learn`` holds and text and language are known.

    Inverse document frequencies count all those rows. The regression is fitted on ``per_language``
    texts of each language, those whose ids hash lowest; the driver holds their hashed counts only, at most one
    per bucket however long a text is. An id that repeats is chosen once, with its smallest text of that language.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang")).where(learn).where(
                           "text IS NOT NULL AND lang IS NOT NULL")
    counts = (rows.select("text").mapInArrow(_document_counts, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect())    # buckets + 1 rows at most
    have = {r["bucket"]: r["n"] for r in counts}
    total, idf = have.pop(-1, 0), np.full(BUCKETS, 0.0)
    for bucket, n in have.items():
        idf[bucket] = np.log((1 + total) / (1 + n)) + 0.1
    chosen = rows.select("id", "lang").distinct().withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(SLICES)))
    for keys in (["lang", "slice"], ["lang"]):    # a frequent language is spread over tasks first
        lowest = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id")
        chosen = (chosen.withColumn("turn", F.row_number().over(lowest))
                  .where(F.col("turn") <= per_language).drop("turn"))
    chosen = chosen.select("id", "lang")
    # An id that repeats gives one text, the smallest: no more rows than ids are chosen, whatever repeats.
    sample = rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))
    found = sample.select("lang", "text").mapInArrow(
        _examples, "lang string, mark binary, piece int, buckets binary, counts binary").collect()
    examples = [(r["lang"], bytes(r["buckets"]), bytes(r["counts"]))
                for r in sorted(found, key=lambda r: (r["lang"], bytes(r["mark"]), r["piece"]))]
    return train(examples, idf) if examples else Model([], np.zeros((BUCKETS, 0)), idf, 1.0)


def predict_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language.

    Only the text is used, all of it. A null text or one without a letter is ``und`` with score 0, and
    so is every text if nothing could be learnt. Columns of these two names are replaced; others pass.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    return docs.withColumn("__text", F.col(text_col)).mapInArrow(
        partial(_predict, model=model, names=names),
        ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), "lang_pred string", "score double"]))
