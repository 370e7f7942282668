"""Quality by importance: likelihood ratio of hashed n-grams under trusted text and the raw corpus."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.measures import base_measures, tokens
from sparkloom.llm.words import Chunk, chunks, hash_runs
from sparkloom.session import stored

BUCKETS = 1 << 16
BITS = 1 << 26
SMOOTHING = 1.0
LEAST_WORDS = 10
MOST_REPEATED = 20        # percent of words in repeated windows
SPREADS = 3.0             # how far below the trusted texts' centre a text may score
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens and pairs of neighbours, ordered by text, and each text's first."""
    hashes, words = tokens(chunk)
    pairs, at = hash_runs(hashes, words, 2)
    buckets = (np.concatenate((hashes, pairs)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    text = np.concatenate((words.text, words.text[at]))
    order = np.argsort(text, kind="stable")
    return buckets[order], np.searchsorted(text[order], np.arange(len(chunk.offsets)))


def _count(batches):
    """``(bucket, n)`` of one partition."""
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            n += np.bincount(_features(chunk)[0], minlength=BUCKETS)
    have = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(n[have])], ["bucket", "n"])


def _counts(docs: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts."""
    found = (docs.mapInArrow(_count, "bucket long, n long").groupBy("bucket")
             .agg(F.sum("n").alias("n")).collect())              # BUCKETS rows at most
    counts = np.zeros(BUCKETS)
    for r in found:
        counts[r["bucket"]] = r["n"]
    return counts


def _marked(batches, words: np.ndarray):
    """Rows whose bit is set."""
    for batch in batches:
        at = batch.column(2).to_numpy()
        hit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        yield batch.filter(pa.array(hit.astype(bool))).select([0, 1])


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows that have one of the ids, by an exact join, to which a bitmap of ``BITS`` hashed ids
    lets few other texts come. The hint keeps one plan at all sizes."""
    bit = F.pmod(F.xxhash64(F.col("id").cast("long")), F.lit(BITS)).alias("bit")
    found = (ids.where("id IS NOT NULL").select(bit).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toArrow())
    words = np.zeros(BITS >> 6, np.uint64)                       # a bound: 8 MB however many ids
    words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    near = docs.select(F.col("id").cast("long").alias("id"), "text", bit).mapInArrow(
        partial(_marked, words=words), "id long, text string")
    return near.join(ids.hint("merge"), "id", "left_semi")


def _mean_ratio(chunk: Chunk, ratio: np.ndarray) -> np.ndarray:
    buckets, first = _features(chunk)
    sums = np.concatenate(([0.0], np.cumsum(ratio[buckets])))
    n = np.diff(first)
    return (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)


def _scores(batches, ratio: np.ndarray):
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(_mean_ratio(chunk, ratio))], ["score"])


def _judge(batches, ratio: np.ndarray, threshold: float):
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            found = base_measures(chunk)
            failed = ((found["n_words"] < LEAST_WORDS)
                      | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"]))
            score = _mean_ratio(chunk, ratio)
            n = len(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(chunk.first, n)] + [pa.array(found[b], pa.int64()) for b in BASE]
                + [pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))],
                ["id", *BASE, "base_failed", "score", "kept"])


def importance_filter(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per row: id, the base measures, ``base_failed``, ``score`` and ``kept``.

    ``trusted`` has the ids of good texts, all of which make the target distribution; they are joined
    and stored once, as they are read twice. The raw distribution counts all texts. The score is the mean log ratio of a text's hashed tokens and token pairs. The threshold is
    fixed by the trusted texts' scores: their median less ``SPREADS`` times the distance from the
    median down to their first percentile. Without trusted ids every ratio is 0 and the base rules alone decide. Null, empty and
    blank texts have zero measures and fail the base rules. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = trusted.select(F.col(id_col).alias("id")).distinct()
    good = stored(_with_ids(docs, ids), "trusted")
    raw, target = _counts(docs), _counts(good)
    ratio, threshold = np.zeros(BUCKETS), 0.0
    if target.any():
        ratio = (np.log((target + SMOOTHING) / (target + SMOOTHING).sum())
                 - np.log((raw + SMOOTHING) / (raw + SMOOTHING).sum()))
        own = good.mapInArrow(partial(_scores, ratio=ratio), "score double")
        low, middle = own.agg(F.percentile_approx("score", F.array(F.lit(0.01), F.lit(0.5)), 10_000)
                              .alias("q")).first()["q"]
        threshold = middle - SPREADS * (middle - low)
    return docs.mapInArrow(
        partial(_judge, ratio=ratio, threshold=threshold),
        "id long, " + ", ".join(f"{b} long" for b in BASE)
        + ", base_failed boolean, score double, kept boolean").withColumnRenamed("id", id_col)
