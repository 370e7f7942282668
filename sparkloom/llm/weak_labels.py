"""Quality from weak labels: heuristics vote, their accuracies are estimated, a linear scorer learns."""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkloom.llm.measures import per_text, per_word, repeated_words, tokens
from sparkloom.llm.words import Chunk, byte_table, chunks, hash_words, mix, split_words

LABELLERS = ["symbols", "capitals", "repeats", "stutter", "bars", "plain", "variety"]
ABSTAIN, BAD, GOOD = 0, 1, 2
BUCKETS = 1 << 14
SAMPLE_TEXTS = 4000
PRIOR = 0.9               # accuracy that a labeller is assumed to have before any vote is seen
_IS_UPPER = byte_table(bytes(range(65, 91)))
_IS_LOWER = byte_table(bytes(range(97, 123)))
_IS_SYMBOL = byte_table(b"#*$%&<>")
_IS_PLAIN = _IS_LOWER | byte_table(bytes(range(128, 256)))
_IS_LETTER = _IS_UPPER | _IS_LOWER | byte_table(bytes(range(128, 256)))


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float


def votes(chunk: Chunk) -> np.ndarray:
    """Per text and labeller: abstain, bad or good. Texts of under five words get no vote at all.

    The first five only know something bad. ``plain`` (words in small letters, but for the first and last
    character) and ``variety`` (different words) overlap them all and know both.
    """
    words = split_words(chunk)
    hashes = hash_words(chunk.data, words)
    n = np.maximum(np.diff(words.first), 1)
    upper, lower = per_text(chunk, _IS_UPPER[chunk.data]), per_text(chunk, _IS_LOWER[chunk.data])
    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    bar = (words.ends - words.starts == 1) & (chunk.data[words.starts] == ord("|"))
    small = np.concatenate(([0], np.cumsum(_IS_PLAIN[chunk.data])))
    length = words.ends - words.starts
    other = length - (small[words.ends] - small[words.starts])
    plain = per_word(words, (other <= 2) & (other < length)) / n
    variety = np.array([len(np.unique(hashes[a:b])) for a, b in zip(words.first, words.first[1:])]) / n
    only_bad = [(per_text(chunk, _IS_SYMBOL[chunk.data]) / n, 0.3),
                (upper / np.maximum(upper + lower, 1), 0.6),
                (per_word(words, repeated_words(hashes, words)) / n, 0.3),
                (per_word(words, stutter) / n, 0.25), (per_word(words, bar) / n, 0.2)]
    found = [np.where(share >= bad, BAD, ABSTAIN) for share, bad in only_bad]
    for share, bad, good in ((plain, 0.6, 0.9), (variety, 0.35, 0.5)):
        found.append(np.where(share <= bad, BAD, np.where(share >= good, GOOD, ABSTAIN)))
    return np.where((np.diff(words.first) >= 5)[:, None], np.array(found).T, ABSTAIN)


def estimate(patterns: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], np.ndarray]:
    """Expectation-maximisation over vote patterns and how many texts have each.

    Each labeller has an accuracy for its good and for its bad votes, the chance that such a vote is right;
    abstaining tells nothing. Before votes both classes are as likely. Most kinds of junk fire one or two
    labellers only, so a plain fit would call these wrong: accuracies are drawn half-way to ``PRIOR`` and
    a vote is taken to be better than chance. Returns P(good) per pattern, and accuracies (bad, good).
    """
    keys = np.array(sorted(patterns))
    n = np.array([patterns[tuple(k)] for k in keys.tolist()], float)
    cast = {BAD: keys == BAD, GOOD: keys == GOOD}
    accuracy = {BAD: np.full(keys.shape[1], PRIOR), GOOD: np.full(keys.shape[1], PRIOR)}
    for _ in range(rounds):
        lean = sum(sign * (cast[v] * np.log(accuracy[v] / (1 - accuracy[v]))).sum(1)
                   for v, sign in ((GOOD, 1), (BAD, -1)))
        good = 1 / (1 + np.exp(-np.clip(lean, -500, 500)))
        for v, right in ((GOOD, good), (BAD, 1 - good)):
            given = (n[:, None] * cast[v]).sum(0)
            fit = (n[:, None] * cast[v] * right[:, None]).sum(0) / np.maximum(given, 1)
            accuracy[v] = np.clip(np.where(given > 0, (fit + PRIOR) / 2, PRIOR), 0.6, 0.98)
    return ({tuple(k): float(p) for k, p in zip(keys.tolist(), good)},
            np.array([accuracy[BAD], accuracy[GOOD]]))


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's tokens: marks as they are, words by their case, and neighbours of both."""
    hashes, words = tokens(chunk)
    first, last = chunk.data[words.starts], chunk.data[words.ends - 1]
    case = (_IS_UPPER[first].astype(np.uint64) + np.uint64(2) * _IS_UPPER[last].astype(np.uint64)
            + np.uint64(4))
    kind = np.where(_IS_LETTER[first], mix(case), hashes)
    again = np.zeros(len(kind), np.uint64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    before = np.zeros(len(kind), np.uint64)
    before[1:] = np.where(words.text[1:] == words.text[:-1], kind[:-1], np.uint64(0))
    pair = mix(kind * np.uint64(3) + before * np.uint64(5) + again)
    mask = np.uint64(BUCKETS - 1)
    both = np.stack(((kind & mask), (pair & mask)), 1).astype(np.int64)
    return both.ravel(), 2 * words.first


def _count_patterns(batches):
    counts: dict[tuple, int] = {}
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            for row in map(tuple, votes(chunk).tolist()):
                counts[row] = counts.get(row, 0) + 1
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.list_(pa.int32())),
                                          pa.array(list(counts.values()))], ["votes", "n"])


def train_scorer(texts: list[str], good: dict[tuple, float], epochs: int = 30) -> Scorer:
    """Logistic regression on the posterior labels by averaged stochastic gradient steps."""
    rows, truth = [], []
    for chunk in chunks(pa.array(texts, pa.string())):
        buckets, first = _features(chunk)
        for i, row in enumerate(map(tuple, votes(chunk).tolist())):
            own = buckets[first[i]:first[i + 1]]
            if len(own) and any(row):
                at, n = np.unique(own, return_counts=True)
                rows.append((at, n / np.sqrt((n * n).sum())))
                truth.append(good[row])
    w, bias, rng = np.zeros(BUCKETS), 0.0, np.random.default_rng(5)
    for epoch in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            slope = truth[i] - 1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -30, 30)))
            w[at] += x * slope / (1 + 0.2 * epoch)
            bias += 0.1 * slope / (1 + 0.2 * epoch)
    return Scorer(w, bias)


def _score(batches, good: dict[tuple, float], scorer: Scorer, least: float):
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            buckets, first = _features(chunk)
            score = []
            for i in range(len(first) - 1):
                x = np.bincount(buckets[first[i]:first[i + 1]], minlength=BUCKETS)
                z = x @ scorer.weights / max(np.sqrt(float(x @ x)), 1.0) + scorer.bias
                score.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            rows = votes(chunk)
            n_votes = (rows != ABSTAIN).sum(1)
            weak = [good[tuple(r)] for r in rows.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(chunk.first, len(score)),
                 pa.array(n_votes), pa.array(weak), pa.array(score),
                 pa.array([s >= least or not n for s, n in zip(score, n_votes)])],
                ["id", "n_votes", "posterior", "score", "kept"])


def weak_label_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       sample: int = SAMPLE_TEXTS, least: float = 0.5) -> DataFrame:
    """Per row: id, ``n_votes``, ``posterior`` (of good, by votes), ``score`` of the scorer, ``kept``.

    Vote patterns are counted over all texts; there are 3 per labeller at most, whatever the input.
    The scorer is trained on the posteriors of ``sample`` texts, those whose ids hash lowest (a documented
    bound), and scores every text whole. Null, empty and very short texts get no votes: their posterior
    is one half, and they are kept, as nothing speaks against them. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = (docs.select("text").mapInArrow(_count_patterns, "votes array<int>, n long")
              .groupBy("votes").agg(F.sum("n").alias("n")).collect())
    good, _ = estimate({tuple(r["votes"]): r["n"] for r in counts}) if counts else ({}, None)
    chosen = docs.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.join(F.broadcast(chosen), "id").select("text").limit(2 * sample).collect()
    scorer = train_scorer(sorted(r["text"] for r in texts if r["text"]), good)
    return docs.mapInArrow(
        partial(_score, good=good, scorer=scorer, least=least),
        "id " + dict(docs.dtypes)["id"] + ", n_votes long, posterior double, score double, kept boolean"
    ).withColumnRenamed("id", id_col)
