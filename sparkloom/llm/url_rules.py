"""URL filter: a sorted, memory-mapped array of 64-bit digests, probed by vectorised binary search."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MOST_RULES = 50_000_000     # the file of digests goes to every executor's disk
VERDICTS = ("block", "allow")
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column | str) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#``; A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column | str) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty for a null or other text."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def write_digests(rules: Sequence[tuple[str, str, str]], path: str) -> None:
    """``(verdict, host, path)`` rules as one file: digests in order, then the strings they stand for."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; a file that every executor maps holds {MOST_RULES}")
    texts = [(host + own).encode() for _, host, own in rules]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
    order = np.argsort(keys, kind="stable")
    ends = np.cumsum([0, *(len(texts[i]) for i in order)]).astype(np.int64)
    splits = np.array([len(rules[i][1].encode()) for i in order], np.int64)
    allow = np.array([VERDICTS.index(rules[i][0]) for i in order], np.int64)
    with open(path, "wb") as out:
        out.write(np.int64(len(rules)).tobytes())
        for part in (keys[order], ends, splits, allow):
            out.write(part.tobytes())
        out.write(b"".join(texts[i] for i in order))


class DigestArray:
    """The mapped file; nothing is read before a probe touches it."""

    def __init__(self, path: str):
        file = np.memmap(path, np.uint8, "r")
        n = int(file[:8].view(np.int64)[0])
        cut = np.cumsum([8, 8 * n, 8 * (n + 1), 8 * n, 8 * n])
        self.keys = file[cut[0]:cut[1]].view(np.uint64)
        self.ends = file[cut[1]:cut[2]].view(np.int64)
        self.splits = file[cut[2]:cut[3]].view(np.int64)
        self.allow = file[cut[3]:cut[4]].view(np.int64)
        self.heap = file[cut[4]:]
        texts = [self.text(i) for i in range(n)]
        self.labels = {t[:s].count(b".") for t, s in zip(texts, self.splits)}
        self.lengths = sorted({len(t) - int(s) for t, s in zip(texts, self.splits)})

    def text(self, i: int) -> bytes:
        return self.heap[self.ends[i]:self.ends[i + 1]].tobytes()

    def find(self, candidates: list[tuple[bytes, int]]) -> np.ndarray:
        """Per candidate (string, bytes of its host) the rule's position or -1, strings confirmed."""
        found = np.full(len(candidates), -1)
        if not candidates or not len(self.keys):
            return found
        probes = np.array([xxhash.xxh64_intdigest(t) for t, _ in candidates], np.uint64)
        low, high = np.searchsorted(self.keys, probes), np.searchsorted(self.keys, probes, "right")
        for i in np.flatnonzero(low < high):
            for at in range(low[i], high[i]):
                if self.splits[at] == candidates[i][1] and self.text(at) == candidates[i][0]:
                    found[i] = at
        return found


@lru_cache(maxsize=8)
def _mapped(path: str) -> DigestArray:
    return DigestArray(path)


def _suffixes(host: str, labels: set[int]):
    """The host and its parent domains with a number of dots that some rule's host has."""
    while True:
        if host.count(".") in labels:
            yield host.encode()
        if "." not in host:
            return
        host = host.partition(".")[2]


def _judge(batches, file: str, default: str, names: list[str]):
    rules = _mapped(SparkFiles.get(file))
    for batch in batches:
        owners, candidates = [], []
        for i, (host, path) in enumerate(zip(batch.column("host").to_pylist(),
                                             batch.column("path").to_pylist())):
            if host:
                own = path.encode()
                for tail in _suffixes(host, rules.labels):
                    for n in rules.lengths:
                        if n <= len(own):
                            owners.append(i)
                            candidates.append((tail + own[:n], len(tail)))
        best: dict[int, tuple[int, int, int]] = {}
        found = rules.find(candidates)
        for k in np.flatnonzero(found >= 0):
            rank = (len(candidates[k][0]), candidates[k][1], int(found[k]))
            best[owners[k]] = max(best.get(owners[k], rank), rank)
        rule = [rules.text(best[i][2]).decode() if i in best else None for i in range(len(batch))]
        verdict = [VERDICTS[rules.allow[best[i][2]]] if i in best else default
                   for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names]
                                         + [pa.array(rule, pa.string()), pa.array(verdict)],
                                         [*names, "rule", "verdict"])


def judge_urls(df: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    A rule ``(verdict, host, path)`` fits its host and all subdomains if the url's path starts with the
    rule's. The longest rule wins, of equally long ones that with the longer host. Urls that no rule
    fits get ``default``; so do null, empty and malformed ones. The rules are one bounded file that
    Spark copies to the executors; the rows are neither shuffled nor grouped.
    """
    file = f"url-rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="rules-"), file)
    write_digests(rules, path)
    spark: SparkSession = df.sparkSession
    spark.sparkContext.addFile(path)
    url = F.col(url_col)
    df = df.select(*[c for c in df.columns if c not in ("host", "path", "rule", "verdict")],
                   host_of(url).alias("host"), path_of(url).alias("path"))
    return df.mapInArrow(
        partial(_judge, file=file, default=default, names=df.columns),
        ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), "rule string", "verdict string"]))
