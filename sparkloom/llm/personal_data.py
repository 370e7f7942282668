"""Personal data by patterns, extended by a skip-chain conditional random field.

The patterns find the base spans. The field labels every token that has a digit or an ``@``; all other
tokens are certainly no such data. Its potentials are: features of the token (trained as a multinomial
logistic regression on the base spans of a bounded sample), a chain between neighbours, and skip edges
between distant tokens that are equal or have the same digits. Loopy message passing then makes the
labels of a document consistent: a card number with a typing error is recognised by its shape, and a
number written differently by its other occurrences. Confident labels outside base spans are added.
"""

from __future__ import annotations

import re
import string
import zlib
from bisect import bisect_left
from functools import partial
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ["email", "ip", "card", "phone"]
# The patterns of the base spans.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# The same matches in linear time, however long a run of letters or digits is.
_EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_NAME = frozenset(string.ascii_letters + string.digits + "._%+-")
_IP_FROM_EDGE = re.compile(r"(?<![0-9])" + PATTERNS["ip"].pattern)
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
FEATURES = 1 << 10
SAMPLE_TEXTS = 4000
SURE = 0.95
ROUNDS = 15
LIMIT = 4.0               # largest trained pairwise potential


class Field(NamedTuple):
    unary: np.ndarray     # features x labels
    chain: np.ndarray     # labels x labels
    skip: float           # gain of equal labels on a skip edge


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from their @: a long run of letters is walked once."""
    found, free = [], 0
    for m in _EMAIL_END.finditer(text):
        begin = m.start()
        while begin > free and text[begin - 1] in _EMAIL_NAME:
            begin -= 1
        if begin < m.start():
            free = m.end()
            found.append((begin, free))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind and start; code points, end exclusive."""
    spans = []
    digit = _DIGIT.search(text) is not None
    if "@" in text:
        spans += [(0, *span) for span in _emails(text)]
    if digit:
        if text.count(".") >= 3:
            spans += [(1, *m.span()) for m in _IP_FROM_EDGE.finditer(text)
                      if all(len(p.lstrip("0")) <= 3 and int(p[-20:]) <= 255 for p in m[0].split("."))]
        for m in PATTERNS["card"].finditer(text):
            if 16 <= m.end() - m.start():
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, *m.span()))
        if "+" in text:
            spans += [(3, *m.span()) for m in PATTERNS["phone"].finditer(text)
                      if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def _nodes(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, end, rank among all tokens, token)`` of tokens with a digit or an @, edges trimmed."""
    if "@" not in text and _DIGIT.search(text) is None:
        return []
    found = []
    for rank, m in enumerate(_TOKEN.finditer(text)):
        token = m[0]
        if "@" in token or _DIGIT.search(token):
            left = len(token) - len(token.lstrip("([{<\"'.,;:*#$%&"))
            core = token.strip("([{<\"'.,;:)]}>!?*#$%&")
            if core:
                found.append((m.start() + left, m.start() + left + len(core), rank, core))
    return found


def _features(token: str) -> list[int]:
    digits = sum("0" <= c <= "9" for c in token)
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", token))[:12]
    bands = sum(digits >= b for b in (1, 4, 7, 8, 12, 16, 20))
    own = (f"digits {bands}", f"shape {shape}", f"at {'@' in token} dots {min(token.count('.'), 4)}",
           f"plus {token.startswith('+')} {bands}", f"only {digits == len(token)} {bands}", "bias")
    return [zlib.crc32(x.encode()) % FEATURES for x in own]


def _key(token: str) -> str:
    """Equal for tokens joined by a skip edge: the digits of a long number, else the token."""
    digits = _NOT_DIGIT.sub("", token)
    return digits if len(digits) >= 7 else token.lower()


def _edges(nodes) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Neighbours in the text, and each token with the next one of its key."""
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][2] == nodes[i][2] + 1]
    last: dict[str, int] = {}
    skip = []
    for i, node in enumerate(nodes):
        key = _key(node[3])
        if key in last and last[key] != i - 1:
            skip.append((last[key], i))
        last[key] = i
    return chain, skip


def _labels(nodes, spans) -> list[int]:
    """Per node the label of the first span that it touches, else 0. Both go forwards in the text."""
    marks = sorted((a, b, kind + 1) for kind, a, b in spans)
    reach = np.maximum.accumulate([b for _, b, _ in marks]).tolist() if marks else []
    labels = []
    for begin, end, *_ in nodes:
        k = bisect_left(reach, begin + 1)      # no span before this one ends behind ``begin``
        while k < len(marks) and marks[k][0] < end and marks[k][1] <= begin:
            k += 1
        labels.append(marks[k][2] if k < len(marks) and marks[k][0] < end else 0)
    return labels


def train_field(texts: list[str], steps: int = 300, rate: float = 0.5) -> Field:
    """Features by regularised gradient steps, pairwise potentials from agreement counts."""
    n = len(KINDS) + 1
    rows, truth = [], []
    chain, agree = np.ones((n, n)), np.array([1.0, 1.0])
    for text in texts:
        nodes = _nodes(text)
        labels = _labels(nodes, base_spans(text))
        rows += [_features(node[3]) for node in nodes]
        truth += labels
        near, far = _edges(nodes)
        for i, j in near:
            chain[labels[i], labels[j]] += 1
        for i, j in far:
            agree[int(labels[i] == labels[j])] += 1
    w = np.zeros((FEATURES, n))
    if rows:
        x, y = np.array(rows), np.eye(n)[truth]
        for _ in range(steps):
            p = np.exp(w[x].sum(1))
            p /= p.sum(1, keepdims=True)
            g = np.zeros_like(w)
            np.add.at(g, x, ((y - p) / len(x))[:, None, :])
            w += rate * 4 * (g - 1e-5 * w)
    expect = chain.sum(1, keepdims=True) * chain.sum(0, keepdims=True) / chain.sum()
    return Field(w, np.clip(np.log(chain / expect), -LIMIT, LIMIT),
                 float(np.clip(np.log(agree[1] / agree[0]), 0, LIMIT)))


def marginals(nodes, field: Field) -> np.ndarray:
    """Label probabilities of all nodes after loopy message passing."""
    unary = np.array([field.unary[_features(node[3])].sum(0) for node in nodes])
    near, far = _edges(nodes)
    if near or far:
        same = field.skip * np.eye(unary.shape[1])
        ends = np.array(near + far)
        pair = np.array([field.chain] * len(near) + [same] * len(far))
        source = np.concatenate((ends[:, 0], ends[:, 1]))
        target = np.concatenate((ends[:, 1], ends[:, 0]))
        pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(ends)) + len(ends), np.arange(len(ends))))
        sent = np.zeros((len(source), unary.shape[1]))
        for _ in range(ROUNDS):
            total = unary.copy()
            np.add.at(total, target, sent)
            out = (total[source] - sent[back])[:, :, None] + pair
            top = out.max(1, keepdims=True)
            fresh = np.log(np.exp(out - top).sum(1)) + top[:, 0]
            fresh -= fresh.max(1, keepdims=True)
            sent = 0.5 * sent + 0.5 * fresh
        np.add.at(unary, target, sent)
    p = np.exp(unary - unary.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and those with the field's confident labels that touch no base span."""
    base, nodes = base_spans(text), _nodes(text)
    if not nodes:
        return base, base
    p, added = marginals(nodes, field), []
    for node, row, known in zip(nodes, p, _labels(nodes, base)):
        label = int(np.argmax(row))
        if label and row[label] >= SURE and not known:
            added.append((label - 1, node[0], node[1]))
    return base, sorted(base + added)


def _named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _find(batches, field: Field):
    for batch in batches:
        counts, hashes, spans = [[] for _ in KINDS], [], []
        for text in batch.column(1).to_pylist():
            base, every = all_spans(text or "", field)
            for k, column in enumerate(counts):
                column.append(sum(s[0] == k for s in base))
            hashes.append(sha256(_named(base).encode()).hexdigest())
            spans.append(_named(every))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes),
             pa.array(spans)], ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       sample: int = SAMPLE_TEXTS) -> DataFrame:
    """Per row: id, ``n_<kind>`` and ``base_sha256`` of the base spans, ``spans`` with the added ones.

    Spans are ``kind:start:end`` in code points. The field is trained on the base spans of at most
    ``sample`` texts that have a digit or an @, those whose ids hash lowest (a documented bound); all texts
    are searched whole. Null and empty texts have no spans. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = (docs.where(F.col("text").rlike("[0-9@]")).select("id").distinct()
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.join(F.broadcast(chosen), "id").select("text").limit(2 * sample).collect()
    field = train_field(sorted(r["text"] for r in texts if r["text"]))
    return docs.mapInArrow(
        partial(_find, field=field), "id " + dict(docs.dtypes)["id"] + ", "
        + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    ).withColumnRenamed("id", id_col)
