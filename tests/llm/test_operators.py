"""The training-text operators on small tables, against brute force and round trips."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm.components import _stars as stars, components
from sparkloom.llm.decontaminate import contamination
from sparkloom.llm.importance import importance_filter
from sparkloom.llm.jaccard_join import jaccard_components, jaccard_join
from sparkloom.llm.language import fit_language, predict_language
from sparkloom.llm.mixing import mix_sources, token_count
from sparkloom.llm.personal_data import PATTERNS, base_spans, find_personal_data, marginals, train_field, _nodes
from sparkloom.llm.queries import QUERIES, SQL, held_out
from sparkloom.llm.sharding import communication_matrix, hypergeometric, uniform_shards
from sparkloom.llm.url_rules import DigestArray, judge_urls, write_digests
from sparkloom.llm.warc import read_warc, write_warc
from sparkloom.llm.weak_labels import estimate, weak_label_quality
from sparkloom.llm.words import chunks, shingle_sets
from sparkloom.llm.workspace import Workspace
from tests.conftest import SMALL
from tests.oracle import assert_same, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, region string, slot int"


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty, blank and long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"w{i % 7000}" for i in range(30_000))
    texts = [None, "", " \n\t", "one", "One", "a b c", "12345 .", long, long + " end", "É é İ ß 漢字 🙂",
             "the cat sat on the mat and it was fine today", "the cat sat on the mat and it was fine today"]
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, None, "x", 1)
            for i, t in enumerate(texts)]
    rows += [(None, "the cat sat on the mat and it was fine today", None, None, 1, None, None),
             rows[3], rows[3], (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) > 0


# --- words ---------------------------------------------------------------------------------------

def _lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def _shingles(text, size):
    w = WORD.findall(_lower(text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else \
        ({tuple(w)} if w else set())


def test_shingle_sets_agree_with_strings():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "B", "b", "ab", "é", "\n", "\t", "A"]) for _ in range(rng.randint(0, 30)))
             for _ in range(300)] + [None, "", "x" * 600_000]
    found = [s for c in chunks(pa.array(texts), 500) for s in shingle_sets(c, 4)]
    want = [_shingles(t, 4) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in want]
    for i, j in itertools.combinations(range(0, 300, 3), 2):
        assert len(np.intersect1d(found[i], found[j])) == len(want[i] & want[j])


# --- n-gram Jaccard join -------------------------------------------------------------------------

def _brute_components(rows, size, percent):
    sets = [(i, _shingles(t, size)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    return {i: root(i) for i, _ in sets}


def _families(seed):
    """Families of copies at every distance around the threshold, and texts with shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    passage, rows = [word() for _ in range(25)], []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(3, 160))]
        for _ in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = word()
            rows.append(own[:len(own) - rng.randint(0, 3)])
    rows += [passage + [word() for _ in range(rng.randint(0, 40))] for _ in range(40)]
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_agree_with_all_pairs(spark, seed):
    rows = _families(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_components(df, 4, 85).collect()}
    assert found == _brute_components(rows, 4, 85)


def test_jaccard_odd_rows(spark, odd, none):
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(odd, 4, 85).collect()),
                   key=str)
    assert len(found) == odd.count()
    by = {i: (n, c) for i, n, c in found if i is not None}
    assert by[0] == (0, 0) and by[2] == (0, 2) and by[4] == (1, 3) and by[8][1] == 7 and by[11] == (8, 10)
    assert (None, 8, 10) in found and (None, 0, None) in found
    assert jaccard_components(none).count() == 0


def _brute_links(rows, size, percent):
    sets = [_shingles(t, size) for _, t in rows]
    return {(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sets[i] and sets[j]
            and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}


def test_jaccard_join_finds_every_link_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr("sparkloom.llm.jaccard_join.SQUARE", 16)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [[*base[:k], f"x{rng.randrange(40)}", *base[k + 1:]] for k in (rng.randrange(120) for _ in range(90))]
    rows = [" ".join(w) for w in rows] + [t for _, t in _families(3)]
    rows = list(enumerate(rows + rows[:7] + rows[100:110] + [None, ""]))
    want = _brute_links(rows, 4, 85)
    found, links = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    degree = Counter(i for pair in want for i in pair)
    assert {r.doc_id: r.n_links for r in found.collect()} == {i: degree[i] for i, _ in rows}
    first = {}
    rep = [first.setdefault(frozenset(_shingles(t, 4)), i) for i, t in rows]
    assert sorted(map(tuple, links.collect())) == sorted(
        {(min(rep[i], rep[j]), max(rep[i], rep[j])) for i, j in want if rep[i] != rep[j]})


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 1)]
    work = Workspace(spark, "test")
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), work, "t").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_components_take_few_rounds(spark, monkeypatch):
    rng = random.Random(3)
    order = rng.sample(range(5000), 5000)
    edges = list(zip(order[:2000], order[1:2000])) + list(zip(order[2000:4000], order[2001:4000])) * 2
    rng.shuffle(edges)
    kept = []
    keep = Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, name, df: (kept.append(name), keep(self, name, df))[1])
    given = spark.createDataFrame(edges + [(7, None), (None, None)], "a long, b long")
    found = {r.node: r.label for r in components(given, Workspace(spark, "test"), "t").collect()}
    assert found == {i: min(part) for part in (order[:2000], order[2000:4000]) for i in part}
    assert len(kept) <= 4             # edges, first labels, and two rounds at most
    assert components(given.where("a IS NULL"), Workspace(spark, "test"), "t").isEmpty()


def test_stars_connect_what_the_edges_of_a_task_do(monkeypatch):
    monkeypatch.setattr("sparkloom.llm.components.EDGES", 4)
    edges = [(9, 8), (8, 7), (7, 6), (6, -5), (1, 2), (2, 3), (5, 3), (1, 2), (4, 9)]
    batches = [pa.RecordBatch.from_pydict({"a": [a for a, _ in part], "b": [b for _, b in part]})
               for part in (edges[:3], edges[3:4], edges[4:5], edges[5:])]
    found = [sorted(zip(*x.to_pydict().values())) for x in stars(iter(batches))]
    both = [[(9, -5), (8, -5), (7, -5), (6, -5)], [(2, 1), (3, 1), (5, 1), (9, 4)]]
    assert found == [sorted(part + [(b, a) for a, b in part]) for part in both]
    assert list(stars(iter([]))) == []


# --- URL rules -----------------------------------------------------------------------------------

def test_digests_confirm_strings(tmp_path):
    rules = [("block", f"h{i}.org", "/") for i in range(500)]
    write_digests(rules, str(tmp_path / "rules"))
    array = DigestArray(str(tmp_path / "rules"))
    assert all((array.keys[1:] >= array.keys[:-1]).tolist())
    array.keys = np.full(500, array.keys[0])          # every key collides: only strings decide
    probes = [(f"h{i}.org/".encode(), len(f"h{i}.org")) for i in range(600)]
    import sparkloom.llm.url_rules as module
    real, module.xxhash = module.xxhash, type("X", (), {"xxh64_intdigest": staticmethod(lambda t: int(array.keys[0]))})
    try:
        found = array.find(probes)
    finally:
        module.xxhash = real
    assert [array.text(i).decode() if i >= 0 else None for i in found] == \
        [f"h{i}.org/" if i < 500 else None for i in range(600)]


def test_url_rules(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("block", "münchen.de", "/ü")]
    cases = {"http://www.Example.ORG/es/x": ("example.org/es/", "block"), "http://example.org/en/12": ("example.org/en/1", "block"),
             "http://example.org/fr/": ("org/", "allow"), "http://example.org": (None, "allow"), "http://notexample.org/es/": ("org/", "allow"),
             "nothing": (None, "allow"), None: (None, "allow"), "": (None, "allow"), "x://münchen.de/üb?q": ("münchen.de/ü", "block"),
             "http://example.org?/es/": (None, "allow"), "a://b://example.org/es/": (None, "allow")}
    rows = [(i, u, "old") for i, u in enumerate(cases)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = {r.url: (r.rule, r.verdict) for r in judge_urls(df, rules).collect()}
    assert found == cases
    assert judge_urls(df.where("false"), rules).count() == 0
    assert {r.verdict for r in judge_urls(df, [], default="block").collect()} == {"block"}


# --- sharding ------------------------------------------------------------------------------------

def test_hypergeometric_law():
    rng, n = random.Random(1), 20_000
    found = Counter(hypergeometric(rng, 12, 20, 10) for _ in range(n))
    from math import comb
    for k in range(11):
        p = comb(12, k) * comb(20, 10 - k) / comb(32, 10)
        assert abs(found[k] / n - p) < 0.012
    parts, cells = [5, 0, 17, 300], [100, 0, 111, 111]
    rows = communication_matrix(rng, parts, cells)
    assert [sum(r) for r in rows] == parts and [sum(c) for c in zip(*rows)] == cells
    assert hypergeometric(rng, 10 ** 10, 10 ** 10, 10 ** 9) > 0


def test_uniform_shards(spark, small, odd, none):
    out = uniform_shards(small.select("doc_id", "source"), 8).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in small.select("doc_id").collect())
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s])) for s in sizes)
    assert out == uniform_shards(small.repartition(5).select("doc_id", "source"), 8).orderBy("shard", "slot").collect() \
        or sorted(out) == sorted(uniform_shards(small.repartition(5).select("doc_id", "source"), 8).collect())
    other = {r.doc_id: r.shard for r in uniform_shards(small.select("doc_id"), 8, seed=4).collect()}
    assert sum(other[r.doc_id] == r.shard for r in out) < len(out) / 2
    few = uniform_shards(odd, 8).collect()
    assert len(few) == odd.count() and sorted({r.slot for r in few}) == [0, 1]
    assert uniform_shards(none, 8).count() == 0


# --- WARC ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_warc_round_trip(spark, size):
    noise = "".join(chr(random.Random(3).randint(32, 0x2FFF)) for _ in range(3000))
    rows = [(1, "http://a/ b%", "x"), (2, None, "x"), (3, "u\r\nWARC-Type: revisit", ""), (4, "u", None), (5, "é", noise),
            (None, "u", "x"), (6, "u", "WARC/1.1\r\n\r\n"), (7, "u", noise), (7, "u", noise), (8, "", "y" * 900_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    work = Workspace(spark, "warc-test")
    out = read_warc(write_warc(pages, work), work.root, size).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {"x": 1, "": 3, noise: 5}
    want = Counter((i, u, len((h or "").encode()), sha(h), *(("response", None) if first.get(h or "", i) == i
                    else ("revisit", first[h or ""]))) for i, u, h in rows)
    assert Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert all((r.payload is None) == (r.record_type == "revisit") for r in out)


def test_warc_of_nothing(spark):
    work = Workspace(spark, "warc-test")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(write_warc(empty, work), work.root).count() == 0


# --- importance ----------------------------------------------------------------------------------

def _base(text):
    text = text or ""
    w, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {p for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w))


def test_importance_base_and_labels(spark, small, odd, none):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r.doc_id: r.text for r in small.collect()}
    out = importance_filter(small, labels.where("quality = 1")).collect()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _base(texts[r.doc_id])
    quality = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(quality[r.doc_id], r.kept) for r in out if r.doc_id in quality and not r.base_failed]
    assert sum(k for q, k in judged if q == 1) >= 0.98 * sum(q == 1 for q, _ in judged)
    assert sum(k for q, k in judged if q == 0) <= 0.1 * sum(q == 0 for q, _ in judged)
    strange = importance_filter(odd, labels.limit(0)).collect()
    assert len(strange) == odd.count()
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in strange) \
        == Counter(_base(r.text) for r in odd.collect())
    assert importance_filter(none, labels).count() == 0


# --- personal data -------------------------------------------------------------------------------

def test_base_spans():
    text = "Mail A.b+c@x-y.example.org, 10.0.0.256 or 192.168.0.1.7; 4111 1111-1111 1111, +49 (30) 123-4567, 4111111111111112"
    assert [(k, text[a:b]) for k, a, b in base_spans(text)] == [
        (0, "A.b+c@x-y.example.org"), (1, "192.168.0.1"), (2, "4111 1111-1111 1111"), (3, "+49 (30) 123-4567")]
    assert base_spans("é 1.2.3.4") == [(1, 2, 9)] and base_spans("") == []


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(5000):
        text = "".join(rng.choice("a1@.@..-+ 2(9\u00e9\n") for _ in range(rng.randrange(50)))
        spans = base_spans(text)
        assert [(a, b) for k, a, b in spans if k == 0] == [m.span() for m in PATTERNS["email"].finditer(text)]
        assert [(a, b) for k, a, b in spans if k == 1] == [
            m.span() for m in PATTERNS["ip"].finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]


def test_base_spans_of_long_runs_take_linear_time():
    run = 300_000
    assert base_spans("a" * run + " x@y.zz") == [(0, run + 1, run + 7)]
    assert base_spans("1" * run + " 5.6.7.8")[0] == (1, run + 1, run + 8)


def test_field_spreads_labels_over_repeated_tokens(spark, small, odd, none):
    texts = ["card 4111111111111111 and 4111111111111111 x 5500005555555559 y"] * 20 + ["in 1999 or 2024 we had 17 of 18"] * 20
    field = train_field(texts)
    nodes = _nodes("pay 4111111111111112 now and again 4111111111111112 in 1999")
    p = marginals(nodes, field)
    assert p[0].argmax() == 3 and p[1].argmax() == 3 and p[2].argmax() == 0
    out = find_personal_data(small).collect()
    for r in out:
        base = {s for s in r.spans.split(",") if s}
        assert len(base) >= r.n_email + r.n_ip + r.n_card + r.n_phone
    for r in small.collect():
        want = ",".join(f"{['email', 'ip', 'card', 'phone'][k]}:{a}:{b}" for k, a, b in base_spans(r.text))
        got = next(x for x in out if x.doc_id == r.doc_id)
        assert got.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert {s for s in want.split(",") if s} <= set(got.spans.split(","))
    assert find_personal_data(odd).count() == odd.count() and find_personal_data(none).count() == 0


# --- weak labels ---------------------------------------------------------------------------------

def test_weak_labels(spark, small, odd, none):
    good, accuracy = estimate({(2, 2, 0): 900, (1, 1, 0): 80, (1, 2, 0): 5, (0, 0, 0): 10})
    assert good[(2, 2, 0)] > 0.9 and good[(1, 1, 0)] < 0.1 and good[(0, 0, 0)] == 0.5
    root = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    out = weak_label_quality(spark.read.parquet(f"{root}/documents.parquet")).collect()
    judged = [(labels[r.doc_id], r.kept) for r in out if r.doc_id in labels]
    assert sum(k for q, k in judged if q == 1) >= 0.97 * sum(q == 1 for q, _ in judged)
    assert sum(k for q, k in judged if q == 0) <= 0.3 * sum(q == 0 for q, _ in judged)
    assert weak_label_quality(odd).count() == odd.count() and weak_label_quality(none).count() == 0


# --- mixing --------------------------------------------------------------------------------------

def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "d1", "en", "small", "w " * 10) for i in range(2)] + [(10 + i, "d1", "en", "big", "w " * 10) for i in range(50)] \
        + [(100 + i, "d2", "en", "other", "w " * 10) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, text string")
    tree = {n: F.col(n) for n in ("domain", "lang", "source")}
    out = mix_sources(df, tree, {}, token_count(), (1, 2)).groupBy("source").agg(F.sum("__tokens").alias("n"))
    assert {r.source: r.n for r in out.collect()} == {"small": 20, "big": 230, "other": 250}
    twice = mix_sources(df, tree, {"domain": {"d1": 1, "d2": 0}}, token_count(), (1, 1), max_epochs=2).collect()
    assert {r.source for r in twice} == {"small", "big"} and sum(r["__tokens"] * r["__copies"] for r in twice) == 1020


def test_mixing_passes_on_what_a_zero_weight_below_the_root_leaves(spark):
    sizes = {("a", "none"): 900, ("a", "some"): 100, ("b", "some"): 1000}
    rows = [(i, "w", d, lang) for i, (d, lang) in enumerate(k for k, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string")
    tree = {"domain": F.col("domain"), "lang": F.col("lang")}
    out = mix_sources(df, tree, {"lang": {"none": 0}}, token_count(), (1, 2)).groupBy("domain", "lang").count()
    assert {(r[0], r[1]): r[2] for r in out.collect()} == {("a", "some"): 100, ("b", "some"): 900}


def test_mixing_odd_rows(spark, odd, none):
    tree = {"lang": F.col("lang"), "source": F.col("source")}
    out = mix_sources(odd, tree, {}, token_count(), (1, 1)).collect()
    assert len(out) == sum(bool(WORD.search(r.text or "")) for r in odd.collect())
    assert mix_sources(none, tree, {}, token_count(), (1, 1)).count() == 0


# --- language ------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_language(docs, ~held_out("id"))
    assert (model.weights == 0).mean() > 0.1 and 0 < model.temperature
    out = predict_language(docs.withColumn("held", held_out()), model).where("held AND length(text) > 40").collect()
    assert sum(r.lang_pred == r.lang for r in out) >= 0.98 * len(out)
    strange = predict_language(odd.withColumn("score", F.lit("old")), model).collect()
    assert len(strange) == odd.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in strange)
    assert predict_language(none, fit_language(none, F.lit(True))).count() == 0
    assert {r.lang_pred for r in predict_language(docs, fit_language(none, F.lit(True))).collect()} == {"und"}


# --- decontamination -----------------------------------------------------------------------------

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _brute_contamination(text, items):
    w = TOKEN.findall(_lower(text or ""))
    hit, names = set(), []
    for item, own in items:
        v = TOKEN.findall(_lower(own or ""))
        size = min(13, len(v))
        windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if size else set()
        found = [i for i in range(len(w) - size + 1) if tuple(w[i:i + size]) in windows] if size else []
        hit |= {p for i in found for p in range(i, i + size)}
        names += [str(item)] * bool(found)
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_agrees_with_brute_force(spark, odd, none):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "É", "é", "K", "x1", "Zz"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 12, 13, 14, 40])))) for i in range(25)]
    items += [(90, items[0][1]), (91, None), (92, "..."), (None, "q q q"), (93, items[6][1].swapcase()), (94, "\u0391\u03a3 \u03c9")]
    docs = []
    for i in range(60):
        own = [word() for _ in range(rng.randint(0, 60))]
        own += TOKEN.findall(items[rng.randrange(25)][1])[rng.randint(0, 3):] + [word() for _ in range(rng.randint(0, 400))]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    docs += [(100, None), (101, ""), (None, items[5][1]), docs[0], docs[0], (102, items[3][1] + "!" + items[3][1]),
             (103, "x \u0391\u03a3'\u03c9 y")]         # a capital sigma that is final in the item only
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    known = [x for x in items if x[0] is not None]
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out)
    assert got == Counter((i, *_brute_contamination(t, known)) for i, t in docs)
    assert contamination(odd, bench).count() == odd.count() and contamination(none, bench).count() == 0
    assert contamination(odd, bench.where("false")).where("contaminated").count() == 0


# --- pipeline ------------------------------------------------------------------------------------

def test_pipeline_keeps_what_it_should(spark, small):
    docs, seen = small, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(path := Workspace(spark, "stage").root)
        docs = spark.read.parquet(path)
        seen[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name != "shards":
            assert docs.columns == small.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(set(seen[b]) <= set(seen[a]) for a, b in zip(names, names[1:]))
    assert len(seen["language"]) >= 0.99 * small.count()
    first = _brute_components(sorted(seen["language"].items()), 5, 80)
    assert set(seen["near_duplicates"]) == {i for i, c in first.items() if i == c}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert set(seen["benchmark_passages"]) == {i for i, t in seen["near_duplicates"].items() if not _brute_contamination(t, bench)[4]}
    assert set(seen["shards"]) == set(seen["mixture"])
    assert docs.groupBy("shard").count().count() == 8
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_duplicates_without_ids(spark, odd, none):
    out = corpus_pipeline.near_duplicates(spark, odd, SMALL).collect()
    assert Counter(r.doc_id for r in out) == Counter([0, 1, 2, 3, 5, 6, 7, 9, 10, None])
    words = " ".join(f"n{i}" for i in range(300))
    rows = [(None, words), (None, words + " more"), (None, "quite another text of some six words"), (7, words + " or less")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == [(0, rows[2][1]), (7, rows[3][1])]
    assert corpus_pipeline.near_duplicates(spark, none, SMALL).count() == 0
