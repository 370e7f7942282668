"""Near duplicates by tensored banding, prefix tries and whitening, against brute force; rows that share an id."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

import corpus_pipeline
from sparkloom.llm import blocks, jaccard_join as jaccard_join_module, tensor_dedup
from sparkloom.llm.blocks import linked_between
from sparkloom.llm.double_array import ROOT, DoubleArray
from sparkloom.llm.feast import inertia_below, largest_eigenpairs
from sparkloom.llm.importance import importance_filter
from sparkloom.llm.jaccard_join import jaccard_components, jaccard_join
from sparkloom.llm.language import fit_language, predict_language
from sparkloom.llm.prefix_trie import own_turns, prefix_trie, rebuilt
from sparkloom.llm.queries import QUERIES
from sparkloom.llm.tensor_dedup import half_keys, least_marks, minhashes, near_duplicates
from sparkloom.llm.whitening import whiten
from sparkloom.llm.workspace import Workspace
from tests.conftest import SMALL
from tests.llm.test_operators import DOCS, WORD, _brute_components, _families, _shingles, none, odd  # noqa: F401


# --- tensored banding ------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_agree_with_all_pairs(spark, seed):
    rows = _families(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 2, 80).collect()}
    want = _brute_components(rows, 2, 80)
    assert found == {i: (len(_shingles(t, 2)), want[i], want[i] == i) for i, t in rows}


@pytest.fixture
def crowd():
    """One text in 400 versions of every degree of change, most linked somehow, some with nothing."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        for _ in range(rng.choice([1, 2, 3, 5, 8, 12])):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(own)))
    return rows


def test_a_crowd_of_versions_is_decided_in_blocks(spark, crowd, monkeypatch):
    sizes = []
    def counted(sides, sets, percent):
        sizes.append(sides.count())
        return linked_between(sides, sets, percent)
    monkeypatch.setattr(tensor_dedup, "linked_between", counted)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    df = spark.createDataFrame(crowd, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(df, 2, 80).collect()}
    assert found == _brute_components(crowd, 2, 80)
    assert sizes and sizes[0] > 100


def test_a_crowd_in_the_join(spark, crowd):
    df = spark.createDataFrame(crowd, "doc_id long, text string")
    rows, links = jaccard_join(df, 2, 80)
    sets = [_shingles(t, 2) for _, t in crowd]
    pairs = {(i, j) for i in range(400) for j in range(i + 1, 400)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {(r.a, r.b) for r in links.collect()} == pairs
    met = Counter(x for p in pairs for x in p)
    want = _brute_components(crowd, 2, 80)
    assert {r.doc_id: (r.component_id, r.n_links) for r in rows.collect()} == {
        i: (want[i], met[i]) for i in range(400)}


def test_near_duplicates_of_odd_rows(spark, odd, none):  # noqa: F811
    found = [tuple(r) for r in near_duplicates(odd, 2, 80).collect()]
    assert len(found) == odd.count()
    by = {i: rest for i, *rest in found if i is not None}
    assert by[0] == [0, 0, True] and by[2] == [0, 2, True] and by[4] == [1, 3, False] and by[8][1] == 7
    assert by[11] == [10, 10, False]
    assert (None, 10, 10, False) in found and (None, 0, None, True) in found
    assert near_duplicates(none).count() == 0


SHARED = [(5, "a b c d e f g h i j k l"), (5, "m n o p q r s t u v w x"),
          (6, "a b c d e f g h i j k l !"), (7, "m n o p q r s t u v w x !"), (None, "a b c d e f g h i j k l ! !")]


def test_rows_that_share_an_id_count_for_their_own_text(spark):
    df = spark.createDataFrame(SHARED, "doc_id long, text string")
    found = sorted((tuple(r) for r in near_duplicates(df, 2, 80).collect()), key=repr)
    assert found == sorted([(5, 11, 5, True), (5, 11, 5, True), (6, 12, 5, False), (7, 12, 5, False),
                            (None, 13, 5, False)], key=repr)
    rows, links = jaccard_join(df.where("doc_id IS NOT NULL"), 2, 80)
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == [
        (5, 11, 5, 1), (5, 11, 5, 1), (6, 12, 5, 1), (7, 12, 5, 1)]
    assert sorted(tuple(r) for r in links.collect()) == [(5, 6), (5, 7)]


def test_an_id_a_thousand_times(spark):
    rng = random.Random(4)
    rows = [(1, " ".join(f"w{rng.randrange(500)}" for _ in range(30))) for _ in range(1000)]
    same = [(2, "the same words again and again until the end")] * 1000
    df = spark.createDataFrame(rows + same, "doc_id long, text string")
    for make in (near_duplicates, jaccard_components):
        found = Counter((r.doc_id, r.component_id) for r in make(df, 2, 80).collect())
        assert found == {(1, 1): 1000, (2, 2): 1000}
    docs = df.select("doc_id", "text", F.when(F.col("doc_id") == 1, "en").otherwise("de").alias("lang"))
    model = fit_language(docs, F.lit(True))
    assert set(model.languages) == {"en", "de"} and predict_language(docs, model).count() == 2000


def test_the_pipeline_keeps_distinct_texts_under_one_id(spark):
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in SHARED + SHARED[:1] + [(8, None), (9, "")]],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(5, SHARED[0][1]), (5, SHARED[1][1]), (8, None), (9, "")], key=repr) or sorted(
        ((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(5, SHARED[0][1]), (5, SHARED[1][1]), (8, None), (9, "")], key=repr)


def test_tables_meet_at_the_threshold():
    rng, met, exact = np.random.default_rng(1), 0, []
    for _ in range(300):
        items = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        pair = [np.sort(items[:450]), np.sort(items[50:])]            # similarity 0.8
        hashes = minhashes(pair)
        first, second = half_keys(hashes)
        met += bool((first[0] == first[1]).any() and (second[0] == second[1]).any())
        exact.append((hashes[:, 0] == hashes[:, 1]).sum())
    assert met >= 299 and abs(np.mean(exact) / len(hashes) - 0.8) < 0.01 and min(exact) >= least_marks(80)
    far = [np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(200)]
    first, second = half_keys(minhashes(far))
    assert len(np.unique(first)) == first.size and len(np.unique(second)) == second.size


# --- prefix trie -----------------------------------------------------------------------------------

def test_double_array_holds_what_was_put_in():
    rng = random.Random(2)
    for size in (1, 3, 40):
        seqs = {tuple(rng.randrange(1, size + 1) for _ in range(rng.randint(0, 6))) for _ in range(400)}
        prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
        trie, at = DoubleArray(4), {(): ROOT}
        for depth in range(1, 7):
            level = sorted((at[p[:-1]], p[-1], p) for p in prefixes if len(p) == depth)
            if not level:
                continue
            nodes, codes = (np.array([row[k] for row in level]) for k in (0, 1))
            trie.add_level(nodes, codes)
            for (_, _, p), slot in zip(level, trie.follow(nodes, codes).tolist()):
                assert slot > 0
                at[p] = slot
        assert len(set(at.values())) == len(prefixes)
        for p in prefixes:
            for code in range(0, size + 2):
                slot = int(trie.follow(np.array([at[p]]), np.array([code]))[0])
                assert slot == at.get((*p, code), 0)


def _brute_trie(turns):
    """Nodes by conversation and depth, straight from the definition."""
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in members)]
        ends = sorted(c for c in convs if len(seqs[c]) == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                    sum(len(p) == len(path) + 1 for p in below), len(leaves),
                    sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id long, turn long, role string, text string, seq string, shard int"


def _turns(seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(0, 400), 120):
        for turn in range(rng.choice([1, 1, 2, 4, 9])):
            rows.append((conv, turn, rng.choice(["user", "bot", None]), rng.choice(["a b", "a  b\nc", "", None, "é"])))
    return rows


@pytest.mark.parametrize("shard_turns", [7, 60, 100_000])
def test_trie_agrees_with_its_definition(spark, shard_turns):
    rows = _turns(shard_turns)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(4)
    found = prefix_trie(rebuilt(own_turns(df)), shard_turns)
    assert sorted((tuple(r) for r in found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=repr) == _brute_trie(rows)


def test_trie_of_odd_conversations(spark):
    rows = [(None, 1, "user", "lost"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, None, None),
            (45, 1, "user", "own"), (20, 5, "user", "x " * 3000), (21, 5, "user", "x " * 3000), (-7, 1, "a", "b")]
    rows += [(10_000 + k, t, "u", f"t{t}") for k in range(300) for t in range(3)]      # one conversation 300 times
    df = spark.createDataFrame([(*r, None, None) for r in rows], TURNS)
    found = prefix_trie(rebuilt(own_turns(df)), 50)
    assert sorted((tuple(r) for r in found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=repr) == _brute_trie(rows)
    assert prefix_trie(rebuilt(own_turns(df.where("false")))).count() == 0


# --- whitening -------------------------------------------------------------------------------------

def _symmetric(kind):
    rng = np.random.default_rng(7)
    if kind == "full":
        a = rng.standard_normal((40, 60))
    elif kind == "low rank":
        a = rng.standard_normal((40, 5))
    elif kind == "equal values":
        return np.diag(np.r_[[5.0] * 20, [1.0] * 20])
    elif kind == "falling":
        return np.diag(2.0 ** -np.arange(40))
    else:
        a = np.zeros((6, 3))
    return a @ a.T


@pytest.mark.parametrize("kind", ["full", "low rank", "equal values", "falling", "zero"])
def test_largest_eigenpairs(kind):
    matrix = _symmetric(kind)
    values, vectors = largest_eigenpairs(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) == {"low rank": 5, "zero": 0}.get(kind, 16)
    assert np.allclose(values, want[:len(values)], rtol=1e-12, atol=1e-13 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) <= 1e-11 * max(want[0], 1e-300)


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 30):
        a = rng.standard_normal((size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (*rng.uniform(values[0] - 1, values[-1] + 1, 8), 0.0):
            assert inertia_below(a, shift) == (values < shift).sum()
    assert inertia_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


VECTORS = "vec_id long, embedding array<float>, component string, code int"


def _vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS).repartition(parts)


def _brute_whitening(rows):
    x = np.array([[np.floor(np.float32(c).astype(float) * 64) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / len(fit)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, int((values > 1e-9 * max(values[0], 1e-300)).sum()))
    sums = [int(s) for s in fit.sum(axis=0)]
    deviation = [sum((len(fit) * int(c) - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return len(fit), deviation, (x - mean) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(cov)


@pytest.mark.parametrize("size", [5, 24])
def test_whitening_agrees_with_a_dense_solver(spark, size):
    rng = np.random.default_rng(size)
    base = rng.standard_normal((200, size)) * np.linspace(1, 3, size)
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(base)] + [
        (1000 + i, [float(c) for c in np.float32(base[0])]) for i in range(100)]           # one vector often
    found = whiten(_vectors(spark, rows)).orderBy("vec_id", "component").collect()
    n, deviation, whitened, explained = _brute_whitening(rows)
    k = len(explained)
    assert len(found) == len(rows) * k == len(rows) * min(16, size)
    table = np.array([r.whitened for r in found]).reshape(-1, k)
    sign = np.sign((table * whitened).sum(axis=0))
    assert np.abs(table - whitened * sign).max() < 1e-9
    assert [r.deviation for r in found[::k]] == deviation and {r.n for r in found} == {n}
    assert np.allclose([r.explained for r in found[:k]], explained, rtol=1e-10)
    assert found[0].identity_error < 1e-10 and len({r.identity_error for r in found}) == 1
    again = whiten(_vectors(spark, rows[::-1], 7)).orderBy("vec_id", "component").collect()
    assert [(r.whitened, r.deviation, r.explained) for r in again] == [
        (r.whitened, r.deviation, r.explained) for r in found]                               # bit for bit


def test_whitening_of_odd_rows(spark):
    good = [(1, [0.5, 1.0, 2.0]), (2, [1.5, -1.0, 0.0]), (3, [0.5, 1.0, 2.0]), (None, [7.0, 9.0, -3.0])]
    bad = [(4, None), (5, [1.0, None, 2.0]), (6, [float("nan"), 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0]),
           (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0, 4.0])]
    found = whiten(_vectors(spark, good + bad)).collect()
    n, deviation, _, explained = _brute_whitening(good)
    assert n == 3 and len(explained) == 2
    assert Counter(r.vec_id for r in found) == {1: 2, 2: 2, 3: 2, None: 2}
    assert {(r.vec_id, r.deviation) for r in found} == set(zip([1, 2, 3, None], deviation))
    assert whiten(_vectors(spark, good[:1] * 3)).count() == 0            # one vector has no components
    assert whiten(_vectors(spark, bad[:2])).count() == 0 == whiten(_vectors(spark, [])).count()


def test_registered_whitening(spark):
    out = QUERIES["op13_whitening"](spark, SMALL)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.select("component").distinct().count() == 16
    assert out.agg(F.max("identity_error")).head()[0] < 1e-10


# --- importance: all trusted texts ----------------------------------------------------------------

def test_importance_counts_every_trusted_text(spark):
    docs = spark.range(21_000).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(id, id + 11), x -> concat('w', x))) AS text")
    out = importance_filter(docs, docs.select("doc_id"))
    # raw and trusted texts are the same, so no word tells for or against a text
    assert out.agg(F.max(F.abs("score"))).first()[0] < 1e-12


@pytest.mark.parametrize("most", [1, 2, 3])
def test_pivots_come_from_the_largest_component_without_a_join(spark, most):
    given = [(b, 100 * b + i, 7 if i < 6 else 8 if i < 9 else i) for b in range(40) for i in range(b + 1)]
    frame = spark.createDataFrame(given, "bucket long, node long, label long")
    found = tensor_dedup._pivots(frame, most, 1)
    spread = {n: s for n, s in frame.select("node", F.xxhash64("node", F.lit(1))).collect()}
    wanted = set()
    for bucket in range(40):
        own = [(n, label) for b, n, label in given if b == bucket]
        sizes = Counter(label for _, label in own)
        main = max(sizes, key=lambda label: (sizes[label], label))
        slots = {}
        for n in sorted((n for n, label in own if label == main), key=spread.get):
            slots.setdefault(spread[n] % most, n)
        wanted |= {(bucket, n, main) for n in slots.values()}
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_the_driver_gets_a_byte_per_bucket(spark, monkeypatch):
    size = 1 << jaccard_join_module.SKETCH_BITS
    counts = np.random.default_rng(5).geometric(0.01, size).astype(np.int64) * (np.arange(size) % 3 > 0)
    parts = [counts // 3, counts - counts // 3]
    given = [(k, part[k * jaccard_join_module.BLOCK:(k + 1) * jaccard_join_module.BLOCK].tobytes())
             for part in parts for k in range(size // jaccard_join_module.BLOCK) if k != 9]
    counts[9 * jaccard_join_module.BLOCK:10 * jaccard_join_module.BLOCK] = 0
    mean, sent = counts.mean(), []
    whole = DataFrame.collect

    def collect(df):
        sent.append(whole(df))
        return sent[-1]

    frame = spark.createDataFrame(given, "block int, counts binary")
    monkeypatch.setattr(DataFrame, "collect", collect)
    found = jaccard_join_module._rank_of_buckets(frame, Workspace(spark, "ranks"))
    above = np.log2(np.maximum(counts - mean, 1)).astype(np.uint8) + 1
    assert found == np.where(counts <= mean + 4 * mean ** 0.5 + 2, 0, above).astype(np.uint8).tobytes()
    assert sum(len(v) for rows in sent for r in rows for v in r if isinstance(v, (bytes, bytearray))) <= size
