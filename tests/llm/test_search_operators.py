"""SimHash trie, sparse ball trees and hard negatives against brute-force versions."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from quantsilo.llm import hard_negatives, queries, simhash_trie, sparse_balls
from quantsilo.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---- 11 ----------------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def labels_of(values, budget=3):
    """The smallest index reachable by links, by comparing all pairs."""
    up = list(range(len(values)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    v = np.array(values, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[:i] ^ v[i]) <= budget).tolist():
            a, b = sorted((top(i), top(j)))
            up[b] = a
    return [top(i) for i in range(len(v))]


def some_fingerprints(kind, rng):
    if kind == "random":
        return rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    if kind == "ball":            # near copies of one value, up to nine bits off
        return np.array([0x123456789ABCDEF0 ^ sum(1 << k for k in set(rng.integers(0, 64, rng.integers(0, 10)).tolist()))
                         for _ in range(1500)], np.uint64)
    if kind == "dense":
        return rng.integers(0, 1 << 13, 1500, dtype=np.uint64)
    return np.concatenate([rng.integers(0, 1 << 10, 200, dtype=np.uint64),
                           rng.integers(0, 1 << 20, 400, dtype=np.uint64) << np.uint64(44), np.array([0, 2 ** 64 - 1], np.uint64)])


@pytest.mark.parametrize("kind", ["random", "ball", "dense", "mixed"])
@pytest.mark.parametrize("leaf", [1, 4])
def test_trie_self_join_equals_all_pairs(kind, leaf):
    v = np.unique(some_fingerprints(kind, np.random.default_rng(3)))
    assert simhash_trie.join(simhash_trie.Trie(v, leaf), None, np.arange(len(v))).tolist() == labels_of(v)


@pytest.mark.parametrize("kind", ["ball", "dense", "mixed"])
def test_shards_hold_every_fingerprint_once_and_partners_miss_no_link(kind):
    v = np.unique(some_fingerprints(kind, np.random.default_rng(4)))

    def count(bits, heavy):
        found = Counter(int(x) >> (64 - bits) for x in v)
        return {p: n for p, n in found.items() if bits == simhash_trie.STEP_BITS or p >> simhash_trie.STEP_BITS in set(heavy)}

    cuts = simhash_trie.cut(count, len(v), 40)
    at = [[i for i, (p, b) in enumerate(cuts) if int(x) >> (64 - b) == p] for x in v]
    assert all(len(a) == 1 for a in at)
    assert max(Counter(a[0] for a in at).values()) <= 40
    pairs = set(simhash_trie.partners(cuts))
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[:i] ^ v[i]) <= 3).tolist():
            a, b = sorted((at[i][0], at[j][0]))
            assert a == b or (a, b) in pairs


def near_texts():
    rng = np.random.default_rng(8)
    base, out = [f"w{i}" for i in rng.integers(0, 900, 250)], {}
    for i in range(160):
        t = list(base) if i % 4 else [f"v{k}" for k in rng.integers(0, 500, 40)]
        for k in rng.integers(0, len(t), int(rng.integers(0, 9))):
            t[k] = f"x{rng.integers(0, 99)}"
        out[i] = " ".join(t)
        base = t if i % 11 == 1 else base
    return out


def test_simhash_components_equal_all_pairs(spark):
    texts = near_texts()
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(simhash_trie.near_duplicates(d, least=4))}       # some forty shards
    fps = [plain_fingerprint(t) for t in texts.values()]
    want = labels_of(fps)
    assert 1 < len(set(want)) < len(texts)
    for i in texts:
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{fps[i]:016x}", want[i])


def test_simhash_query_equals_all_pairs(spark):
    docs = sorted(rows(table(spark, SF, "documents").select("doc_id", "text")), key=lambda r: r["doc_id"])
    fps = [plain_fingerprint(r["text"]) for r in docs]
    want = labels_of(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(queries.QUERIES["op11_simhash_trie"](spark, SF))}
    assert got == {r["doc_id"]: (f"{fp:016x}", docs[c]["doc_id"]) for r, fp, c in zip(docs, fps, want)}


def test_simhash_odd_and_empty_rows(odd):
    got = rows(simhash_trie.near_duplicates(odd))
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert by[3] == by[4] == by[5] == [("0" * 16, 3)]           # null, empty and blank link like any other
    assert by[1][0] == by[2][0] and by[8] == by[9] and len(by[6]) == 2 and by[6][0] == by[6][1]
    assert by[None][0][1] is None
    none = simhash_trie.near_duplicates(odd.limit(0))
    assert none.columns == ["doc_id", "fingerprint", "component_id"] and none.count() == 0


def test_simhash_of_a_text_of_several_megabytes():
    rng = np.random.default_rng(2)
    text = " ".join(f"Wort{i}" for i in rng.integers(0, 5000, 200_000)) + "\n é ü\tende"
    h = simhash_trie.fingerprint(text.encode())
    w = lower(text).split()
    d = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(len(w) - 2)]
    ones = np.unpackbits(np.array(d, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=int)
    assert h == sum(1 << b for b in range(64) if 2 * ones[b] > len(d))


# ---- 12 ----------------------------------------------------------------------------------------

def ranked(docs, items, k=10):
    tf = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs if t is not None]
    tf = [(i, c) for i, c in tf if c]
    n_docs, n_terms = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item in sorted({i for i, _ in items}, key=lambda x: (x is None, x)):
        asked = {t for i, text in items if i == item for t in TERM.findall(lower(text))}
        scores = []
        for i, c in tf:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return out


def as_ranks(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(df)),
                  key=lambda x: (x[0] is None, x[0] or 0, x[1]))


@pytest.mark.parametrize("block_bytes", [4 << 20, 4000])
def test_lexical_search_equals_scoring_everything(spark, block_bytes):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = as_ranks(sparse_balls.search(docs.repartition(3), items, block_bytes=block_bytes))
    assert got == ranked([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])


def test_lexical_search_odd_and_empty_rows(spark, odd):
    asked = [(1, "the CAT, and the dog"), (1, "mat"), (2, None), (3, ""), (4, "é"), (None, "Hund lorem"), (5, "nowhere")]
    items = spark.createDataFrame([(i, t, "x") for i, t in asked], "item_id long, text string, score string")
    want = ranked([(r["doc_id"], r["text"]) for r in odd.collect()], asked)
    assert as_ranks(sparse_balls.search(odd, items)) == want and {w[0] for w in want} >= {1, 4, None}
    for d, q in ((odd.limit(0), items), (odd, items.limit(0)), (odd, items.where("item_id = 2"))):
        none = sparse_balls.search(d, q)
        assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0


def test_balls_bound_every_row_and_searches_leave_most_rows_out():
    rng = np.random.default_rng(5)
    terms, docs = 300, 3000
    at, term, value = [0], [], []
    for i in range(docs):                      # twenty topics with terms of their own
        t = np.unique(np.concatenate([rng.integers(0, 12, 3), 12 + (i % 20) * 14 + rng.integers(0, 14, 6)]))
        term.append(t)
        value.append(rng.integers(1, 10 ** 6, len(t)))
        at.append(at[-1] + len(t))
    at, term, value = np.array(at), np.concatenate(term), np.concatenate(value)
    w = np.where(np.arange(terms) < 12, 50, rng.integers(3000, 9000, terms))
    tree = sparse_balls.BallTree(at, term, value, np.sqrt(w.astype(float)))
    assert sorted(tree.rows.tolist()) == list(range(docs))
    full = np.zeros((docs, terms), np.int64)
    full[np.repeat(np.arange(docs), np.diff(at)), term] = value
    visited = 0
    for topic in range(20):
        own = np.unique(np.concatenate([rng.integers(0, 12, 3), 12 + topic * 14 + rng.integers(0, 14, 8)]))
        weight = np.zeros(terms, np.int64)
        weight[own] = w[own]
        scores, norm = full @ weight, math.sqrt(float(w[own].sum()))
        bounds = tree.bounds(own, norm)
        for (lo, hi, _), most in zip(tree.nodes, bounds):
            assert scores[tree.rows[lo:hi]].max() <= most
        first = sparse_balls.First(10)
        visited += tree.search(own, weight, norm, first, list(range(docs)))
        assert first.held == sorted((-int(s), False, i) for i, s in enumerate(scores) if s > 0)[:10]
    assert visited < 0.2 * 20 * docs, visited


def test_terms_of_a_long_text_are_those_of_its_pieces():
    text = ("Straße 4you ,;x_y " * 200_000).encode() + b"z" * (sparse_balls.SEGMENT + 5)
    got = Counter(t for part in sparse_balls.terms(text) for t in part)
    assert got == Counter(t.encode() for t in TERM.findall(lower(text.decode())))


# ---- 13 ----------------------------------------------------------------------------------------

def mined(vectors, anchors):
    def own(rs):
        out = []
        for i, v, label in rs:
            if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
                continue
            out.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
        return out

    base, out = own(vectors), []
    asked = {}
    for i, label, v in own(anchors):
        asked[i] = min(asked.get(i, (label, v)), (label, v))
    for a, (label, v) in asked.items():
        s = sorted((-sum(x * y for x, y in zip(v, c)), i, other) for i, other, c in base if i != a and len(c) == len(v))
        for p, i, _ in [x for x in s if x[2] == label][:5]:
            fits = [(q, j) for q, j, other in s if other != label and 30 * -p <= 100 * -q <= 90 * -p]
            out += [(a, i, r + 1, j, -p, -q) for r, (q, j) in enumerate(fits[:10])]
    return sorted(out)


def as_mined(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"])
                  for r in rows(df))


@pytest.mark.parametrize("p,n,q", [(1, 1, 1), (17, 33, 70), (100, 64, 300), (5, 64, 90), (64, 0, 3), (33, 65, 33)])
@pytest.mark.parametrize("cutoff", [1, 16])
def test_strassen_is_exact(p, n, q, cutoff):
    rng = np.random.default_rng(0)
    a, b = rng.integers(-2 ** 40, 2 ** 40, (p, n)), rng.integers(-2 ** 15, 2 ** 15, (q, n))
    assert (hard_negatives.strassen(a, b, cutoff) == a @ b.T).all()


@pytest.mark.parametrize("block_bytes", [8 << 20, 4000])
def test_hard_negatives_equal_scoring_everything(spark, block_bytes):
    vectors = table(spark, SF, "embeddings")
    got = as_mined(hard_negatives.mine(vectors.repartition(3), vectors.where("vec_id % 20 = 0"), block_bytes=block_bytes))
    plain = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    assert got == mined(plain, [r for r in plain if r[0] % 20 == 0]) and got


def test_hard_negatives_odd_and_empty_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 2), (2, [0.5, 0.1], 3), (2, [0.5, 0.1], 3), (3, None, 1), (4, [1.0, None], 1),
            (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [0.9, 0.2], 1), (8, [0.9, 0.3], None), (9, [1.0, 2.0, 3.0], 2),
            (None, [1.0, 1.0], 2), (10, [], 2), (11, [], 4), (12, [0.0, 0.0], 2), (100, [1.0, 0.2], 2), (100, [1.0, 0.1], 2),
            (200, [0.4, 0.4], 2), (300, [], 4)]
    d = spark.createDataFrame([(i, v, c, "x", 1) for i, v, c in data],
                              "vec_id long, embedding array<double>, label int, id string, score long")
    got = as_mined(hard_negatives.mine(d, d.where("vec_id % 100 = 0")))
    assert got == mined(data, [r for r in data if r[0] is not None and r[0] % 100 == 0]) and got
    for v, a in ((d.limit(0), d), (d, d.limit(0))):
        none = hard_negatives.mine(v, a)
        assert none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert none.count() == 0


def test_twins_of_the_new_queries_agree(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("op12_lexical_search", "op13_hard_negatives"):
        got = queries.QUERIES[name](spark, SF)
        want = con.execute(queries.SQL[name]).fetchall()
        columns = [c[0] for c in con.description]
        assert sorted(got.columns) == sorted(columns)
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)
