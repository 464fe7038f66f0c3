"""Training-data operators against brute-force versions, round trips and held-out accuracy."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quantsilo.llm import (bpe, chat_windows, content_sort, langid_zstd, license_scan, lm_scoring, ngram_join, packing,
                           queries, toxicity, vptree)
from quantsilo.llm.common import fold, table

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def empty(df):
    return df.limit(0)


# ---- 1 -----------------------------------------------------------------------------------------

def test_lm_base_scores_are_exact_and_model_is_better(spark, docs):
    got = {r["doc_id"]: r for r in rows(queries.QUERIES["op1_lm_scoring"](spark, SF))}
    texts = {r["doc_id"]: WORDS.findall(lower(r["text"])) + [None] for r in rows(docs.select("doc_id", "text"))}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in texts.items() if not out[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        g = got[i]
        assert (g["held_out"], g["n_tokens"], g["train_tokens"]) == (out[i], len(t), n)
        assert g["n_known"] == sum(w in c for w in t)
        assert g["base_score"] == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    held = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_lm_probabilities_add_up_to_one():
    voc = lm_scoring.Vocabulary(np.arange(1, 6, dtype=np.uint64) << np.uint64(8), np.arange(5) + 1, 100, 20,
                                np.ones(lm_scoring.GROUPS), np.ones(lm_scoring.GROUPS))
    m = lm_scoring.LogBilinear(voc)
    z = m.normalisers()
    w = np.arange(voc.size)
    p = np.exp(m.log_probabilities(np.full(voc.size, 2), np.full(voc.size, 3), w, z))
    assert p.sum() == pytest.approx(1, abs=1e-5)


def test_lm_learns_from_every_target(spark, monkeypatch):
    made, inner = [], lm_scoring._trained

    def trained(*args):
        made.append((args[1], inner(*args)))
        return made[-1][1]

    monkeypatch.setattr(lm_scoring, "_trained", trained)
    pairs = spark.createDataFrame([(i, f"left{i} right{i}") for i in range(300)], "doc_id long, text string")
    assert lm_scoring.score(pairs, F.lit(True)).count() == 300
    voc, m = made[0]
    moved = np.abs(m.p["R"] - lm_scoring.LogBilinear(voc).p["R"]).max(1) > 1e-6
    assert len(voc.top) == 601 and moved[:601][voc.top != lm_scoring.END].all()


def test_lm_odd_rows(odd):
    got = rows(lm_scoring.score(odd, fold("doc_id", 7) != 2))
    assert len(got) == odd.count() and all(np.isfinite(r["score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert rows(lm_scoring.score(empty(odd), F.lit(True))) == []


# ---- 2 -----------------------------------------------------------------------------------------

def test_toxicity_learns_and_takes_odd_rows(spark, odd):
    d, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    m = toxicity.train(d, labels, fold("doc_id", 5) != 0)
    got = rows(toxicity.score(d, m).join(labels, "doc_id").where(fold("doc_id", 5) == 0))
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.9
    assert not any(r["predicted"] for r in got if r["toxic"] == 0)
    s = rows(toxicity.score(odd, m, keep=("doc_id", "score"), prefix="p_"))
    assert len(s) == odd.count() and all(0 <= r["p_score"] <= 1 for r in s)
    none = toxicity.train(odd, empty(labels), F.lit(True))
    assert {r["score"] for r in rows(toxicity.score(odd, none))} == {0.0}


def plain_ngrams(text, sizes, buckets):
    """The n-gram buckets of a text, one n-gram at a time, in Python integers."""
    mask = (1 << 64) - 1

    def mixed(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    letter = [mixed(((b + 32 if 65 <= b <= 90 else b) * 0x9E3779B97F4A7C15 + 1) & mask) for b in range(256)]
    raw, found = text.encode(), set()
    for n in sizes:
        for i in range(len(raw) - n + 1):
            h = 0
            for b in raw[i:i + n]:
                h = (h * 0x100000001B3 + letter[b]) & mask
            found.add((mixed(h) >> 7) % buckets)
    return found


def test_toxicity_scores_equal_a_plain_sum_of_weights(spark, docs):
    model = toxicity.train(docs, table(spark, SF, "labels"), fold("doc_id", 5) != 0)
    got = {r["doc_id"]: r for r in rows(toxicity.score(docs, model))}
    for r in rows(docs.orderBy("doc_id").limit(25)):
        z = model.bias + sum(float(model.weights[f]) for f in plain_ngrams(r["text"] or "", model.ngrams, len(model.weights)))
        want = 1 / (1 + np.exp(-z))
        assert got[r["doc_id"]]["score"] == pytest.approx(want, abs=1e-5)
        assert got[r["doc_id"]]["predicted"] == (want >= 0.5)


def test_toxicity_takes_any_labels_and_repeated_ids(spark, docs):
    labels = table(spark, SF, "labels")
    a = toxicity.train(docs, labels, fold("doc_id", 5) != 0)
    odd = labels.select("doc_id", (F.col("toxic") * 2).alias("toxic")).unionByName(labels.select("doc_id", "toxic"))
    b = toxicity.train(docs.unionByName(docs), odd, fold("doc_id", 5) != 0)
    assert (a.weights == b.weights).all() and a.bias == b.bias
    none = toxicity.train(docs, labels.withColumn("toxic", F.lit(None).cast("int")), fold("doc_id", 5) != 0)
    assert none.score(np.frombuffer(b"anything", np.uint8)) == 0.0


def plain_langid(samples, text):
    """The language whose dictionary makes the text smallest, with zstandard's plain calls."""
    import zstandard as zstd

    raw = f" {text} ".encode()
    n = max(1, (len(raw) + langid_zstd.BLOCK // 2) // langid_zstd.BLOCK)
    pieces = [raw[len(raw) * k // n:len(raw) * (k + 1) // n] for k in range(n)]

    def size(sample, level):
        d = zstd.ZstdCompressionDict(sample, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        c = zstd.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(c.compress(p)) for p in pieces)

    sizes = {x: size(s, langid_zstd.LEVEL) for x, s in samples.items()}
    if len(set(sorted(sizes.values())[:2])) == 1:
        step = {x: -(-len(s) // langid_zstd.PARTS) for x, s in samples.items()}
        for x, s in samples.items():
            sizes[x] += size(s, langid_zstd.SLOW_LEVEL) + sum(
                size(s[k * step[x]:(k + 1) * step[x]], langid_zstd.LEVEL) for k in range(langid_zstd.PARTS))
    best = min(sizes, key=sizes.get)
    return best, 1 - sizes[best] / min(v for x, v in sizes.items() if x != best)


def test_langid_equals_plain_compression(spark, docs):
    model = langid_zstd.train(docs, fold("doc_id", 4) != 2)
    assert all(len(s) <= langid_zstd.DICT_BYTES and model.used[x] > 3 for x, s in model.samples.items())
    some = docs.orderBy("doc_id").limit(60).select("doc_id", langid_zstd.letters(F.col("text")).alias("l"))
    text = {r["doc_id"]: r["l"] for r in some.collect()}
    got = {r["doc_id"]: r for r in rows(langid_zstd.classify(docs, model, keep=("doc_id",)))}
    for i, t in text.items():
        if t:
            lang, margin = plain_langid(model.samples, t)
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == (
                lang, pytest.approx(margin), margin < langid_zstd.MIN_MARGIN)


# ---- 3 -----------------------------------------------------------------------------------------

def check_pieces(got, texts):
    tok = Tokenizer.from_file(packing.TOKENIZER)
    tok.encode_special_tokens = True
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    seen, seqs = defaultdict(int), defaultdict(list)
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]] += r["length"]
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    return seen, {i: len(x) for i, x in ids.items()}, [sum(n for _, n in s) for s in seqs.values()]


def test_packing(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in rows(docs.select("doc_id", "text"))}
    seen, want, sizes = check_pieces(rows(packing.pack(docs, rank_rows=20)), texts)
    assert seen == want
    assert sum(sizes) / sum(packing.padded(n) for n in sizes) > 0.95


def test_packing_odd_rows(odd):
    got = rows(packing.pack(odd))
    n = sum(r["length"] for r in got if r["doc_id"] == 6)
    assert n == 2 * next(r["doc_tokens"] for r in got if r["doc_id"] == 6)
    assert [r["length"] for r in got if r["doc_id"] in (3, 4)] == [1, 1]
    assert rows(packing.pack(empty(odd))) == []


def test_column_generation_meets_every_count():
    rng = np.random.default_rng(3)
    for n in (1, 40, 700):
        size, count = np.unique(rng.integers(1, 1025, n), return_counts=True)
        made = Counter()
        for p in packing.patterns(dict(zip(size.tolist(), count.tolist()))):
            assert p.total <= 1024
            made.update({k: v * p.copies for k, v in p.items.items()})
        assert made == dict(zip(size.tolist(), count.tolist()))


# ---- 4 -----------------------------------------------------------------------------------------

def test_content_sort_odd_rows(odd):
    got = rows(content_sort.content_sort(odd))
    by = defaultdict(list)
    for r in got:
        by[r["text_sha256"]].append(r)
    assert len(got) == odd.count()
    assert all(sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)} for g in by.values())
    keep = {r["doc_id"]: r["keep_id"] for r in got}
    assert keep[1] == 2 and keep[8] == keep[9] == 8 and keep[3] == keep[4] == 5 and keep[None] is None
    assert rows(content_sort.content_sort(empty(odd))) == []


def test_content_sort_group_over_many_partitions(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"),
                                 F.when(F.col("id") % 3 > 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    got = rows(content_sort.content_sort(d))
    assert sum(r["kept"] for r in got) == 1001
    assert {(r["keep_id"], r["group_size"]) for r in got if r["doc_id"] % 3} == {(1, 2000)}


# ---- 5 -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("budget,history", [(512, 128), (60, 30), (40, 0)])
def test_chat_windows_read_back(spark, budget, history):
    turns = table(spark, SF, "conversations").unionByName(spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "a\\<s>\\\\[INST] "), (None, 0, "system", "s"),
         (None, None, None, None), (None, 1, "assistant", "")], "conv_id long, turn long, role string, text string"))
    w = chat_windows.format_windows(turns, budget, history)
    got = {r["conv_id"]: r for r in rows(chat_windows.read_back(w))}
    want = defaultdict(list)
    for r in rows(turns):
        want[r["conv_id"]].append((r["turn"] if r["turn"] is not None else -1, r["role"] or "", r["text"] or ""))
    assert set(got) == set(want)
    for k, t in want.items():
        t.sort()
        loss = "".join(x for _, role, x in t if role == "assistant")
        assert got[k]["n_turns"] == len(t)
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in t).encode()).hexdigest()
        assert (got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert rows(chat_windows.read_back(chat_windows.format_windows(empty(turns)))) == []
    # within the budget, unless the system turn and one new turn are more
    enc = bpe.encoding()
    for r in rows(w):
        size = [chat_windows.TURN_TOKENS + len(bpe.encode(enc, t)) for _, t in chat_windows.parse(r["text"])]
        system = size[0] if r["n_repeated"] and chat_windows.parse(r["text"])[0][0] == "system" else 0
        alone = len(size) - r["n_repeated"] == 1
        assert sum(size) <= budget or alone and sum(size) == system + size[-1], (budget, size)


def test_chat_windows_leave_room_for_a_long_system_turn(spark):
    turns = [(1, 0, "system", "be kind " * 60)] + [(1, k, ("user", "assistant")[k % 2], f"word {k} " * 12) for k in range(1, 60)]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    enc = bpe.encoding()
    w = rows(chat_windows.format_windows(d.repartition(5), 400, 64))
    sizes = [sum(chat_windows.TURN_TOKENS + len(bpe.encode(enc, t)) for _, t in chat_windows.parse(r["text"])) for r in w]
    assert len(w) > 3 and max(sizes) <= 400
    assert all(chat_windows.parse(r["text"])[0][0] == "system" for r in w) and sum(r["n_repeated"] > 1 for r in w) > 2


def test_escape_is_reversible_and_hides_control_strings():
    for t in ("</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<<s>>", "a\\</s>", "[INST][/INST]", "plain < text ["):
        e = chat_windows.escape(t)
        assert chat_windows.unescape(e) == t
        assert not any(c in e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


# ---- 6 -----------------------------------------------------------------------------------------

def test_bpe_equals_whole_texts(docs, odd):
    enc = bpe.encoding()
    texts = [r["text"] or "" for r in rows(docs.select("text"))] + ["a  b \n c  d\x1c e", "x" * 300, " ", ""]
    for t in texts:
        ids = enc.encode_ordinary(t)
        assert bpe.encode(enc, t, size=7) == ids and bpe.decode(enc, ids) == t.encode()
    got = rows(bpe.round_trip(odd))
    want = Counter(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in rows(odd))
    assert Counter(r["decoded_sha256"] for r in got) == want
    assert rows(bpe.round_trip(empty(odd))) == []
    assert {r["doc_id"]: len(r["ids"]) for r in rows(bpe.encode_texts(odd))}[3] == 0


def test_word_encoder_equals_tokenizers(docs):
    texts = [r["text"] for r in rows(docs.select("text"))] + ["a  b\n c", "  x", "", " ", "<|endoftext|> y"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    assert packing.WordEncoder(memory=50).encode(texts) == [
        np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_rank_encoder_equals_tokenizers(docs):
    texts = [r["text"] for r in rows(docs.select("text"))] + [
        "a  b\n c", "  x", "", " ", "<|endoftext|> y", "x" * 200_000, " \n" * 70_000 + "y", "x" + " " * 1_500_000,
        *(f"a{chr(c)}b 1{chr(c)}2 .{chr(c)}. {chr(c)} {chr(c)}{chr(c)}x '{chr(c)}s" for c in
          [*range(0x3100), *range(0x4E00, 0x4F00), *range(0xFB00, 0x10100), *range(0x1F300, 0x1F400)])]
    tok = Tokenizer.from_file(packing.TOKENIZER)
    tok.encode_special_tokens = True
    enc = packing.encoder()
    assert isinstance(enc, packing.RankEncoder)
    assert enc.encode(texts) == [
        np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_tasks_of_one_worker_share_an_encoder(odd, monkeypatch):
    made, ranks = [], packing.merge_ranks
    monkeypatch.setattr(packing, "merge_ranks", lambda path: made.append(path) or ranks(path))
    monkeypatch.setattr(packing, "_ENCODERS", {})
    with monkeypatch.context() as m:
        m.setattr(type(odd), "mapInArrow", lambda self, run, schema: run)
        sent = cloudpickle.dumps(packing.tokenise(odd))
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "t": ["a text", ""]})
    got = [[b.to_pydict() for b in cloudpickle.loads(sent)(iter([batch]))] for _ in range(3)]
    assert got[0] == got[1] == got[2] and got[0][0]["doc_tokens"] == [3, 1]
    assert made == [packing.TOKENIZER]


@pytest.mark.parametrize("change", [
    lambda s: s["model"]["merges"].reverse(), lambda s: s["model"].update(dropout=0.1),
    lambda s: s["pre_tokenizer"].update(add_prefix_space=True), lambda s: s.update(normalizer={"type": "NFC"})])
def test_other_tokenizers_are_not_said_by_ranks(tmp_path, change):
    with open(packing.TOKENIZER, encoding="utf-8") as f:
        spec = json.load(f)
    change(spec)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    assert packing.merge_ranks(str(path)) is None


# ---- 7 -----------------------------------------------------------------------------------------

def test_vptree_is_exact_and_relaxes(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 8))
    x[100:350] = x[100]                                  # one vector many times
    data = [(i, v.tolist(), "z") for i, v in enumerate(x)] + [(900, None, "z"), (901, [0.0] * 8, "z"),
                                                              (902, [float("nan")] * 8, "z"), (903, [1.0, 2.0], "z"),
                                                              (None, [1.0] * 8, "z")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, rank string")
    asked = df.where("vec_id % 50 = 0")
    got = defaultdict(list)
    for r in sorted(rows(vptree.nearest(df, asked, 10, shard_rows=150, query_rows=4)), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    for q in range(0, 700, 50):
        d = vptree.distances(x[q:q + 1], x)[0]
        assert got[q] == sorted((d[i], i) for i in range(700) if i != q)[:10]
    assert rows(vptree.nearest(empty(df), asked)) == []
    ids = np.arange(700)
    tree = vptree.VPTree(ids, x)
    exact, near = (tree.search(ids[:100], x[:100], 10, f)[1] for f in (1.0, 1.3))
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, near)]) >= 0.9


def test_vptree_no_copy_of_the_queries_for_each_shard(spark):
    x = np.random.default_rng(1).normal(size=(600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = vptree.nearest(df, df.where("vec_id % 10 = 0"), 10, shard_rows=20, query_rows=30)
    plan = found._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan
    got = defaultdict(list)
    for r in sorted(rows(found), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    for q in range(0, 600, 10):
        d = vptree.distances(x[q:q + 1], x)[0]
        assert got[q] == sorted((d[i], i) for i in range(600) if i != q)[:10]


def _odd_vectors(kind: str, x: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(7)
    if kind == "copies":
        x[50:300] = x[50]
    return {"grid": np.round(x * 2), "far off": x * 1e-9 + 1e3, "clusters": np.round(x[rng.integers(0, 9, len(x))] * 50) + x * 1e-7,
            "squares overflow": x * 1e200, "squares vanish": x * 1e-162, "all squares vanish": x * 1e-170,
            "all sizes": x * 10.0 ** rng.integers(-200, 200, size=(len(x), 1))}.get(kind, x)


@pytest.mark.parametrize("kind", ["plain", "copies", "grid", "far off", "clusters", "squares overflow", "squares vanish",
                                  "all squares vanish", "all sizes"])
@pytest.mark.parametrize("shard, leaf", [(90, 12), (400, 400), (7, 512)])
@pytest.mark.filterwarnings("ignore:overflow", "ignore:invalid")
def test_vptree_carries_the_nearest_from_tree_to_tree(kind, shard, leaf):
    rng = np.random.default_rng(3)
    x = _odd_vectors(kind, rng.normal(size=(400, 8)))
    ids = np.arange(400) // 2                            # an id twice: both are candidates
    near = vptree.Nearest(40, 10)
    for at in np.split(rng.permutation(400), range(shard, 400, shard)):
        vptree.VPTree(ids[at], x[at], leaf).search(ids[:40], x[:40], 10, found=near)
    near.settle()
    d = vptree.distances(x[:40], x)
    for q in range(40):
        want = sorted((d[q, i], ids[i]) for i in range(400) if ids[i] != ids[q])[:10]
        assert list(zip(near.d[q], near.i[q])) == want


# ---- 8 -----------------------------------------------------------------------------------------

def test_langid_held_out_accuracy_and_odd_rows(spark, odd):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    m = langid_zstd.train(d, fold("doc_id", 4) != 2)
    got = rows(langid_zstd.classify(d.where(fold("doc_id", 4) == 2), m, keep=("doc_id", "lang")))
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert sum(r["rejected"] for r in got) <= 2
    s = rows(langid_zstd.classify(odd, m, keep=("doc_id", "score"), prefix="p_"))
    assert {r["doc_id"] for r in s if r["p_lang_pred"] == "und"} == {3, 4, 5, 12}
    nothing = langid_zstd.train(empty(d), F.lit(True))
    assert {r["lang_pred"] for r in rows(langid_zstd.classify(odd, nothing))} == {"und"}


@pytest.mark.parametrize("size", [1 << 17, 1 << 20, 1 << 22])
def test_langid_keeps_long_clean_texts(spark, size):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    m = langid_zstd.train(d, fold("doc_id", 4) != 2)
    held = defaultdict(list)
    for r in rows(d.where(fold("doc_id", 4) == 2).select("lang", "doc_id", langid_zstd.letters(F.col("text")).alias("t"))
                  .orderBy("doc_id")):
        held[r["lang"]] += r["t"].split()
    assert len(held) == 4
    rng = random.Random(11)
    for lang, words in held.items():
        runs = [" ".join(words[k:k + 12]) for k in range(0, len(words), 12)]
        text = ""
        while len(text) < size:
            text += " ".join(rng.sample(runs, len(runs))) + " "
        got, margin, rejected = m.classify(text.strip())
        assert (got, rejected) == (lang, False), (lang, size, margin)


# ---- 9 -----------------------------------------------------------------------------------------

def near_copies(seed=5):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 500, 120)]
    texts = {}
    for i in range(90):                  # copies of copies with a few changed words, and some others
        src = base if i % 3 else [f"v{k}" for k in rng.integers(0, 60, int(rng.integers(1, 40)))]
        t = list(src)
        for k in rng.integers(0, len(t), int(rng.integers(0, 5))):
            t[k] = f"x{rng.integers(0, 8)}"
        texts[i] = " ".join(t)
        base = t if i % 7 == 1 else base
    return texts


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80), (2, 60)])
def test_ngram_join_equals_all_pairs(spark, components_of, words, num):
    texts = near_copies()
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(ngram_join.jaccard_components(d, words, num, 100))}
    assert got == components_of(texts, words, num, 100)


def test_ngram_join_meets_a_pair_once(spark):
    # shingles 0, 10, ... shared by both, 3 more of each between them; other nodes share one shingle only
    held = {1: [*range(0, 200, 10), *range(1, 200, 2)], 2: [*range(0, 200, 10), *range(2, 200, 4)], 3: [150], 4: [150]}
    held = {node: sorted(set(tokens)) for node, tokens in held.items()}
    times = Counter(t for tokens in held.values() for t in tokens)
    rest = spark.createDataFrame([(t, node, len(tokens), p, node, 0) for node, tokens in held.items()
                                  for p, t in enumerate(tokens) if times[t] > 1],
                                 "token long, node long, n long, p long, comp long, main long")
    met = Counter((r["a"], r["b"]) for r in rows(ngram_join._meetings(
        ngram_join._with_before(rest), lambda n, p, m, q: F.lit(True)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))))
    assert met == {(a, b): 1 for a in held for b in held if a < b}


def test_ngram_join_odd_rows(odd):
    got = rows(ngram_join.jaccard_components(odd))
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert len(got) == odd.count()
    assert by[2] == (by[1][0], 1) and by[9][1] == 8 and by[3] == (0, 3) and by[5] == (0, 5) and by[11] == (1, 11)
    assert rows(ngram_join.jaccard_components(empty(odd))) == []


# ---- 10 ----------------------------------------------------------------------------------------

def test_license_base_equals_brute_force(docs, odd):
    texts = {r["doc_id"]: r["text"] for r in rows(docs.select("doc_id", "text"))}
    got = {r["doc_id"]: r for r in rows(license_scan.scan(docs))}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, t in texts.items():
        w = word.findall(lower(t))
        at = [(k, lab) for p, lab in license_scan.BASE for k in range(len(w)) if tuple(w[k:k + len(p)]) == p]
        g = got[i]
        assert (g["n_words"], g["n_base"]) == (len(w), len(at))
        assert (g["first_word"], g["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert g["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert {*filter(None, g["base_labels"].split(","))} <= {*g["labels"].split(",")}
    assert {r["doc_id"]: r["labels"] for r in rows(license_scan.scan(odd))}[10] == "mit"
    assert rows(license_scan.scan(empty(odd))) == []


def test_license_rules_settle_by_priority():
    assert len(license_scan.RULES) >= 200
    s = license_scan.Scanner()
    found = lambda t: [r.label for *_, r in s.detect(t.lower())]
    assert found("SPDX-License-Identifier: Apache-2.0") == ["apache-2.0"]
    assert found("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]
    assert found("under the GNU General Public License, version 3") == ["gpl-3.0"]
    assert found("see https://creativecommons.org/licenses/by-nc/4.0/ and the MIT license") == ["cc-by-nc-4.0", "mit"]
    assert found("the cat sat on the mat") == []
    for r in license_scan.RULES:
        assert r.keyword and " " not in r.keyword


#: A usual spelling of every license and phrase, in the order of the rules.
NAMES = """MIT|MIT No Attribution|Apache License 1.0|Apache Software License, Version 1.1|Apache License v.2.0
GNU General Public License, version 1|GNU General Public License v.2|General Public License 3.0
GNU Library General Public License v2|GNU Lesser General Public License v 2.1|GNU Lesser General Public License 3
GNU Affero General Public License v. 3|GNU Free Documentation License 1.3|BSD 2-Clause|New BSD|4-Clause BSD|Zero-Clause BSD
ISC|Mozilla Public License 1.1|Mozilla Public License v.2.0|Eclipse Public License v 1.0|Eclipse Public License 2.0
Eclipse Distribution License|Common Development and Distribution License 1.0
Common Development and Distribution License v.1.1|Common Public License 1.0|European Union Public License 1.1
European Union Public Licence v.1.2|Artistic License 1.0|Artistic License v2.0|Boost Software License 1.0
Business Source License 1.1|zlib/libpng|libpng|The Unlicense|Do What The Fuck You Want To Public License|PostgreSQL
Python Software Foundation|PHP License 3.01|Ruby|University of Illinois/NCSA Open Source|Microsoft Public License
Microsoft Reciprocal License|Open Software License v.3.0|Academic Free License 3.0|Educational Community License v. 2.0
Universal Permissive License 1.0|SIL Open Font License 1.1|Blue Oak Model License 1.0.0
Mulan Permissive Software License v2|Server Side Public License v1|Elastic License 2.0|PolyForm Noncommercial License
CC0 1.0|CC BY 3.0|CC-BY-4.0|CC BY-SA 3.0|CC BY-SA 4.0|CC BY-NC 3.0|CC BY-NC 4.0|CC BY-ND 4.0|CC BY-NC-SA 4.0|CC BY-NC-ND 4.0
Open Database License|Open Data Commons Attribution License|Open Data Commons Public Domain Dedication
CreativeML OpenRAIL-M|Vim|OpenSSL|curl""".replace("\n", "|").split("|")
PHRASES = """Apache Software License|GNU General Public License|GNU GPL3|GPLv3+|GNU Lesser General Public License
Mozilla Public License|Eclipse Public License|BSD-style license|MIT-style license|Creative Commons Zero License
Creative Commons Attribution 4.0|Creative Commons Attribution-ShareAlike 4.0|Creative Commons Attribution NonCommercial 4.0
Creative Commons Attribution-NoDerivatives 4.0|this work is in the public domain|All rights reserved
proprietary and confidential|unauthorized copying|copyright ©2020|© 2020
Permission is hereby granted, free of charge, to any person obtaining a copy
Permission to use, copy, modify, and/or distribute this software for any purpose
Redistribution and use in source and binary forms, with or without modification
you may not use this file except in compliance with the License|This Source Code Form is subject to the terms of the Mozilla Public
This program is free software; you can redistribute it|This library is free software; you can redistribute it
This software is provided 'as-is', without any express or implied warranty
This is free and unencumbered software released into the public domain
Permission is hereby granted, free of charge, to any person or organization obtaining a copy
To the extent possible under law, somebody has waived all copyright""".replace("\n", "|").split("|")


def test_license_rules_find_usual_spellings():
    s = license_scan.Scanner()
    found = lambda t: [r.label for *_, r in s.detect(t.lower())]
    assert (len(NAMES), len(PHRASES)) == (len(license_scan.LICENSES), len(license_scan.PHRASES))
    used, wrong = set(), []
    for (label, spdx, _, _, link), name in zip(license_scan.LICENSES, NAMES):
        plain = [re.sub(r"\\S\*|\w\?|-\?", "", re.sub(r"\(\?:([^|)]*)[^)]*\)\??", r"\1", x).replace(r"\d", "3"))
                 .replace("\\", "") for x in (spdx, link)]
        alone = name if re.search(r"\blicen[sc]e", name.lower()) else f"{name} license"
        for text in (f"SPDX-License-Identifier: {plain[0]}", alone, f"{name}.\n{alone}", f"Licensed under the {name}.",
                     f"see https://{plain[1]}"):
            if label not in found(text) or text == alone and set(found(text)) != {label}:
                wrong.append((label, text, found(text)))
            used |= {r for *_, r in s.detect(text.lower())}
    for (label, *_), text in zip(license_scan.PHRASES, PHRASES):
        if label not in found(text):
            wrong.append((label, text, found(text)))
        used |= {r for *_, r in s.detect(text.lower())}
    assert not wrong
    assert [r for r in license_scan.RULES if r not in used] == []
    assert found("openrail license") == ["openrail"]
    assert found("the apache license, 2004") == ["apache"] and found("apache license 2.1") == ["apache"]
