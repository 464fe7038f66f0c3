"""The pipeline against its operators' contracts on a small table."""

import hashlib
import re

from pyspark.sql import functions as F

import corpus_pipeline as C
from quantsilo.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_documents_and_take_effect(spark, components_of, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = {r["doc_id"] for r in out.collect()}
        if name == "pack":
            assert after == set(before)
            break
        assert out.columns == columns and after <= set(before)
        if name == "exact":
            best = {}
            for i, t in before.items():
                key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()
                best[key] = min(best.get(key, (0, 1 << 60)), (-len(t), i))
            assert after == {i for _, i in best.values()}
        elif name == "near":
            assert after == {i for i, (_, c) in components_of(before, 5, 80, 100).items() if c == i}
        else:
            assert len(after) > 0.8 * len(before)
        docs = out
    assert [n for n, _ in C.STAGES] == ["language", "toxicity", "exact", "near", "pack"]


def awkward(df):
    """Columns whose names clash with what stages add, or that parsers stumble over."""
    names = ["a.b", "__letters", "__text", "__stage_rejected", "__stage_row", "n_chars", "node", "tick`ed", "row"]
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names) if c not in df.columns])


def test_odd_and_empty_tables(spark, odd):
    for d in (odd, awkward(odd), awkward(odd).limit(0)):
        for name, stage in C.STAGES[:4]:
            out = stage(spark, d, SF)
            assert out.columns == d.columns
            ids = [r["doc_id"] for r in out.collect()]
            assert len(ids) <= d.count()
    assert sorted(r["doc_id"] or 0 for r in C.exact(spark, odd, SF).collect()) == [0, 2, 5, 6, 8, 10, 11, 12]


def test_rows_that_repeat_an_id_are_told_apart_by_their_texts(spark):
    long = " ".join(f"word{k}" for k in range(40))
    d = spark.createDataFrame([(1, long), (2, long + " more"), (2, "quite another text of its own, with words enough"),
                               (None, long + " else")], "doc_id long, text string")
    kept = sorted((r["doc_id"], r["text"][:5]) for r in C.near(spark, d, SF).collect())
    assert kept == [(1, "word0"), (2, "quite")]


def test_run_equals_its_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    got = C.run(spark, SF)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]        # how pieces are dealt to sequences is open
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, docs.select(cols).collect()))
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
