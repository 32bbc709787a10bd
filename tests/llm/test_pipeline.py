"""The pipeline's stages, each judged on its own input, and its whole run."""
import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from textlab.llm import pii, quality
from textlab.llm.queries import pii_key, vocabulary_path

from .test_neardup_quality import brute_components, variants

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], SCHEMA)


def test_stage_order_and_columns(spark):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_stages_against_brute_force(spark):
    texts = [t + " mail x.y@z.org" if i % 5 == 0 else t for i, t in enumerate(variants(seed=3, groups=6, copies=6, sizes=(20, 90, 300)))]
    texts += [None, "", "too short", "a b c d e " * 20, "card 4111111111111111 in a text of more than ten words in all it is"]
    docs = table(spark, texts)
    kept = {r["doc_id"] for r in quality.quality_verdicts(docs).collect() if r["kept"]}
    one = cp.quality_stage(spark, docs, SF)
    assert {r["doc_id"] for r in one.collect()} == kept and len(kept) > 20
    two = cp.near_dedup_stage(spark, one, SF)
    rows = [(i, texts[i]) for i in sorted(kept)]
    assert {r["doc_id"] for r in two.collect()} == set(brute_components(rows, 5, 80).values())
    three = cp.pii_stage(spark, two, SF)
    for r in three.collect():
        assert r["text"] == pii.replace_all(texts[r["doc_id"]], pii_key(spark))[0]
    text = {r["doc_id"]: r["text"] for r in three.collect()}
    t = tokenizers.Tokenizer.from_file(vocabulary_path())
    covered = {}
    for p in cp.packing_stage(spark, three, SF).collect():
        ids = t.encode(text[p["doc_id"]], add_special_tokens=False).ids + [0]
        assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"]:p["start"] + p["length"]], "<u4").tobytes())
        covered[p["doc_id"]] = covered.get(p["doc_id"], 0) + p["length"]
        assert p["doc_tokens"] == len(ids)
    assert covered == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in text.items()}


def test_null_ids_and_empty_input(spark):
    text = "a clean text of more than ten words that has no copy anywhere in the table"
    docs = spark.createDataFrame([(None, text, None, None, None), (1, "b " + text[::-1], "en", None, 3)], SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 2
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, SF) if stage is not cp.packing_stage else stage(spark, empty, SF)
        assert empty.collect() == []


def test_repeated_and_null_ids_are_decided_by_row(spark):
    clean = [f"the {w} text of more than ten words with {w} that nobody {w} copied from any {w} place" for w in ("red", "blue", "green")]
    rows = [(None, clean[0]), (None, "too short"), (None, None), (7, clean[1]), (7, "short too"), (None, clean[2])]
    got = cp.quality_stage(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA), SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(0, clean[0]), (7, clean[1]), (0, clean[2])])
    rows = [(None, clean[0]), (None, clean[0]), (9, clean[0]), (3, clean[0]), (None, clean[1]), (7, clean[2]), (7, clean[2]),
            (None, "alone here"), (None, "twice without an id"), (None, "twice without an id"), (7, "seven again")]
    got = cp.near_dedup_stage(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA), SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([
        (3, clean[0]), (0, clean[1]), (7, clean[2]), (0, "alone here"), (0, "twice without an id"), (7, "seven again")])


def test_run(spark):
    pieces = cp.run(spark, SF).collect()
    assert pieces and len({p["doc_id"] for p in pieces}) < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pseudonym_key_comes_from_the_session(spark, monkeypatch):
    from textlab.llm.queries import pii_key

    spark.conf.unset("spark.textlab.pii.secret")
    drawn = pii_key(spark)
    assert len(drawn) == 64 and pii_key(spark) == drawn  # kept for the session
    spark.conf.unset("spark.textlab.pii.secret")
    monkeypatch.setenv("TEXTLAB_PII_KEY", "from the environment")
    assert pii_key(spark) == b"from the environment"
    spark.conf.set("spark.textlab.pii.secret", "from the session")
    assert pii_key(spark) == b"from the session"
    spark.conf.unset("spark.textlab.pii.secret")
