"""The pipeline: its stages' columns, and each decision against a plain recomputation."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_jaccard import brute as near
from tests.llm.test_substrings import brute as repeats

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(12)
    vocabulary = ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(2, 9))) for _ in range(600)]
    passage = " ".join(draw.choices(vocabulary, k=65))
    docs, labels = [], []
    for i in range(220):
        words = draw.choices(vocabulary, k=draw.randrange(30, 150))
        good = i % 4 != 0
        if not good:
            words = [w.upper() + "!!" for w in words]
        text = " ".join(words)
        if i % 9 == 1:
            text += "\n" + passage
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(good), 0))
        if i % 10 == 1:
            docs.append((1_000 + i, text + " end", "en", "s0", len(text) + 4))
    docs.append((5_000, None, None, None, None))
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    before, after = None, docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in after.collect()]
        stage(spark, after, folder).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert after.columns == columns
        got = [tuple(r) for r in after.collect()]
        if number == 0:
            bad = [r for r in before if r[1] and r[1].split("\n")[0].isupper()]
            assert not set(bad) & set(got) and len(got) >= 0.95 * (len(before) - len(bad))
        if number == 1:
            stays = {doc for doc, _, first in near([(r[0], r[1]) for r in before], 5, 80, 100) if doc == first}
            assert sorted(got, key=repr) == sorted((r for r in before if r[0] in stays), key=repr)
            assert len(got) < len(before)
        if number == 2:
            rest = {doc: (n, kept) for doc, _, n, kept in repeats([(r[0], r[1]) for r in before], 50)}
            expected = [(r[0], rest[r[0]][1] if rest[r[0]][0] else r[1]) for r in before if rest[r[0]][1] or not rest[r[0]][0]]
            assert sorted((r[:2] for r in got), key=repr) == sorted(expected, key=repr)
            assert any(n for n, _ in rest.values())
        if number == 3:
            known = {r[0]: Counter(r[1].split()) for r in before if r[1]}
            assert all(not Counter(r[1].split()) - known[r[0]] for r in got)
            assert max(Counter(r[0] for r in got).values()) <= 3
        if number == 4:
            assert len(got) == len(before)


def in_turn(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, folder)
        assert number == 4 or made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
    return docs


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_run_equals_the_stages_in_turn(spark, folder, tmp_path):
    ran = rows_of(corpus_pipeline.run(spark, folder))
    assert ran == rows_of(in_turn(spark, folder, tmp_path)) and len(ran) > 50


def test_extra_columns_and_repeated_rows(spark, folder, tmp_path):
    """Columns named as those the stages use inside pass through; repeated rows stay repeated or go together."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = {c: F.lit(7) for c in ("key", "size", "taken", "own", "label", "score", "component_id", "n_removed", "packed")}
    again = docs.filter("doc_id % 20 = 3")
    more = spark.createDataFrame([(7_000, "", "en", "s9", 0), (None, "w " * 30, None, None, 0)], COLUMNS)
    docs.union(again).union(more).withColumns(extra).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    ran = rows_of(corpus_pipeline.run(spark, str(tmp_path)))
    assert ran == rows_of(in_turn(spark, str(tmp_path), tmp_path / "stages")) and len(ran) > 50
    assert max(Counter(r[0] for r in ran).values()) <= 6 and 7_000 not in {r[0] for r in ran}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
