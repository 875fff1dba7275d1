"""The stages against plain loops, on a small corpus; this file goes with corpus_pipeline.py."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from framewright.llm.decontaminate import Matcher  # noqa: E402

from .test_line_dedup import brute as dedup_brute  # noqa: E402
from .test_ngram_join import brute as join_brute  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(6)]
    passage, docs, labels = " ".join(word() for _ in range(60)), [], []
    for i in range(260):
        lines = [" ".join(word() for _ in range(rng.randrange(3, 30))) for _ in range(rng.randrange(1, 6))]
        toxic = i % 11 == 0
        if toxic:
            lines.append("you vilefoo crudbar " + word())
        if i % 7 == 1:
            lines.append(passage)
        if i % 13 == 2:
            lines.append(f"{word()} {rng.choice(items)[1].upper()} {word()}")
        if i % 10 == 3 and docs:
            lines = docs[-1][1].split("\n")
            lines[-1] += " " + word()
            toxic = bool(labels[-1][2])
        docs.append((i, "\n".join(lines), "en", f"s{i % 3 // 2}", 0))
        labels.append((i, 1, int(toxic)))
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs + [(999, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items, {i: t for i, _, t in labels}


def test_stages(spark, corpus, tmp_path):
    path, items, toxic = corpus
    docs, rows = spark.read.parquet(f"{path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == COLUMNS, name
            rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if k == 0:
            gone = {i for i, _ in before} - {i for i, _ in rows}
            assert gone == {i for i, t in toxic.items() if t}
        elif k == 1:
            want = {i: t for i, t in dedup_brute(before).items() if t.strip() or t == dict(before)[i]}
            assert dict(rows) == want | {999: None}
        elif k == 2:
            want = {i for i, _, c in join_brute(before, 5, 80, 100) if c == i}
            assert {i for i, _ in rows} == want and len(want) < len(before)
        elif k == 3:
            matcher = Matcher(items)
            assert {i for i, _ in rows} == {i for i, t in before if not matcher.find(t)} != {i for i, _ in before}
    pieces = docs.collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in rows}
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    again = corpus_pipeline.run(spark, path)
    assert again.columns == docs.columns and again.count() >= len({p.doc_id for p in pieces})


def tables(spark, path, docs, labels=(), items=()):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "'clash' n", "'clash' kept", "'clash' p_bad", "'clash' removed_lines", "'clash' digest", "'clash' body")


def test_rows_are_known_by_id_and_text(spark, tmp_path):
    """One id with two texts is two documents; repeated rows are one; nulls and empty texts are near to nothing else."""
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = [(0, text), (1, text), (1, other), (5, "some words here"), (5, "some words here"), (6, None), (6, None), (6, ""), (7, ""), (None, text + " x"), (None, None)]
    df = tables(spark, tmp_path, docs)
    got = corpus_pipeline.ngram_jaccard_join(spark, df, str(tmp_path))
    assert got.columns == df.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [
        (None, text + " x"), (1, other), (5, "some words here"), (6, None), (6, ""), (7, ""), (None, None)]))


def test_hard_cases(spark, tmp_path):
    """Nulls, repeats, an empty table and extra columns, through every stage."""
    docs = [(None, None), (1, ""), (1, ""), (2, "word " * 30_000), (3, "a b c"), (3, "a b c"), (4, " \n\n "), (5, "x" * 5_000)]
    df = tables(spark, tmp_path / "a", docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, df, str(tmp_path / "a"))
        assert got.columns == [c for c in df.columns], name
        assert 0 < got.count() <= len(docs) and stage(spark, df.limit(0), str(tmp_path / "a")).count() == 0
    got = corpus_pipeline.packing(spark, df, str(tmp_path / "a")).collect()
    assert sum(p.length for p in got) == sum(p.doc_tokens for p in got if p.start == 0) and sum(p.start == 0 for p in got) == len(docs)
    assert corpus_pipeline.packing(spark, df.limit(0), str(tmp_path / "a")).count() == 0
