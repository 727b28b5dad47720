"""The pipeline's stages against brute-force versions of their decisions, and the registered SQL."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from eligo.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import brute_components, brute_fingerprint, docs_frame, sentence
from tests.llm.test_dedup import _brute_lines
from tests.llm.test_text_ops import _brute_hits

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _tables(spark, folder):
    rng = random.Random(8)
    items = [(i, sentence(rng, 14)) for i in range(4)]
    notice = "this notice is carried by every site"
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randint(15, 60))] + ([notice] if i % 2 else []) + ([items[i % 4][1]] if i % 9 == 0 else [])
        rows.append((i, "\n".join(parts), "en", f"s{i % 12}"))
    rows += [(100 + i, rows[i][1], "en", "s1") for i in range(0, 60, 7)]
    rows += [(200, None, "en", "s"), (201, "", None, "s"), (202, "123 456", "en", "s"), (203, notice, "en", "s3"), rows[4]]
    docs = docs_frame(spark, rows).selectExpr("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_pipeline_matches_brute_force(spark, tmp_dir):
    folder = f"{tmp_dir}/in"
    rows, items = _tables(spark, folder)
    packed = corpus_pipeline.run(spark, folder).collect()
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    cut = [(r[0], t, *r[2:]) for r, (_, t, _, gone) in zip(kept, _brute_lines(kept, 10), strict=True)
           if not gone or t.strip()]
    comp = brute_components([brute_fingerprint(t) for _, t, *_ in cut], lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, *_), c in zip(cut, comp, strict=True):
        least[c] = min(least.get(c, i), i)
    one = {i: t for (i, t, *_), c in zip(cut, comp, strict=True) if least[c] == i}
    clean = {i for i, t in one.items() if not _brute_hits(t, items, 10)[1]}
    assert {r.doc_id for r in packed} == clean and 0 < len(clean) < len(one) < len(cut) < len(rows)
    assert len([r for r in packed if r.piece == 0]) == len(clean)


def test_stages_keep_the_columns_and_take_nothing(spark, tmp_dir):
    folder = f"{tmp_dir}/empty"
    _tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_dedup", "decontaminate", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), folder)
        assert out.count() == 0
        if name != "packing":
            assert out.dtypes == docs.dtypes


def test_short_boilerplate_lines_are_cut(spark, tmp_dir):
    rows = [(i, f"And ornd.\nown text of document {i}\n\n}}", "en", f"s{i % 11}") for i in range(30)]
    docs = docs_frame(spark, rows).selectExpr("doc_id", "text", "lang", "source", "n_chars")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, tmp_dir).collect()}
    assert got == {i: t for i, t, *_ in _brute_lines(rows, 10, 1)}
    assert got[0] == rows[0][1] and got[7] == "own text of document 7\n"


def test_verdicts_fall_on_rows_not_on_ids(spark, tmp_dir):
    folder = f"{tmp_dir}/ids"
    _, items = _tables(spark, folder)
    rng = random.Random(4)
    text = [sentence(rng, 60) for _ in range(6)]
    leak = text[4] + " " + items[0][1]
    rows = [(5, text[0], "en", "s"), (None, text[0], "en", "s"),       # a copy without an id
            (6, text[1], "en", "s"), (7, text[1], "en", "s"), (7, text[2], "en", "s"),   # a copy's namesake
            (None, text[3], "en", "s"), (None, text[3], "en", "s"),    # copies without any id
            (8, leak, "en", "s"), (8, text[5], "en", "s"), (None, leak + " z", "en", "s")]
    docs = docs_frame(spark, rows).selectExpr("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.where("text not like '% z'").collect()))) == sorted(map(str, [
        (5, text[0]), (6, text[1]), (7, text[2]), (None, text[3]), (8, leak), (8, text[5])]))
    clean = corpus_pipeline.decontaminate(spark, docs, folder).collect()
    assert sorted(str((r.doc_id, r.text)) for r in clean) == sorted(
        str((i, t)) for i, t, *_ in rows if not t.startswith(leak))


def test_unlabelled_corpus_is_kept(spark, tmp_dir):
    rows = [(i, t, None, "s") for i, t in enumerate(["some text", "né", "漢", "", None, "12 --", " \n"] * 3)]
    docs = docs_frame(spark, rows).selectExpr("doc_id", "text", "lang", "source", "n_chars")
    got = corpus_pipeline.language_id(spark, docs, tmp_dir).collect()
    assert sorted(r.doc_id for r in got) == [i for i, t, *_ in rows if any(c.isalpha() for c in t or "")]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    import duckdb
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, folder).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.select(*cols).fetchall(), key=str)


def test_language_stage_keeps_the_languages_asked_for(spark, monkeypatch):
    """The prediction decides, not the label: mislabelled rows go with the language they are written in."""
    words = {"aa": "lorem ipsum dolor sit amet", "bb": "xyzzy qwrk vvzz wkq zzyx"}
    rows = [(i, " ".join(random.Random(i).choices(words["ab"[i % 2] * 2].split(), k=30)), "ab"[i % 2] * 2, "s") for i in range(120)]
    rows += [(500, rows[0][1], "bb", "s"), (501, rows[1][1], "aa", "s"), (502, rows[0][1], None, "s"), (503, None, "aa", "s"), (504, "12 3", "aa", "s")]
    docs = docs_frame(spark, rows).selectExpr("doc_id", "text", "lang", "source", "n_chars")
    everything = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert everything == {i for i, *_ in rows} - {503, 504}
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", frozenset({"aa"}))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {i for i in range(0, 120, 2)} | {500, 502}
    monkeypatch.setattr(corpus_pipeline, "MIN_SCORE", 1.1)
    assert corpus_pipeline.language_id(spark, docs, "").count() == 0
