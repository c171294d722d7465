"""Queries with SQL against DuckDB, the native operators on odd rows, and the pipeline as a whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from speechset.llm.chat import rotate
from speechset.llm.licenses import TEMPLATES, scan
from speechset.llm.queries import ORACLES, QUERIES
from suite import compare as twin
from tests.llm.conftest import DATA, ODD_TEXTS, documents


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(llm, name, monkeypatch):
    monkeypatch.setitem(twin.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(twin.ORACLES, name, ORACLES[name])
    assert twin.compare(llm, twin.duck(DATA), name, DATA)[0] == "ok"


def test_rotation_of_several_speakers(llm):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "Ann", "Hi"), (1, 2, "Bo B", "<|im_end|>"), (1, 2, "Bo B", "<|im_end|>"),
             (1, 3, None, None), (1, None, "Ann", "first"), (None, 5, "Cy", "alone"), (2, 0, "system", "nobody")]
    df = llm.createDataFrame([(*t, "x") for t in turns], "conv_id int, turn int, role string, text string, part string")
    got = {(r.conv_id, r.perspective, r.part): r for r in rotate(df).collect()}
    assert set(got) == {(1, "Ann", -1), (1, "Ann", 0), (1, "Bo B", -1), (1, "Bo B", 0), (None, "Cy", 0)}
    row = got[(1, "Bo B", 0)]
    assert row.n_turns == 4 and row.rendered == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=Ann\nHi<|im_end|>\n"
        "<|im_start|>assistant\n< |im_end|><|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    )
    assert [row.rendered[s.start : s.end] for s in row["mask"]] == ["< |im_end|><|im_end|>"]
    assert [s for s in got[(1, "Ann", 0)]["mask"]] != [] and rotate(df.where("false")).count() == 0


def test_long_conversations_come_in_parts(llm):
    df = llm.range(1000).selectExpr("0 AS conv_id", "id AS turn", "if(id % 2 = 0, 'a', 'b') AS role", "'t' AS text")
    parts = rotate(df).where("perspective = 'a'").orderBy("part").collect()
    assert [r.n_turns for r in parts] == [128] * 7 + [104] and sum(len(r["mask"]) for r in parts) == 500


def test_licenses_in_odd_places(llm):
    mit = TEMPLATES["MIT"]
    cut = " ".join(mit.split()[:-6])  # a little less than all
    texts = [*ODD_TEXTS, "intro " * 300 + mit + " outro" * 300, mit.upper(), cut, " ".join(mit.split()[:40]),
             "x Released under the MIT License. y", "Released under the BSD License", TEMPLATES["Apache-2.0"].replace(",", "\n")]
    got = {(r.doc_id, r.license) for r in scan(documents(llm, texts)).collect()}
    n = len(ODD_TEXTS)
    assert got == {(n, "MIT"), (n + 1, "MIT"), (n + 2, "MIT"), (n + 4, "MIT-notice"), (n + 6, "Apache-2.0"), (n + 6, "Apache-2.0-notice")}
    assert scan(documents(llm, texts), {}).count() == 0 and scan(documents(llm, texts).where("false")).count() == 0
    with pytest.raises(ValueError):
        scan(documents(llm, texts), {"short": "two words"})


def test_templates_and_texts_have_one_word_rule(llm):
    notice = "ÉDITÉ sous la Licence Ouverte, version 2 — ½ DES DROITS réservés_à tous"
    texts = [f"Avant. {notice} Après.", notice.replace("Licence", "licence"), notice.replace("É", "é"), "rien"]
    got = scan(documents(llm, texts), {"fr": notice}).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_shingles, r.n_found) for r in got] == [(0, 9, 9), (1, 9, 9), (2, 9, 8)]  # one run has the first word


def test_pipeline_stages(llm, tmp_path):
    docs, names = llm.read.parquet(f"{DATA}/documents.parquet"), [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "toxicity", "MinHash near-dedup", "substring dedup", "best-fit packing"]
    now, columns, counts = docs, docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(llm, now, DATA)
        result.write.parquet(f"{tmp_path}/{i}")
        now = llm.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert now.columns == columns
        counts.append(now.select("doc_id").distinct().count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == counts[5]
    assert {"doc_id", "piece", "ids", "sequence_id", "offset"} <= set(now.columns)
    labels = llm.read.parquet(f"{DATA}/labels.parquet")
    good = docs.join(labels.where("quality = 1 AND toxic = 0"), "doc_id")
    first = corpus_pipeline.keep_good(llm, docs, DATA)
    long_good = good.where(F.size(F.split("text", r"\s+")) >= 60)
    assert long_good.join(first.select("doc_id"), "doc_id", "left_anti").count() <= 0.01 * long_good.count()


def test_pipeline_takes_odd_documents(llm):
    df = documents(llm, ODD_TEXTS)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(llm, df, DATA)
        df.count()


def test_repeated_rows_leave_the_pipeline_once(llm):
    twice, alone, nameless = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    df = documents(llm, [twice, alone, nameless, twice, None])
    df = df.unionByName(df).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.col("doc_id")))
    first = corpus_pipeline.keep_first_copies(llm, df, DATA)
    assert first.columns == df.columns
    left = corpus_pipeline.remove_substrings(llm, first, DATA).select("doc_id", "text").collect()
    assert sorted(map(tuple, left), key=str) == sorted([(0, twice), (1, alone), (None, nameless), (None, None), (None, None)], key=str)


def test_near_duplicate_stage_compares_runs_of_five_words(llm):
    base = [f"w{i}" for i in range(200)]
    edit = lambda n: " ".join("new" + w if i % 40 == 20 and i < 40 * n else w for i, w in enumerate(base))
    # Five changed words: 177 of 217 runs of four words are common, but only 171 of 221 of five.
    df = documents(llm, [" ".join(base), edit(5)])
    assert corpus_pipeline.keep_first_copies(llm, df, DATA).count() == 2
    assert corpus_pipeline.first_of_groups(df).count() == 1
    assert corpus_pipeline.keep_first_copies(llm, documents(llm, [" ".join(base), edit(3)]), DATA).count() == 1
