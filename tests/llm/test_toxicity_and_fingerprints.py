"""Toxicity on held-out rows, fingerprints against plain winnowing."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from speechset.llm import fingerprints as module
from speechset.llm import toxicity
from speechset.llm.fingerprints import as_text, fingerprints, followed, likeness, winnow, with_edits
from speechset.llm.frames import texts as narrow
from speechset.llm.toxicity import fit, held_out, is_toxic, with_scores, without_toxic
from tests.llm.conftest import ODD_TEXTS, documents

BAD = ["idiot", "scum", "vile", "moron"]


def labelled(spark, n=500):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words[r.randrange(len(words))] = r.choice(BAD).upper() + "!"
            words[r.randrange(len(words))] = r.choice(BAD)
        rows.append((i, " ".join(words), "en" if i % 2 else "fr"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_rows_are_told_apart(llm):
    docs, labels = labelled(llm)
    model = fit(docs, labels.unionByName(labels.limit(5)).unionByName(llm.createDataFrame([(None, 1), (3, None)], labels.schema)))
    again = fit(docs, labels)
    scored = with_scores(docs, model).join(labels, "doc_id").toPandas()
    out = scored[[zlib.crc32(str(i).encode()) % 3 == 1 for i in scored.doc_id]]
    assert ((out.score >= 0.7) == (out.toxic == 1)).mean() > 0.97
    assert set(llm.range(50).where(held_out(F.col("id"))).toPandas().id) == {i for i in range(50) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.allclose(again.score(pa.array(["w1 idiot w2"])), model.score(pa.array(["w1 idiot w2"])))
    kept = without_toxic(docs.withColumn("score", F.lit("mine")), model)
    assert kept.columns == ["doc_id", "text", "lang", "score"] and 380 <= kept.count() <= 420
    verdicts = with_scores(docs, model).select(is_toxic(model, F.col("score"), F.lit(None).cast("string")).alias("v"))
    assert 80 <= verdicts.where("v").count() <= 120


def test_thresholds_come_from_all_rows_not_trained_on(llm, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 30)
    monkeypatch.setattr(toxicity, "NEGATIVES", 40)
    docs, labels = labelled(llm)
    model = fit(docs, labels)  # about 8 toxic texts of the sample are not trained on
    assert set(model.thresholds) == {"en", "fr"} and any(t != toxicity.PREDICTED_FROM for t in model.thresholds.values())
    few = docs.withColumn("lang", F.when(F.col("doc_id") < 25, "es").otherwise(F.col("lang")))
    assert set(fit(few, labels).thresholds) == {"en", "fr"}  # 'es' has 5 toxic texts and takes the overall threshold


def test_odd_texts_and_missing_labels(llm):
    docs, labels = labelled(llm, 60)
    model = fit(docs, labels)
    scores = [r.score for r in with_scores(documents(llm, ODD_TEXTS), model).orderBy("doc_id").collect()]
    assert len(scores) == len(ODD_TEXTS) and all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] == scores[2]
    only = fit(docs, labels.where("toxic = 0"))
    assert set(only.score(pa.array(["a", None], pa.string()))) == {0.0}
    assert fit(docs, labels.where("false")).constant == 0.0
    assert with_scores(docs.where("false"), model).count() == 0


def test_winnowing_equals_the_definition():
    r = random.Random(2)
    for _ in range(200):
        texts = ["".join(r.choice("abé😀 ") for _ in range(r.choice([0, 1, 3, 5, 9, 20, 60]))) for _ in range(4)]
        for text, found in zip(texts, winnow(texts, 4, 6)):
            grams = [text[i : i + 4] for i in range(max(len(text) - 3, 1))] if text else []
            value = {g: int(winnow([g], 4, 99)[0]["hash"][0]) for g in set(grams)}
            hashes, expected = [value[g] for g in grams], []
            for i in range(max(len(hashes) - 5, 1) if hashes else 0):
                window = hashes[i : i + 6]
                at = i + max(k for k, h in enumerate(window) if h == min(window))
                if not expected or expected[-1] != at:
                    expected.append(at)
            assert found["position"].tolist() == expected and [int(h) for h in found["hash"]] == [hashes[i] for i in expected]


def test_shared_passages_share_a_hash():
    r = random.Random(6)
    draw = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    for _ in range(30):
        passage = draw(24 + 128 - 1)
        a, b = winnow([draw(300) + passage + draw(50), passage + draw(400)])
        assert set(a["hash"].tolist()) & set(b["hash"].tolist())


def test_half_edits_of_short_texts_are_seen():
    r = random.Random(7)
    draw = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    for n in range(77, 303):
        text, after = draw(n), draw(r.choice([0, 5, n, 400]))
        a, b = winnow([text, text[: n - n // 2] + after[: n // 2]])
        assert likeness(a, b) > 0


def test_edits_of_every_row(llm):
    r = random.Random(9)
    texts = ODD_TEXTS + ["".join(r.choice("abc é\n") for _ in range(r.randrange(400))) for _ in range(60)]
    df = documents(llm, texts)
    got = with_edits(df).orderBy(F.desc("doc_id")).collect()
    order = [t or "" for t in reversed(texts)]
    assert len(got) == len(texts)
    for i, row in enumerate(got):
        text, after = order[i], order[(i + 1) % len(order)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = winnow([text, edited, after])
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (as_text(a), as_text(b))
        assert row.near_edited == likeness(a, b) and row.near_next == likeness(a, c)
    lists = fingerprints(df).orderBy("doc_id").collect()
    assert [len(r.hashes) for r in lists] == [len(f) for f in winnow([t or "" for t in texts])]


def test_single_null_and_repeated_ids(llm):
    one = documents(llm, ["only text"])
    assert [r.near_next for r in with_edits(one).collect()] == [1.0]
    assert with_edits(one.where("false")).count() == 0
    df = documents(llm, ["a", "b", "c", "c"]).withColumn("doc_id", F.when(F.col("doc_id") > 1, 9))
    rows = followed(narrow(df, "doc_id", "text"), 3).collect()
    assert sum(not r._tail for r in rows) == 4 and with_edits(df).count() == 4


def plain_edits(rows):
    """Of (id, text) rows in order: id, digest of the edited text, likeness to the edit and to the next text."""
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b, c = winnow([text, edited, after])
        out.append((key, hashlib.sha256(edited.encode()).hexdigest(), likeness(a, b), likeness(a, c)))
    return out


def in_order(df):
    """The order that ``followed`` documents: descending id, nulls last, then by the hash of the text."""
    by = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").orderBy(*by).collect()]


@pytest.mark.parametrize("held", [1 << 18, 0])
def test_hot_ids_and_copies_are_dealt_evenly(llm, monkeypatch, held):
    monkeypatch.setattr(module, "HELD", held)
    r = random.Random(11)
    texts = ["".join(r.choice("abcd ") for _ in range(r.randrange(90))) for _ in range(1200)] + ["one text of many rows " * 3] * 800
    df = documents(llm, texts)
    i = F.col("doc_id")
    # A third without an id, a sixth under one id, and 800 rows of one id and text.
    df = df.withColumn("doc_id", F.when(i % 2 == 0, i).when(i >= 1200, 1200).when(i % 6 == 1, 777))
    df = df.withColumn("doc_id", F.when(i >= 1200, 1200).otherwise(F.col("doc_id"))).repartition(4)
    got = with_edits(df).select("doc_id", "edited_sha256", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_edits(in_order(df)), key=str)
    if held:
        sizes = [r["count"] for r in followed(narrow(df, "doc_id", "text"), 8).groupBy("_part").count().collect()]
        assert max(sizes) <= 2 * len(texts) / 8


def test_extreme_ids(llm):
    df = documents(llm, ["a b", "c d", "e f"]).withColumn("doc_id", F.element_at(F.array(*map(F.lit, [-(2**63), 2**63 - 1, 0])), F.col("doc_id").cast("int") + 1))
    got = with_edits(df).select("doc_id", "edited_sha256", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got)) == sorted(plain_edits(in_order(df)))
