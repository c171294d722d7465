"""Near-duplicates against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from speechset.llm import neardup
from speechset.llm.neardup import first_of_groups, near_duplicates
from tests.llm.conftest import ODD_TEXTS, documents


def plain(texts):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for t in texts:
        w = __import__("re").findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set()))
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [(len(s), g) for s, g in zip(sets, group)]


def corpus():
    r = random.Random(8)
    base = [f"w{r.randrange(9999)}" for _ in range(120)]
    texts = []
    for edits in [0, 1, 2, 3, 4, 5, 6, 8, 10, 12] * 6:  # many versions of one text, more or less far apart
        own = list(base)
        for _ in range(edits):
            own[r.randrange(len(own))] = f"new{r.randrange(99999)}"
        texts.append(" ".join(own))
    chain = list(base[::-1])
    for i in range(0, 40, 2):  # each near the one before, far from the first
        chain[i] = f"c{i}"
        texts.append(" ".join(chain))
    return texts + [texts[0].upper(), texts[0]] + ODD_TEXTS


@pytest.mark.parametrize("rare", [neardup.RARE, 3])
def test_equal_to_all_pairs(llm, monkeypatch, rare):
    monkeypatch.setattr(neardup, "RARE", rare)
    texts = corpus()
    got = near_duplicates(documents(llm, texts)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == plain(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_rows_without_or_with_repeated_ids(llm):
    df = documents(llm, ["a b c d e", "a b c d e", "x y z"])
    df = df.unionByName(df.where("doc_id = 0")).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.col("doc_id")))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == [(0, 0, True), (1, 0, False), (None, None, True)]
    assert first_of_groups(df).count() == 3  # row 0 twice, and the row without an id


def test_empty_table(llm):
    assert near_duplicates(documents(llm, ["x"]).where("false")).count() == 0


def test_different_texts_under_one_id_all_stay(llm):
    """Repeated rows go, different texts do not, and a near-duplicate goes whichever id it stands under."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(50)) for c in "abc")
    rows = [(5, one), (5, two), (5, two), (5, one), (6, two + " end"), (7, three), (7, one + " end"), (8, ""), (8, None), (None, three), (9, "z")]
    df = llm.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, th int, other string")
    got = sorted(((r.doc_id, r.text) for r in first_of_groups(df, once=True).collect()), key=str)
    texts = {t for _, t in got}
    # Of two near texts the one that stands for its id stays, wherever the other one is.
    assert {t.removesuffix(" end") for t in texts if t} == {one, two, three, "z"} and len(got) == 6
    assert [i for i, t in got if t in ("", None)] == [8, 8]
    assert sum(t.startswith("a0") for t in texts if t) == sum(t.startswith("b0") for t in texts if t) == 1
    assert first_of_groups(df, once=True).columns == df.columns
