"""Substring dedup against a brute-force count of windows."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from speechset.llm import substrings
from speechset.llm.substrings import WINDOW, remove_repeats, repeated_windows
from tests.llm.conftest import ODD_TEXTS, documents


def plain(texts):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i : i + WINDOW]) for w in words for i in range(len(w) - WINDOW + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - WINDOW + 1):
            if count[tuple(w[i : i + WINDOW])] > 1:
                gone.update(range(i, i + WINDOW))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus():
    r = random.Random(4)
    word = lambda: r.choice("the a of in".split()) if r.random() < 0.3 else f"w{r.randrange(5000)}"
    passage = [word() for _ in range(60)]
    texts = [" ".join(word() for _ in range(r.randrange(120))) for _ in range(40)]
    texts += [" ".join([word() for _ in range(20)] + passage[k:] + [word() for _ in range(9)]) for k in (0, 5, 24, 26)]
    return texts + [texts[0]] * 3 + ["loop " * 90, "a b c " * 50, " \t".join(passage) + "\n"] + ODD_TEXTS


def check(spark, texts):
    done = remove_repeats(documents(spark, texts), out="found").orderBy("doc_id").collect()
    assert [(r.found.n_words, r.found.n_removed, r.found.kept) for r in done] == plain(texts)
    for row, text, (_, removed, kept) in zip(done, texts, plain(texts)):
        assert row.text == (kept if removed else text) and row.counts == "extra" and row._a == 7


def test_equal_to_brute_force(llm):
    check(llm, corpus())


def test_windows_of_hot_minimisers_travel_alone(llm, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 2)
    monkeypatch.setattr(substrings, "LONGEST_RUN", 7)
    monkeypatch.setattr(substrings, "GROUP_BYTES", 2000)
    check(llm, corpus())


def test_rows_that_repeat_an_id_are_separate_places(llm):
    text = " ".join(f"w{i}" for i in range(40))
    df = documents(llm, [text, text, "other " + text]).withColumn("doc_id", F.when(F.col("doc_id") < 2, 5).cast("bigint"))
    assert [r.found.n_removed for r in remove_repeats(df, out="found").collect()] == [40, 40, 40]


def test_many_copies_without_an_id_have_each_range_once(llm):
    text = " ".join(f"w{i}" for i in range(50))
    df = documents(llm, [text] * 2000 + [f"{text} end", "short"]).withColumn("doc_id", F.when(F.col("doc_id") >= 2000, F.col("doc_id")))
    keyed, key = substrings._keyed(df, "doc_id", "text")
    assert substrings.repeated_ranges(keyed, "text", key).agg(F.max(F.size("ranges"))).first()[0] == 1
    rows = remove_repeats(df, out="found").groupBy("doc_id", "found.n_words", "found.n_removed", "found.kept").count().collect()
    assert sorted(map(tuple, rows), key=str) == [(2000, 51, 50, "end", 1), (2001, 1, 0, "short", 1), (None, 50, 50, "", 2000)]


def test_empty_table(llm):
    assert remove_repeats(documents(llm, ["x"]).where("false")).count() == 0


def test_equal_hashes_are_compared_byte_by_byte():
    which, at = repeated_windows([b"a b c", b"x b c", b"q r s"], __import__("numpy").array([1, 1, 2]), 2)
    assert list(zip(which.tolist(), at.tolist())) == [(0, 1), (1, 1), (2, 0), (2, 1)]
