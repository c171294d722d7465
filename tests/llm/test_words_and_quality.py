"""Word kernels and quality rules against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechset.llm.quality import count_text, quality, quality_kept
from speechset.llm.words import Words, cover, hash_ranges
from tests.llm.conftest import ODD_TEXTS, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab É中\n\t#*A|", max_size=60)), max_size=6)


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(runs)
    repeated = {i + k for i, r in enumerate(runs) if many[r] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in lines:
        copies += line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(repeated)]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_counts_equal_plain_ones(given_texts):
    got = count_text(pa.array(given_texts, pa.string()))
    for i, text in enumerate(given_texts):
        assert [int(c[i]) for c in got[:5]] == plain_counts(text)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_equal_the_pattern(given_texts):
    words = Words(pa.array(given_texts, pa.string()))
    joined, start, end = words.joined()
    for i, text in enumerate(given_texts):
        own = range(words.first[i], words.first[i + 1])
        expected = WORD.findall(text or "")
        assert [words.data[words.start[j] : words.end[j]].tobytes().decode() for j in own] == expected
        if expected:
            assert joined[start[own[0]] : end[own[-1]]].decode() == " ".join(expected)


def test_sliced_arrays_and_hashes():
    whole = pa.array(["drop me", "one two", None, "two"], pa.string())
    words = Words(whole.slice(1, 3))
    assert words.count.tolist() == [2, 0, 1]
    h = words.hashes()
    assert h[1] == h[2] != h[0]
    data = np.frombuffer(b"abcdefghijk abcdefghijk", np.uint8)
    a, b = hash_ranges(data, np.array([0, 12]), np.array([11, 23]))
    assert a == b
    assert cover(np.array([1, 4]), 2, 7).tolist() == [False, True, True, False, True, True, False]


@pytest.fixture(scope="module")
def judged(llm):
    good = [" ".join(f"word{(i * 7 + k * (3 + i % 5)) % 997}" for k in range(80 + i % 40)) + ".\nA last line" for i in range(300)]
    junk = [" ".join(f"wo{k}##$$" for k in range(90)) for _ in range(5)]
    return quality(documents(llm, good + junk + ODD_TEXTS)).select("doc_id", "counts_.n_words", "verdict.*", "counts").toPandas()


def test_outliers_go_and_the_bulk_stays(judged):
    rows = judged.set_index("doc_id")
    assert rows.loc[:299, "kept"].all()
    assert not rows.loc[300:304, "kept"].any() and not rows.loc[300:304, "base_failed"].any()


def test_odd_rows_fail_the_base_rule(judged):
    odd = judged.set_index("doc_id").loc[305:]
    assert len(odd) == len(ODD_TEXTS) and odd.base_failed.all() and not odd.kept.any()
    assert set(odd.counts) == {"extra"}  # a column of the input that clashes with ours


def test_filter_keeps_the_columns_and_takes_empty_tables(llm):
    empty = documents(llm, ["x"]).where("false")
    assert quality_kept(empty).columns == empty.columns and quality_kept(empty).count() == 0


def test_nulls_in_language_and_source_form_groups(llm):
    df = documents(llm, [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(60)])
    df = df.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("lang")))
    assert quality_kept(df.withColumn("source", F.lit(None).cast("string"))).count() == 60


@pytest.mark.parametrize("share", [0.30, 0.45])
def test_a_source_with_much_junk_loses_all_of_it(llm, share):
    good = [" ".join(f"word{(i * 7 + k * (3 + i % 5)) % 997}" for k in range(80 + i % 40)) + ".\nA last line" for i in range(300)]
    junk = [" ".join(f"wo{k}##$$"[: 5 + i % 5] + "#" for k in range(90 + i)) for i in range(round(300 * share / (1 - share)))]
    rows = quality(documents(llm, good + junk)).select("doc_id", "verdict.*").toPandas().set_index("doc_id")
    assert rows.loc[:299, "kept"].all()
    assert not rows.loc[300:, "base_failed"].any() and not rows.loc[300:, "kept"].any()


def test_extra_columns_named_like_those_of_the_estimate(llm):
    df = documents(llm, [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(60)])
    for name in ("_lang", "_source", "center", "Inverse", "_g", "n"):
        df = df.withColumn(name, F.lit(f"mine {name}"))
    kept = quality_kept(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))


def test_the_cutoff_follows_from_the_law_of_distances(llm):
    good = [" ".join(f"word{(i * 7 + k * (3 + i % 5)) % 997}" for k in range(80 + i % 40)) + ".\nA last line" for i in range(300)]
    # A sign in every tenth word: some ten standard deviations, far beyond 97.5 percent of a normal sample.
    strewn = [" ".join(f"word{(i + k) % 997}" + "#" * (k % 10 == 0) for k in range(100)) + ".\nA last line" for i in range(5)]
    rows = quality(documents(llm, good + strewn)).select("doc_id", "verdict.*").toPandas().set_index("doc_id")
    assert rows.loc[:299, "kept"].all() and rows.loc[300:, "distance"].between(4, 20).all()
    assert not rows.loc[300:, "base_failed"].any() and not rows.loc[300:, "kept"].any()


def test_one_repeated_line_makes_no_outlier(llm):
    good = [" ".join(f"word{(i * 7 + k * (3 + i % 5)) % 997}" for k in range(80 + i % 40)) + ".\nA last line" for i in range(300)]
    # One line of five comes again, some seven standard deviations out: farther than 97.5 percent of a normal sample, but not of any.
    again = [g.removesuffix("\nA last line") + "".join(f"\na{k}b{i}" for k in (1, 2, 3, 1)) for i, g in enumerate(good[:5])]
    rows = quality(documents(llm, good + again)).select("doc_id", "verdict.*").toPandas().set_index("doc_id")
    assert rows.loc[300:, "distance"].between(4, 9).all() and rows.kept.all()
