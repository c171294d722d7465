"""URL filter, ranked search and prefix trie against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from speechset.llm import lexsearch
from speechset.llm.lexsearch import search
from speechset.llm.queries import URL_RULES, rebuilt
from speechset.llm.trie import SEGMENT, SHARD, prefix_trie, turn_keys, with_end_digests
from speechset.llm.urlfilter import Cascade, judge


def _plain_judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, action in rules:
        h, _, p = rule.partition("/")
        p = rule[len(h):]
        h = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), h.count("."))
            if best is None or rank > best[0] or (rank == best[0] and action == "block"):
                best = (rank, h + p, action)
    return host, path, best and best[1], best[2] if best else "allow"


ODD_URLS = [
    None, "", "no scheme", "http://", "http://example.com", "http://example.com/en", "http://EXAMPLE.com/en/x?u=http://a.net/es/",
    "https://www.example.com/en/#x", "https://a.www.example.com/en/", "ftp://notexample.com/en/a", "http://x.net/es/1", "http://x.net/ES/1",
    "http://net/fr/", "http://net./fr/", "http://.com/", "http://a..com/en/", "http://example.com:80/en/", "http://u@example.com/en/b",
    "x://y://example.com/en/", "http://ÉX.com/", "http://example.org/en/", "http://example.com/en/\nline", "http://" + "a." * 300 + "com/en/", "http://example.com?/en/",
]


@pytest.mark.parametrize("max_bits", [1 << 24, 64])
def test_urls_like_plain_rules(llm, max_bits):
    rules = [*URL_RULES, ("Example.COM/en/x", "allow"), ("org", "block"), ("com/e", "block"), ("net/es/", "allow"), ("c.com/", "block")]
    rules += [(f"w{i}.com/en/{'p' * (i % 3)}", "block" if i % 2 else "allow") for i in range(60)]
    urls = ODD_URLS + [f"http://v.w{i}.com/en/{'p' * (i % 4)}/z" for i in range(120)]
    rows = [(i if i % 7 else None, u, 1, "x") for i, u in enumerate(urls + urls[:9])]
    pages = llm.createDataFrame(rows, "page_id bigint, url string, judged int, _best string")
    done = judge(pages, rules, max_bits=max_bits)
    assert done.columns == ["page_id", "url", "judged", "_best", "judged_"]
    got = Counter((r.page_id, r.url, *r["judged_"]) for r in done.collect())
    assert got == Counter((p, u, *_plain_judge(u, rules)) for p, u, *_ in rows)


def test_urls_of_empty_tables_and_lists(llm):
    pages = llm.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    assert judge(pages.limit(0), URL_RULES).count() == 0
    assert [tuple(r.judged) for r in judge(pages, []).collect()] == [("a.com", "/", None, "allow")]
    odd = llm.createDataFrame([(None, "block"), ("com/", None), ("a.com", "block"), ("a.com", "allow")], "rule string, action string")
    assert [tuple(r.judged) for r in judge(pages, odd).collect()] == [("a.com", "/", "a.com", "block")]


def test_a_cascade_is_exact_over_its_universe(llm):
    keys = llm.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 37 == 0).alias("listed"))
    cascade = Cascade(keys)
    assert len(cascade.levels) > 2
    assert cascade.bits < 20_000  # an array of flags would need a bit a key, and the keys besides
    assert keys.where(cascade.holds(F.col("key")) != F.col("listed")).count() == 0
    assert keys.where(Cascade(keys.withColumn("listed", F.lit(False))).holds(F.col("key"))).count() == 0
    assert keys.where(~Cascade(keys.withColumn("listed", F.lit(True))).holds(F.col("key"))).count() == 0


def test_judging_has_no_join(llm):
    pages = llm.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    shown = judge(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Join" not in shown and "Exchange" not in shown and "Python" not in shown


def _terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lexsearch.TERM, lowered)


def _plain_search(docs, items, k):
    held = [(i, Counter(_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries = defaultdict(set)
    for item, text in items:
        queries[item] |= set(_terms(text))
    out = []
    for item, terms in queries.items():
        found = []
        for i, counts in held:
            n = sum(counts.values())
            m = 50 + (50 * n * n_docs) // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in terms if counts[t]
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(found)[:k])]
    return out


def _search_case(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "x2", "中文", "naïve", "Word" * 9]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 3, 20, 200])))) for i in range(300)]
    docs += [(None, "w1 w59, W1"), (None, None), (7, "w40 w41-w40"), (7, "w40 w41-w40"), (900, ""), (901, " ,;\n")] + [(1000 + i, "w50 x2") for i in range(120)]
    docs.append((2000, "w3 " * 200_000 + "w58"))
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(30)]
    items += [(None, "w50"), (3, "w58 w58"), (3, "w58 w58"), (77, None), (78, "..."), (79, "nowhere"), (80, "x2 W50")]
    return docs, items


@pytest.mark.parametrize(("seed", "block"), [(1, 1024), (2, 7)])
def test_search_like_scoring_everything(llm, monkeypatch, seed, block):
    monkeypatch.setattr(lexsearch, "BLOCK_ITEMS", block)
    monkeypatch.setattr(lexsearch, "SEEDS", 40)
    docs, items = _search_case(seed)
    table = llm.createDataFrame([(*d, "z", 1) for d in docs], "doc_id bigint, text string, length string, score int").repartition(5)
    asked = llm.createDataFrame([(*i, 4) for i in items], "item_id bigint, text string, query int")
    got = Counter(tuple(r) for r in search(table, asked, k=20).collect())
    assert got == Counter(_plain_search(docs, items, 20))


def test_search_of_empty_tables(llm):
    docs = llm.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = llm.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert search(docs.limit(0), items).count() == 0 and search(docs, items.limit(0)).count() == 0
    assert search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert search(docs.withColumn("text", F.lit(None).cast("string")), items).count() == 0


def _key(role, text):
    return hashlib.md5((hashlib.md5((role or "").encode()).hexdigest() + (text or "")).encode()).hexdigest()


def _plain_trie(conversations):
    """conversations: id -> list of (key, bytes)."""
    nodes = defaultdict(lambda: {"members": [], "ends": [], "bytes": 0, "children": set()})
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            path = tuple(k for k, _ in turns[:d])
            nodes[path]["members"].append(c)
            nodes[path]["bytes"] = turns[d - 1][1] if d else 0
            if d:
                nodes[path[:-1]]["children"].add(path)
            if d == len(turns):
                nodes[path]["ends"].append(c)
    sums = {}
    for path in sorted(nodes, key=len, reverse=True):
        node = nodes[path]
        leaves, saved = int(not node["children"]), (len(node["members"]) - 1) * node["bytes"]
        for child in node["children"]:
            leaves, saved = leaves + sums[child][0], saved + sums[child][1]
        sums[path] = (leaves, saved)
    return Counter(
        (min(n["members"]), len(p), min(nodes[p[:-1]]["members"]) if p else None, len(n["members"]), len(n["children"]), *sums[p],
         hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest())
        for p, n in nodes.items()
    )


def _ordered(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, _key(role, text), len((text or "").encode())))
    return {c: [(k, n) for *_, k, n in sorted(turns)] for c, turns in own.items()}


def _trie_rows(nodes):
    wanted = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in nodes.select(*wanted).collect())


_TURNS = "conv_id bigint, turn bigint, role string, text string, pos int, key string"


def _turn_table(llm, rows):
    return llm.createDataFrame([(*r, 9, "k") for r in rows], _TURNS).repartition(3)


def test_trie_like_a_plain_one(llm):
    rng = random.Random(3)
    rows = []
    for c in range(-7, 400):
        shared = rng.choice([0, 1, 3])
        for t in range(rng.choice([1, 2, 5])):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "é", None]) if t >= shared else "user", f"t{t} {rng.randrange(3) if t >= shared else ''}"))
    rows += [(None, 0, "user", "no id"), (3, 1, "user", None), (3, 1, "user", None), (5, 0, "", ""), (2**62, 0, "user", "t0 ")]
    rows += [(c, t, "user", "same") for c in range(5000, 5000 + 2 * SHARD) for t in range(2)]
    got = _trie_rows(with_end_digests(prefix_trie(turn_keys(_turn_table(llm, rows)))))
    assert got == _plain_trie(_ordered(rows))


def test_trie_of_long_conversations(llm):
    n = 2 * SEGMENT + 30
    rows = [(c, t, "user", "hot" if t < n - c else f"{c} {t}") for c in (0, 1, 2, 40) for t in range(n if c else SEGMENT)]
    rows += [(90, None, "user", "again")] * (SEGMENT + 5)
    got = _trie_rows(with_end_digests(prefix_trie(turn_keys(_turn_table(llm, rows)))))
    assert got == _plain_trie(_ordered(rows))


def test_rebuilt_conversations_and_members_without_turns(llm):
    import zlib

    rng = random.Random(5)
    rows = [(c, t, "user", f"{rng.randrange(4)}") for c in rng.sample(range(-30, 300), 150) for t in range(rng.randrange(1, 12))]
    own = _ordered(rows)
    expected = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(math.fmod(c, 5)), [])
        expected[c] = base[:h] + turns[h:]
    assert any(not turns for turns in expected.values())
    turns, members = rebuilt(turn_keys(_turn_table(llm, rows)))
    assert _trie_rows(with_end_digests(prefix_trie(turns, members))) == _plain_trie(expected)


def test_trie_of_no_conversation(llm):
    empty = _turn_table(llm, [(1, 0, "user", "x")]).limit(0)
    turns, members = rebuilt(turn_keys(empty))
    assert with_end_digests(prefix_trie(turns, members)).count() == 0
    only = llm.createDataFrame([(4,), (2,)], "conv_id bigint")
    got = _trie_rows(with_end_digests(prefix_trie(turn_keys(empty), only)))
    assert got == _plain_trie({2: [], 4: []})

