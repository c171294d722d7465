"""The registered queries of the training-text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    f"""
    WITH w AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
    starts AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
    hashed AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h FROM starts),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM hashed) WHERE n > 1),
    each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
    marked AS (SELECT e.doc_id, e.i, e.word, coalesce(max(t.i) OVER (PARTITION BY e.doc_id ORDER BY e.i
        ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL, false) AS gone
        FROM each e LEFT JOIN twice t ON t.doc_id = e.doc_id AND t.i = e.i),
    kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM marked GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
    """
)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.substrings import remove_repeats

    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), out="found")
    return done.select("doc_id", "found.n_words", "found.n_removed", F.sha2("found.kept", 256).alias("kept_sha256"))


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.quality import quality

    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *[f"counts.{c}" for c in counts], "verdict.base_failed", "verdict.kept", "verdict.distance"
    )


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from speechset.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    starts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
    s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS g FROM starts),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id),
    e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
        WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
    reach(doc_id, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.r = e.x)
    SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id
    JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = w.doc_id
    """
)
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.toxicity import PREDICTED_FROM, fit, held_out, is_toxic, with_scores

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = with_scores(docs.select("doc_id", "lang", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"),
        is_toxic(model, F.col("score"), F.col("lang")).alias("toxic_by_lang"),
    )


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from speechset.llm.bytebpe import decoded, encoded

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return decoded(encoded(table(spark, sf_dir, "documents"), path, pattern), path, pattern)


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.fingerprints import with_edits

    return with_edits(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, role, replace(coalesce(text, ''), '<|', '< |') AS text,
        coalesce(CAST(floor(turn / 128.0) AS BIGINT), -1) AS part FROM conversations),
    s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role IS NOT NULL AND role <> 'system'),
    shown AS (SELECT t.conv_id, perspective, part, turn, coalesce(role, '') AS k, text,
        CASE WHEN role = 'system' THEN '<|im_start|>system' WHEN role = perspective THEN '<|im_start|>assistant'
            WHEN role IS NULL THEN '<|im_start|>user'
            ELSE '<|im_start|>user name=' || regexp_replace(role, '[^A-Za-z0-9_-]', '_', 'g') END || chr(10) AS head,
        text || '<|im_end|>' || chr(10) AS body, coalesce(role = perspective, false) AS mine
        FROM t JOIN s ON s.conv_id IS NOT DISTINCT FROM t.conv_id),
    placed AS (SELECT *, CAST(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part
        ORDER BY turn, k, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM shown)
    SELECT conv_id, perspective, part, CAST(count(*) AS INTEGER) AS n_turns,
        string_agg(head || body, '' ORDER BY turn, k, text) AS rendered,
        coalesce(string_agg((stop - length(body)) || '-' || (stop - 1), ' ' ORDER BY turn, k, text) FILTER (mine), '') AS mask
    FROM placed GROUP BY conv_id, perspective, part
    """
)
def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.chat import rotate

    spans = F.transform("mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, " "))


def _license_sql() -> str:
    from speechset.llm.licenses import SHINGLE, TEMPLATES, size_class, stride, template_words

    rows = []
    for name, text in TEMPLATES.items():
        tokens = template_words(text)
        size = size_class(len(tokens) - SHINGLE + 1)
        rows.append(f"('{name}', '{' '.join(tokens)}', {size}, {stride(size)})")
    return rf"""
    WITH t AS (SELECT license, string_split(words, ' ') AS ws, size, step
        FROM (VALUES {', '.join(rows)}) AS v(license, words, size, step)),
    tr AS (SELECT DISTINCT license, size, step, array_to_string(ws[i:i + 4], ' ') AS run
        FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM t)),
    n AS (SELECT license, CAST(count(*) AS INTEGER) AS n_shingles FROM tr GROUP BY license),
    w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\p{{L}}\p{{N}}]+') AS ws FROM documents),
    dr AS (SELECT doc_id, i - 1 AS i, array_to_string(ws[i:i + 4], ' ') AS run
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
    met AS (SELECT doc_id, license, size, step, i, run FROM dr JOIN tr USING (run)),
    wins AS (SELECT doc_id, license, run, step,
        unnest(range(greatest(0, CAST(ceil((i - (size + step - 2)) / CAST(step AS DOUBLE)) AS BIGINT)), i // step + 1)) AS k FROM met),
    f AS (SELECT doc_id, license, k * step AS start, count(DISTINCT run) AS n_found FROM wins GROUP BY ALL)
    SELECT doc_id, license, n_shingles, CAST(max(n_found) AS INTEGER) AS n_found, CAST(min(start) AS INTEGER) AS first_word
    FROM f JOIN n USING (license) WHERE 100 * n_found >= 80 * n_shingles GROUP BY doc_id, license, n_shingles
    """


@query(_license_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


@query()
def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from speechset.llm.tokenfile import read_documents, write_tokens
    from speechset.session import new_folder

    path = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=2)
    return read_documents(spark, path)


# The rules of the contract.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def _url_sql() -> str:
    rows = []
    for rule, action in URL_RULES:
        host, path = rule[: rule.index("/")], rule[rule.index("/") :]
        rows.append(f"('{rule}', '{host}', '{path}', '{action}')")
    return rf"""
    WITH r(rule, rule_host, rule_path, action) AS (VALUES {', '.join(rows)}),
    u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
    SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN r
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC) = 1
    """


@query(_url_sql())
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.urlfilter import judge

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, URL_RULES).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
    total AS (SELECT count(*) FILTER (len(ts) > 0) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM d),
    m AS (SELECT rid, doc_id, 100 - 50 + ((50 * len(ts) * big_n) // big_l) AS m FROM d, total WHERE len(ts) > 0),
    tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) GROUP BY rid, term),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tf, total GROUP BY term),
    q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    s AS (SELECT item_id, rid, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
        FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_id, rid)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s JOIN m USING (rid) WHERE score > 0 QUALIFY rank <= 50
    """
)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.lexsearch import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the rebuilt conversations: the first h turns of conversation c - c % 5, then c's own from the h-th on."""
    from speechset.session import materialize

    size = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")), "sizes")
    h, base = F.crc32(F.col("conv_id").cast("string")) % 9, F.col("conv_id") - F.col("conv_id") % 5
    heads_of = size.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    shift = size.withColumns({"h": h, "base": base}).join(heads_of, "base", "left")
    shift = shift.select("conv_id", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("before"))
    own = turns.join(shift, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("before"))
    near = F.array(*[F.expr(f"try_add(conv_id, {d}L)") for d in range(-4, 5)])
    first = turns.where((F.col("pos") < 8) & (F.col("conv_id") == base)).withColumn("to", F.explode(near))
    first = first.where((F.col("to") - F.col("to") % 5 == F.col("conv_id")) & (F.col("pos") < F.crc32(F.col("to").cast("string")) % 9))
    heads = first.withColumn("conv_id", F.col("to")).drop("to").join(size.select("conv_id"), "conv_id", "left_semi")
    return materialize(heads.unionByName(own.select(*heads.columns)), "rebuilt"), size.select("conv_id")


# Unsigned crc32 of a decimal id, a bit at a time: each digit is followed by eight shifts.
_CRC_SQL = """xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END,
        CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""


@query(
    """
    WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || coalesce(text, ''))) - 1 AS pos,
        md5(md5(coalesce(role, '')) || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS n_bytes
        FROM conversations WHERE conv_id IS NOT NULL),
    h AS (SELECT conv_id, conv_id - conv_id % 5 AS base, HASHES AS h, count(*) AS size FROM t GROUP BY conv_id),
    heads AS (SELECT h.conv_id, t.pos, t.k, t.n_bytes FROM h JOIN t ON t.conv_id = h.base AND t.pos < h.h),
    own AS (SELECT t.conv_id, t.pos - h.h + least(h.h, coalesce(b.size, 0)) AS pos, t.k, t.n_bytes
        FROM t JOIN h USING (conv_id) LEFT JOIN h b ON b.conv_id = h.base WHERE t.pos >= h.h),
    r AS (SELECT * FROM heads UNION ALL SELECT * FROM own),
    c AS (SELECT h.conv_id, coalesce(list(k ORDER BY pos) FILTER (k IS NOT NULL), []) AS ks,
        coalesce(list(n_bytes ORDER BY pos) FILTER (k IS NOT NULL), []) AS bs FROM h LEFT JOIN r USING (conv_id) GROUP BY h.conv_id),
    p AS (SELECT conv_id, d AS depth, md5(array_to_string(ks[1:d], ',')) AS path, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS n_bytes,
        d = len(ks) AS ended FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM c)),
    n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256 FROM p GROUP BY depth, path),
    up AS (SELECT DISTINCT a.depth, a.path, b.path AS above FROM p a JOIN p b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1),
    kids AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n_children FROM up GROUP BY depth, above),
    below AS (SELECT DISTINCT a.depth, a.path, b.depth AS depth2, b.path AS path2 FROM p a JOIN p b ON b.conv_id = a.conv_id AND b.depth >= a.depth),
    sums AS (SELECT b.depth, b.path, count(*) FILTER (coalesce(k.n_children, 0) = 0) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved_tokens
        FROM below b JOIN n ON n.depth = depth2 AND n.path = path2 LEFT JOIN kids k ON k.depth = depth2 AND k.path = path2 GROUP BY b.depth, b.path)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(kids.n_children, 0) AS BIGINT) AS n_children,
        n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM n JOIN sums ON sums.depth = n.depth AND sums.path = n.path LEFT JOIN kids ON kids.depth = n.depth AND kids.path = n.path
    LEFT JOIN up ON up.depth = n.depth AND up.path = n.path LEFT JOIN n a ON a.depth = n.depth - 1 AND a.path = up.above
    """.replace("HASHES", f"{_CRC_SQL} % 9")
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from speechset.llm.trie import prefix_trie, turn_keys, with_end_digests

    turns, members = rebuilt(turn_keys(table(spark, sf_dir, "conversations")))
    return with_end_digests(prefix_trie(turns, members)).drop("path_a", "path_b")
