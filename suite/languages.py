"""Target languages, catalogues and the voice grid."""

from pyspark.sql import functions as F

from speechset.constants import LANGUAGE_NAMES, SHARED_LANGUAGES
from speechset.functions.text import blank_to_null, split_list
from speechset.operators.languages import (
    also_in,
    collapse_languages,
    expand_languages,
    first_sentences,
    in_both,
    language_coverage,
    literal_list,
    missing_from,
    not_in,
    voice_grid,
)
from speechset.operators.positions import dense_positions
from speechset.session import bounded_list, new_folder
from speechset.sources.metadata import read_catalogue
from suite.fixtures import ALL_LANGS, table, wide
from suite.registry import query


@query(
    f"""WITH asked AS (SELECT DISTINCT lang FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
                       UNION SELECT role FROM conversations),
             shared AS (SELECT * FROM (VALUES {', '.join(f"('{lang}')" for lang in SHARED_LANGUAGES)}) AS v(lang)),
             spoken AS (SELECT DISTINCT lang FROM documents)
       SELECT 'languages' AS what, lang AS name, lang IN (SELECT lang FROM spoken) AS available, lang IN (SELECT lang FROM shared) AS shared FROM asked
       UNION ALL SELECT 'voices', n_name, n_name IN (SELECT c_name FROM customer), false FROM nation
       UNION ALL SELECT 'sources', source, source IN (SELECT source FROM documents WHERE lang = 'fr'), false
                 FROM (SELECT DISTINCT source FROM documents WHERE lang = 'de')""",
)
def q_lang_validate(spark, sf_dir):
    """Requested names, whether the data has them, and whether the model shares them: languages of toxic documents and the
    roles of conversations, nations as voices, sources of German documents among those of French ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    roles = table(spark, sf_dir, "conversations").select(F.col("role").alias("lang"))
    asked = docs.join(labels.where("toxic = 1"), "doc_id").select("lang").unionByName(roles)
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))

    def report(what, requested, available, column):
        there = also_in(requested, available, column).withColumn("available", F.lit(True))
        gone = not_in(requested, available, column).withColumn("available", F.lit(False))
        return there.unionByName(gone).select(F.lit(what).alias("what"), F.col(column).alias("name"), "available")

    shared = F.array_contains(in_both(F.array("name"), literal_list(SHARED_LANGUAGES)), F.col("name"))
    not_shared = F.size(missing_from(F.array("name"), literal_list(SHARED_LANGUAGES))) > 0
    languages = report("languages", asked, docs, "lang").withColumn("shared", shared & ~not_shared)
    others = report("voices", nations, customers, "name").unionByName(
        report("sources", docs.where("lang = 'de'"), docs.where("lang = 'fr'"), "source")
    )
    return languages.unionByName(others.withColumn("shared", F.lit(False)))


_EXPANDED = " UNION ALL ".join(
    f"SELECT source, slot, '{lang}' AS lang, coalesce(text_{lang}, '') AS text FROM wide" for lang in ALL_LANGS
)
_TEXTS = {lang: f"text_{lang}" for lang in ALL_LANGS}


@query(f"SELECT source, slot, lang, md5(text) AS text FROM ({_EXPANDED})", ("wide",))
def q_lang_expand(spark, sf_dir):
    long = expand_languages(wide(spark, sf_dir), _TEXTS, ["source", "slot"])
    return long.withColumn("text", F.md5("text"))


@query("SELECT source, slot, " + ", ".join(f"md5(text_{x}) AS text_{x}" for x in ALL_LANGS) + " FROM wide", ("wide",))
def q_lang_collapse(spark, sf_dir):
    """Fan out and back: the wide table again."""
    long = expand_languages(wide(spark, sf_dir), _TEXTS, ["source", "slot"])
    hashed = long.withColumn("text", F.md5(blank_to_null(F.col("text"))))
    return collapse_languages(hashed, ["source", "slot"], ALL_LANGS, "text", "text_")


@query(
    f"SELECT lang, count(*) FILTER (WHERE text <> '') AS filled, count(*) AS total FROM ({_EXPANDED}) GROUP BY 1",
    ("wide",),
)
def q_lang_coverage(spark, sf_dir):
    return language_coverage(wide(spark, sf_dir), _TEXTS)


_FIRST_TEN = """SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS sample_index, doc_id, text
                FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')
                QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 10"""


@query(
    """SELECT lang, row_number() OVER (PARTITION BY lang, doc_id // 1000 ORDER BY doc_id) - 1 AS sample_index, md5(text) AS text
       FROM documents""",
)
def q_catalogue(spark, sf_dir):
    """Catalogue files of all documents, one for each thousand ids and language, written and read back."""
    docs = table(spark, sf_dir, "documents").select("lang", F.floor(F.col("doc_id") / 1000).alias("block"), "doc_id", "text")
    # A file holds at most a thousand sentences of one language, however many documents there are.
    lists = docs.groupBy("block", "lang").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("rows"))
    catalogue = lists.select("block", F.to_json(F.create_map("lang", F.col("rows.text"))).alias("value"), F.col("lang").alias("part"))
    path = new_folder(spark, "catalogue")
    catalogue.write.partitionBy("block", "part").text(path)
    return read_catalogue(spark, f"{path}/*/*").withColumn("text", F.md5("text"))


@query(
    """SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS sample_index, md5(text) AS text
       FROM documents""",
)
def q_catalogue_default(spark, sf_dir):
    """No catalogue file: the default table, here all documents numbered per language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    default = dense_positions(docs, "doc_id", ["lang"], "sample_index")
    catalogue = read_catalogue(spark, new_folder(spark, "absent"), default)
    return catalogue.withColumn("text", F.md5("text"))


_NAMES = ", ".join(f"('{code}', '{name}')" for code, name in LANGUAGE_NAMES.items())


@query(
    f"""WITH ten AS ({_FIRST_TEN}), names AS (SELECT * FROM (VALUES {_NAMES}) AS n(code, language_name))
        SELECT r_name AS speaker, lang, language_name, sample_index, doc_id,
               printf('%s_%s_%05d.wav', lower(r_name), lang, sample_index) AS file_name,
               'audio/' || lang || '/' || printf('%s_%s_%05d.wav', lower(r_name), lang, sample_index) AS audio_path
        FROM ten CROSS JOIN region JOIN names ON code = lang""",
)
def q_grid(spark, sf_dir):
    """Voices times languages times the first ten sentences. The five regions stand in for voices."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    voices = bounded_list(table(spark, sf_dir, "region"), "r_name")
    sentences = first_sentences(docs, ALL_LANGS, 10, "doc_id")
    grid = voice_grid(sentences, voices, LANGUAGE_NAMES)
    return grid.select("speaker", "lang", "language_name", "sample_index", "doc_id", "file_name", "audio_path")


@query(
    """SELECT lang, unnest(list_transform(string_split(lang || ', ' || source || ' ,' || doc_id, ','), lambda x: trim(x))) AS part FROM documents""",
)
def q_split_list(spark, sf_dir):
    """Comma lists taken apart, without the white space around each part."""
    lists = F.concat("lang", F.lit(", "), "source", F.lit(" ,"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("lang", F.explode(split_list(lists)).alias("part"))
