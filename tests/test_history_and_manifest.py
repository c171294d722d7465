"""What streams remember of earlier batches, and what writers remember of their files."""

import os

from pyspark.sql import functions as F

from speechset.functions.audio import AUDIO_TYPE
from speechset.sinks.audio_files import put_file
from speechset.sinks.file_manifest import check_files, hashed_path, write_with_manifest, written_files
from speechset.sources.files import list_files, present_files
from speechset.streaming.history import BLOCK_KEYS, finished_before, look_up, remember, remembered
from speechset.streaming.incremental import build_arrivals, read_batches
from tests.conftest import rows


def _keys(spark, *spans):
    return spark.createDataFrame([(f"k{i}",) for span in spans for i in span], "key string")


def test_history_is_exact_and_new_keys_read_nothing(spark, tmp_path):
    index = str(tmp_path / "index")
    assert finished_before(_keys(spark, range(5)), index, 0).count() == 0
    n = 3 * BLOCK_KEYS  # several blocks
    for batch in range(4):
        finished, read = look_up(_keys(spark, range(batch * n, (batch + 1) * n)), index, batch)
        assert finished.count() == 0 and read.count() == 0
        remember(_keys(spark, range(batch * n, (batch + 1) * n)), index, batch)
    assert remembered(spark, index) == {0, 1, 2, 3}
    finished, read = look_up(_keys(spark, range(n - 2, n + 1), range(10 * n, 11 * n)), index, 9)
    assert rows(finished) == [(f"k{i}",) for i in (n - 2, n - 1, n)] and read.count() == 2 * n
    # A batch that runs again does not find itself, and replaces what it left.
    assert finished_before(_keys(spark, range(n)), index, 0).count() == 0
    remember(_keys(spark, range(7), range(7)), index, 0)
    assert finished_before(_keys(spark, range(n)), index, 5).count() == 7


def test_odd_keys_in_the_history(spark, tmp_path):
    index = str(tmp_path / "index")
    odd = spark.createDataFrame([(None,), ("",), ("é",), ("é",)], "key string")
    remember(odd, index, 0)
    remember(odd.limit(0), index, 1)
    assert rows(finished_before(odd, index, 2)) == [("",), ("é",)]
    assert finished_before(odd.limit(0), index, 2).count() == 0


def test_batches_without_an_entry_are_added(spark, tmp_path):
    arrivals, output = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k bigint, m map<string,int>"

    def run(built):
        build_arrivals(spark, arrivals, schema, output, str(tmp_path / "ck"), lambda df: built.append(rows(df, "k")) or df.select("k"), key="k")

    some = spark.sql("SELECT id AS k, map('a', 1) AS m FROM range(4) UNION ALL SELECT NULL, map('b', 2)")
    some.write.mode("append").parquet(arrivals)
    seen = []
    run(seen)
    assert seen[-1] == sorted([(0,), (1,), (2,), (3,), (None,)], key=repr)
    store = f"{output}_index/filters/batch_id=0"
    for name in os.listdir(store):
        os.remove(f"{store}/{name}")  # a run that stopped before its entry was whole
    spark.sql("SELECT id AS k, map('a', 1) AS m FROM range(2, 6)").write.mode("append").parquet(arrivals)
    run(seen)
    assert seen[-1] == [(4,), (5,)] and read_batches(spark, output).count() == 7


def _clips(spark, n):
    clip = F.struct(F.array_repeat(F.lit(0.25), F.col("id").cast("int")).alias("array"), F.lit(8000).alias("sampling_rate"))
    return spark.range(n).select(F.format_string("c%d.wav", "id").alias("path"), F.when(F.col("id") != 2, clip).cast(AUDIO_TYPE).alias("audio"))


def test_manifest_and_folder_agree(spark, tmp_path):
    folder = str(tmp_path / "files")
    assert written_files(spark, folder).count() == 0 and check_files(spark, folder).count() == 0
    clips = _clips(spark, 6).withColumn("path", hashed_path(F.col("path"), 2))
    assert write_with_manifest(clips, folder).count() == 5  # a missing clip leaves no row
    assert check_files(spark, folder).count() == 0
    assert rows(written_files(spark, folder), "n_samples", "n_bytes") == [(n, 44 + 2 * n) for n in (0, 1, 3, 4, 5)]
    paths = [r.path for r in written_files(spark, folder).orderBy("n_samples").collect()]
    assert all(len(p.split("/")[0]) == 2 for p in paths) and rows(list_files(spark, folder), "path") == sorted([(p,) for p in paths], key=repr)
    os.remove(f"{folder}/{paths[3]}")
    open(f"{folder}/{paths[1]}", "ab").write(b"more")
    open(f"{folder}/extra.wav", "wb").write(b"x")
    assert rows(check_files(spark, folder)) == sorted([(paths[3], "missing"), (paths[1], "size"), ("extra.wav", "unlisted")], key=repr)
    longer = clips.withColumn("audio", F.struct(F.array_repeat(F.lit(0.5), 9).alias("array"), F.lit(8000).alias("sampling_rate")).cast(AUDIO_TYPE))
    write_with_manifest(longer, folder)
    assert rows(written_files(spark, folder).select("n_samples").distinct()) == [(9,)]
    assert rows(check_files(spark, folder)) == [("extra.wav", "unlisted")]


def test_presence_is_asked_for_path_by_path(spark, tmp_path):
    folder = str(tmp_path / "f")
    os.makedirs(f"{folder}/a b/é")
    open(f"{folder}/a b/é/x%20.wav", "wb").write(b"123")
    asked = spark.createDataFrame([("a b/é/x%20.wav",), ("a b",), ("none.wav",), ("",), (None,)], "path string")
    assert rows(present_files(asked, folder)) == [("a b/é/x%20.wav", 3)]


class _Remote:
    """A store of files in memory that notes what is done."""

    def __init__(self, kind):
        self.type_name, self.files, self.log = kind, {}, []

    def open_output_stream(self, path):
        import io

        store = self

        class Out(io.BytesIO):
            def close(self):
                store.files.setdefault(path, b"")
                store.files[path] = self.getvalue()
                super().close()

        return Out()

    def create_dir(self, path, recursive):
        pass

    def get_file_info(self, path):
        from types import SimpleNamespace

        from pyarrow.fs import FileType

        there = path in self.files
        return SimpleNamespace(type=FileType.File if there else FileType.NotFound, size=len(self.files.get(path, b"")))

    def delete_file(self, path):
        self.log.append(("delete", path.split(".")[-1]))
        del self.files[path]

    def move(self, a, b):
        assert b not in self.files
        self.files[b] = self.files.pop(a)


def test_a_doubled_task_takes_no_file_away():
    store = _Remote("hdfs")
    for _ in range(2):
        put_file(store, "d/x.wav", b"abc")
    assert store.files == {"d/x.wav": b"abc"} and store.log == [("delete", "part")]
    put_file(store, "d/x.wav", b"longer")
    assert store.files == {"d/x.wav": b"longer"}
    direct = _Remote("s3")
    for _ in range(2):
        put_file(direct, "d/x.wav", b"abc")
    assert direct.files == {"d/x.wav": b"abc"} and not direct.log


