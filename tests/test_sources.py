import os

from pyspark.sql import functions as F

from folio.functions.text import file_key
from folio.functions.tokens import pandas_token_counter
from folio.session import work_dir
from folio.sources.export import export, export_keys
from folio.sources.urllist import read_url_lines, read_url_list, read_url_run

SAMPLE = """# a comment
# another, with http://in.it

https://example.org/news/one
https://example.org/news/two
https://example.org/news/three
https://example.org/news/four
https://example.org/news/five
https://example.org/news/six


*** last line ***"""


def test_read_url_list_file(spark, tmp_path):
    path = os.path.join(tmp_path, "urls.txt")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(SAMPLE)
    out = read_url_list(spark, path).orderBy("line_no").collect()
    assert [r.url for r in out] == [f"https://example.org/news/{w}" for w in ("one", "two", "three", "four", "five", "six")]


def test_pandas_token_counter_hook(spark):
    counter = pandas_token_counter(lambda s: len(s.split()))
    df = spark.createDataFrame([("a b c",), ("",), (None,)], "t string")
    assert [r.n for r in df.select(counter(F.col("t")).alias("n")).collect()] == [3, 0, None]


def test_lines_are_numbered_over_files_and_splits(spark, tmp_path):
    """Several files of many splits each, read by fewer tasks than splits."""
    want = []
    for name, n in (("b.txt", 700), ("a.txt", 1500), ("c.txt", 0), ("d.txt", 3)):
        with open(os.path.join(tmp_path, name), "w", encoding="utf-8") as fh:
            fh.writelines(f"https://{name[0]}.example.org/story/{i}\n" for i in range(n))
    for name, n in (("a", 1500), ("b", 700), ("d", 3)):
        want += [(i, f"https://{name}.example.org/story/{i}") for i in range(n)]
    for most, cost in (("2k", "1k"), ("16k", "64"), ("128m", "4m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            rows = read_url_lines(spark, str(tmp_path)).orderBy("pos").collect()
            run = read_url_run(spark, str(tmp_path)).orderBy("pos").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert [(r.line_no, r.value) for r in rows] == want
        assert [r.pos for r in rows] == list(range(len(want))) and [r.url for r in run] == [v for _, v in want]


def test_export_keeps_names_apart(spark):
    path = work_dir(spark, "test-export")
    long = "https://x.org/" + "é" * 300
    rows = [(1, "a/b"), (2, "a:b"), (3, "a|b"), (4, None), (5, ""), (6, " . "), (7, long), (8, long + "x"), (9, "plain"), (10, "plain")] + [(n, "hot") for n in range(20, 320)]
    df = spark.createDataFrame(rows, "n long, name string")
    out = export(df, path, "name", max_rows=100)
    assert sorted((r.n, r.name) for r in out.collect()) == sorted(rows)
    keys = {r.name: r.file_key for r in export_keys(spark, path).collect()}
    assert len(keys) == len(set(keys.values())) == 9 and keys["a/b"] == "a_b" and keys["plain"] == "plain"
    assert len([f for f in out.inputFiles() if "file_key=hot/" in f]) >= 3
    # a later run with a name that comes before all others of its key: known names keep their folders
    more = spark.createDataFrame([(11, "a*b"), (12, "a/b")], "n long, name string")
    out = export(more, path, "name")
    assert {r.name: r.file_key for r in export_keys(spark, path).collect()}.items() >= keys.items()
    assert sorted((r.n, r.name) for r in out.where("n < 13").collect()) == sorted([(12, "a/b"), (11, "a*b"), *rows[1:10]])
    again = export(more, path, "name")
    assert again.count() == 300 + 11 and export_keys(spark, path).count() == 10
    assert df.where("n = 2").select(file_key(F.col("name")).alias("k")).first().k == "a_b"
