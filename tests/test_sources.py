from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weftline.operators.vocab import vocab_from_csv
from weftline.session import scratch_path
from weftline.sources.corpus import document_groups, document_lines, group_lines, text_file_lines
from weftline.sources.embeddings import read_embedding_csv, write_embedding_csv
from weftline.sources.rowindex import number_sorted_rows

TEXTS = ["one\ntwo\n\nfour", "", "\n\n\n", "\n".join(f"line {i}" for i in range(25)), "ends with\n"]


def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_document_lines_keep_blank_lines(spark):
    rows = document_lines(documents(spark)).collect()
    expected = [(d, i, line) for d, text in enumerate(TEXTS) for i, line in enumerate(text.split("\n"))]
    assert sorted(map(tuple, rows)) == sorted(expected)


@pytest.mark.parametrize("n", [1, 3, 10])
def test_groups_in_a_row_equal_groups_by_shuffle(spark, n):
    inside = document_groups(documents(spark), n)
    shuffled = group_lines(document_lines(documents(spark)).repartition(5), n)
    expected = []
    for d, text in enumerate(TEXTS):
        lines = text.split("\n")
        expected += [(d, g, "\n".join(lines[g * n : g * n + n])) for g in range(-(-len(lines) // n))]
    assert sorted(map(tuple, inside.collect())) == sorted(expected)
    assert sorted(map(tuple, shuffled.collect())) == sorted(expected)


def test_file_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    (tmp_path / "b.txt").write_text("".join(f"b{i:05d}\n" for i in range(3000)))
    (tmp_path / "a.txt").write_text("".join(f"a{i}\n" for i in range(700)))
    (tmp_path / "c.txt").write_text("c\n\nlast without line feed")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        rows = text_file_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [f"a{i}" for i in range(700)] + [f"b{i:05d}" for i in range(3000)] + ["c", "", "last without line feed"]
    assert sorted(map(tuple, rows)) == list(enumerate(expected))


def test_sorted_rows_get_dense_numbers(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), (F.col("id") % 3).alias("y"))
    numbered = number_sorted_rows(rows, [F.desc("y"), F.asc("x")], "place").collect()
    order = sorted(((r["x"], r["y"]) for r in numbered), key=lambda r: (-r[1], r[0]))
    assert [(r["x"], r["y"]) for r in sorted(numbered, key=lambda r: r["place"])] == order
    assert sorted(r["place"] for r in numbered) == list(range(5000))


def write(tmp_path, text):
    path = tmp_path / "embeddings.csv"
    path.write_text(text)
    return str(path)


HEADER = "word,embeddings,word1,word2,word3,word4\n"


def test_csv_rows_in_file_order(spark, tmp_path):
    path = write(tmp_path, HEADER + 'new,1.5;-2,a,b,c,d\n"a,b",0;1e-3,a,b,c,d\n007,3;4,a,b,c,d\n')
    rows = read_embedding_csv(spark, path, 2).orderBy("row_no").collect()
    assert [(r["row_no"], r["token"]) for r in rows] == [(0, "new"), (1, "a,b"), (2, "007")]
    assert [[round(x, 6) for x in r["vector"]] for r in rows] == [[1.5, -2.0], [0.0, 0.001], [3.0, 4.0]]


def test_last_of_equal_csv_tokens_wins(spark, tmp_path):
    path = write(tmp_path, HEADER + "x,1;1,a,b,c,d\ny,2;2,a,b,c,d\nx,3;3,a,b,c,d\n")
    rows = vocab_from_csv(read_embedding_csv(spark, path, 2)).collect()
    assert sorted((r["token"], r["token_index"], list(r["vector"])) for r in rows) == [
        ("x", 2, [3.0, 3.0]), ("y", 1, [2.0, 2.0]),
    ]


def test_wrong_vector_length_fails(spark, tmp_path):
    path = write(tmp_path, HEADER + "x,1;1;1,a,b,c,d\n")
    with pytest.raises(Exception, match="vector length is not 2"):
        read_embedding_csv(spark, path, 2).collect()


def test_csv_round_trip_of_awkward_tokens(spark):
    tokens = ['quo"te', "back\\slash", "comma,", "line\nfeed", " spaced ", "007", "é|ß", '"', "\\"]
    rows = [(t, i, [float(i), 0.1, -1e-30]) for i, t in enumerate(tokens)]
    table = spark.createDataFrame(rows, "token string, token_index long, vector array<float>")
    path = scratch_path(spark, "csv-test")
    write_embedding_csv(table, path, "token_index")
    back = read_embedding_csv(spark, path, 3, extra_columns=0, multi_line=True).orderBy("row_no")
    want = table.orderBy("token_index").select("token_index", "token", "vector")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in want.collect()]


def test_file_numbers_do_not_depend_on_how_a_later_scan_packs_files(spark, tmp_path):
    for file in range(12):
        (tmp_path / f"part-{file:02d}.txt").write_text("".join(f"{file}-{line}\n" for line in range(7)))
    settings = {"spark.sql.files.minPartitionNum": "16", "spark.sql.files.openCostInBytes": "1"}
    numbered = text_file_lines(spark, str(tmp_path))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = {r["line_no"]: r["line"] for r in numbered.collect()}
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert rows == {7 * file + line: f"{file}-{line}" for file in range(12) for line in range(7)}


def test_file_numbers_write_nothing_and_shuffle_counts_only(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for file in range(5):
        (folder / f"{file}.txt").write_text("".join(f"{file}-{line}\n" for line in range(100)))
    root = Path(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")) / "weftline"
    before = set(root.iterdir()) if root.exists() else set()
    numbered = text_file_lines(spark, str(folder))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert numbered.count() == 500
    assert (set(root.iterdir()) if root.exists() else set()) == before
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert exchanges and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("size", ["64", "1000", "134217728"])
def test_file_numbers_under_any_cut(spark, tmp_path, size):
    for file in range(3):
        (tmp_path / f"{file}.txt").write_text("".join(f"{file}-{'x' * (line % 90)}-{line}\n" for line in range(400 * file)))
    numbered = text_file_lines(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = sorted(map(tuple, numbered.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == list(enumerate(f"{file}-{'x' * (line % 90)}-{line}" for file in range(3) for line in range(400 * file)))


def test_file_numbers_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("".join(f"{line}\n" for line in range(3000)))
    (tmp_path / "b.txt").write_text("")
    monkeypatch.setattr("weftline.session.BROADCAST_LIMIT_BYTES", 0)
    rows = sorted(map(tuple, text_file_lines(spark, str(tmp_path)).collect()))
    assert rows == [(i, str(i)) for i in range(3000)]
