"""Free-text CSV in splits: the same rows as one task's reading, wherever the splits fall."""

import random

import pytest
from pyspark.sql import functions as F

from reelhouse.plans.pipeline import SourceFiles
from reelhouse.sources import files, records

SCHEMA = files.TAGS_SCHEMA


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def delivered(seed, n, sep="\n"):
    r = random.Random(seed)
    out, rows = ["userId,movieId,tag,timestamp"], []
    for i in range(n):
        parts = [r.choice(["plain", 'a "quote"', "", "x,y", "é😀", '""', "word " * r.randint(1, 9)]) for _ in range(r.randint(1, 6))]
        text = r.choice(["\n", "\r\n", "\n\n", ", "]).join(parts) + "."
        if i % 97 == 5:
            text = ("long line " * 40 + "\n") * 30 + "end"      # spans several splits
        rows.append((i, i % 7, text, 1000 + i))
        out.append(f"{i},{i % 7},{quoted(text)},{1000 + i}")
        if i % 50 == 3:
            out.append("")                                       # empty lines between records
    return sep.join(out) + sep, rows


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "100",
             "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("sep", ["\n", "\r\n"])
def test_records_across_splits(spark, tmp_dir, small_splits, sep):
    want = []
    for f in range(2):
        text, rows = delivered(f, 400, sep)
        want += rows
        with open(f"{tmp_dir}/{f}.csv", "w", newline="", encoding="utf-8") as out:
            out.write(text)
    lines = records.split_lines(spark, tmp_dir)
    carry = records.split_carry(lines)
    assert carry.count() > 40 and carry.filter("open = 1").count() > 3
    got = records.scan_records(spark, tmp_dir, SCHEMA)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert records.rejected_records(spark, tmp_dir, SCHEMA).isEmpty()


def test_same_as_one_task_on_written_files(spark, tmp_dir, small_splits):
    df = spark.createDataFrame([(i, i % 9, None if i % 11 == 0 else f'{"t" * (i % 40)}\n"{i}",', i) for i in range(600)], SCHEMA)
    files.write_csv(df.coalesce(2), tmp_dir + "/tags")
    one = files.scan_tags(spark, tmp_dir + "/tags")
    split = records.scan_records(spark, tmp_dir + "/tags", SCHEMA)
    assert split.schema == one.schema and split.count() == 600
    assert split.exceptAll(one).isEmpty() and one.exceptAll(split).isEmpty()


def test_bad_and_empty_files(spark, tmp_dir, small_splits):
    with open(f"{tmp_dir}/a.csv", "w") as out:
        out.write('userId,movieId,tag,timestamp\n1,2,"a\nb",3\nx,2,t,3\n1,2\n4,5,,6\n1,2,"open,3\n7,8,z,9')
    open(f"{tmp_dir}/b.csv", "w").close()
    with open(f"{tmp_dir}/c.csv", "w") as out:
        out.write("userId,movieId,tag,timestamp")
    got = records.scan_records(spark, tmp_dir, SCHEMA)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2, "a\nb", 3), (4, 5, None, 6)]
    bad = records.rejected_records(spark, tmp_dir, SCHEMA)
    assert sorted(r.line for r in bad.collect()) == ["1,2", '1,2,"open,3\n7,8,z,9', "x,2,t,3"]
    assert bad.select(F.element_at(F.split("file", "/"), -1)).distinct().collect()[0][0] == "a.csv"


def test_sources_of_the_daily_run(spark, tmp_dir, small_splits):
    for name, text in (("ratings", "userId,movieId,rating,timestamp\n1,2,3.5,9\n"),
                       ("movies", 'movieId,title,genres\n1,"A, ""B""\nC (1999)",x|y\nq,D,z\n'),
                       ("tags", 'userId,movieId,tag,timestamp\n1,2,"t\n\nu",3\n'),
                       ("users", "user_id,membership_tier,region,device_preference,created_at\n1,basic,NA,tv,2020-01-01\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as out:
            out.write(text)
    paths = [f"{tmp_dir}/{n}.csv" for n in ("ratings", "movies", "tags", "users")]
    src = SourceFiles(*paths, "2020-02-01 00:00:00", split_text=True)
    assert [r.title for r in src.scan_movies(spark, src.movies).collect()] == ['A, "B"\nC (1999)']
    assert [(r.source, r.line) for r in src.rejected(spark).collect()] == [("movies", "q,D,z")]
    assert sorted(map(tuple, src.counts(spark).collect())) == sorted(
        map(tuple, SourceFiles(*paths, "2020-02-01 00:00:00").counts(spark).collect()))
    gone = SourceFiles(paths[0], tmp_dir + "/none", paths[2], paths[3], "2020-02-01 00:00:00", split_text=True)
    assert gone.rejected(spark).isEmpty()
