"""CSV records with line ends in quoted fields, read in splits, against Python's csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest

from shopline.schemas import SALES
from shopline.sources import csv as source

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def split(spark):
    """Sets the size of a split; small ones cut records."""
    yield lambda n: spark.conf.set(SPLIT, str(n))
    spark.conf.unset(SPLIT)


def some_rows(seed: int, n: int, newlines: float) -> list[list[str]]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice('abcé漢 ,;"') for _ in range(rng.randrange(0, 9)))
    text = lambda: rng.choice(["\n", "\n\n", "\r\n", '"\n"', ","]).join(word() for _ in range(rng.randrange(1, 6))) if rng.random() < newlines else word()
    return [[str(i), text(), str(rng.random()), text()] for i in range(n)]


def parsed(df) -> list[list[str]]:
    """Each record's fields by Python's reader, sorted."""
    records = [r["value"] for r in df.collect()]
    assert all(len(list(csv.reader(io.StringIO(v, newline="")))) == 1 for v in records if v)
    return sorted(next(iter(csv.reader(io.StringIO(v, newline="")))) for v in records if v)


def written(path: str, rows: list[list[str]], end: str = "\n", header: str | None = None) -> None:
    with open(path, "w", newline="", encoding="utf-8") as f:
        if header:
            f.write(header + end)
        csv.writer(f, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("seed, newlines, end", [(1, 0.5, "\n"), (2, 0.02, "\n"), (3, 0.0, "\n"), (4, 0.4, "\r\n"), (5, 1.0, "\n")])
def test_records_equal_pythons_reader(spark, tmp_dir, split, seed, newlines, end):
    rows = some_rows(seed, 400, newlines)
    written(f"{tmp_dir}/a.csv", rows, end)
    for size in (97, 1000, 1 << 20):
        split(size)
        df = source.read_records(spark, f"{tmp_dir}/a.csv")
        assert size > 97 or spark.read.text(f"{tmp_dir}/a.csv").rdd.getNumPartitions() > 8
        assert parsed(df) == sorted(rows)


def test_field_longer_than_many_splits(spark, tmp_dir, split):
    rows = [["0", "x"], ["1", "line\n" * 3000 + '"end"\n'], ["2", "y"], ["3", "\n" * 500], ["4", ""]]
    written(f"{tmp_dir}/a.csv", rows)
    split(1000)
    assert parsed(source.read_records(spark, f"{tmp_dir}/a.csv")) == sorted(rows)


def test_several_files_with_headers(spark, tmp_dir, split):
    """Only the first line of a file is its header; equal text elsewhere is data."""
    import os
    os.makedirs(f"{tmp_dir}/in")
    every = []
    for i in range(5):
        rows = some_rows(10 + i, 60, 0.3 * (i % 2)) + [["k", "t", "v", "u"]]
        written(f"{tmp_dir}/in/{i}.csv", rows, header="k,t,v,u")
        every += rows
    open(f"{tmp_dir}/in/empty.csv", "w").close()
    for size in (150, 1 << 20):
        split(size)
        assert parsed(source.read_records(spark, f"{tmp_dir}/in", header="k,t,v,u")) == sorted(every)


def test_open_quote_at_the_end_and_empty_files(spark, tmp_dir, split):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('1,a\n2,"never\nclosed\n3,b\n')
    split(5)
    assert sorted(r["value"] for r in source.read_records(spark, f"{tmp_dir}/a.csv").collect()) == ["1,a", '2,"never\nclosed\n3,b']
    open(f"{tmp_dir}/none.csv", "w").close()
    assert source.read_records(spark, f"{tmp_dir}/none.csv", header="x").collect() == []


def test_sales_with_line_ends_and_double_encoding(spark, tmp_dir, split):
    """Typed rows: families over several lines, some records wrapped as one quoted field."""
    rows = [(i, "2013-01-02", i % 7, f'GROCERY "{i}"\nII, {i}\r\nend' if i % 3 else "BREAD", i / 4, i % 2) for i in range(300)]
    with open(f"{tmp_dir}/train.csv", "w", newline="") as f:
        f.write(",".join(SALES.fieldNames()) + "\n")
        for r in rows:
            line = io.StringIO(newline="")
            csv.writer(line, lineterminator="").writerow(r)
            text = line.getvalue()
            f.write(('"' + text.replace('"', '""') + '"' if r[0] % 5 == 0 else text) + "\n")
    for size in (300, 1 << 20):
        split(size)
        got = source.read_sales_csv(spark, f"{tmp_dir}/train.csv", keep_flag=True).collect()
        assert sorted((r["id"], str(r["date"]), r["store_nbr"], r["family"], r["sales"], r["onpromotion"], r["repaired"]) for r in got) == [
            (*r, r[0] % 5 == 0) for r in rows]


@pytest.mark.parametrize("line, wrapped", [('"a"', True), ('"a,""b"""', True), ('""', True), ('"', False), ('a', False), ('"a","b"', False), ('"a"b"', False),
                                           ('""""', True), ('"""', False), ('"' + 'x""' * 30_000 + '"', True), ('"a\nb"', True), ("", False)])
def test_wrapped_lines(spark, line, wrapped):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(source.is_wrapped(F.col("value"))).first()[0] is wrapped


def test_lines_of_records_are_not_shuffled(spark, tmp_dir, split):
    """Only the pieces at the borders of splits are: what is shuffled doesn't grow with the lines of a split."""
    def shuffled(lines: int) -> int:
        rows = [[str(i), f'a\n"{i}"\n\nend' if i % 2 else "a", "x" * 40] for i in range(lines)]
        written(f"{tmp_dir}/{lines}.csv", rows)
        split(1 << 30)
        df = source.read_records(spark, f"{tmp_dir}/{lines}.csv")
        assert parsed(df) == sorted(rows)
        plan = df._jdf.queryExecution().executedPlan()
        stack, total = [plan], 0
        while stack:
            node = stack.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                stack.append(node.executedPlan())
                continue
            if node.nodeName().endswith("QueryStage"):
                stack.append(node.plan())
                continue
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            stack += [node.children().apply(i) for i in range(node.children().size())]
        return total
    assert shuffled(50) == shuffled(2000) <= 2
