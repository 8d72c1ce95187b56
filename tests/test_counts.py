import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import counts, keyed, tokens
from tidemark.plans import measure
from tidemark.sources import text

SAMPLE = b"I am alpha beta alpha beta\r\nok ok ok"


@pytest.fixture
def sample(tmp_path):
    path = tmp_path / "sample.txt"
    path.write_bytes(SAMPLE)
    return str(path)


def test_sample_text(spark, sample):
    counted = counts.word_count(tokens.words(text.read_lines(spark, sample)))
    want = {"I": 1, "am": 1, "alpha": 2, "beta": 2, "ok": 3}
    assert dict(counted.collect()) == want
    lines = {r.line for r in counts.formatted(counted).collect()}
    assert lines == {f"{w} : {c}" for w, c in want.items()}


@pytest.mark.parametrize("group_rows", [10**6, 5])
def test_running_count(table, group_rows):
    words = ["a", "b", "a", "clear", "", "a", "A", "b"] * 20
    df = table([(w, i) for i, w in enumerate(words)], "word string, seq bigint").repartition(3)
    layout = measure(df, "word", "seq", group_rows=group_rows)
    assert bool(layout.heavy) == (group_rows == 5)
    seen, want = Counter(), []
    for i, w in enumerate(words):
        seen[w] += 1
        want.append((i, w, seen[w]))
    got = counts.running_count(df, layout).select("seq", "word", "count").collect()
    assert sorted(map(tuple, got)) == want


def test_tumbling_count(table):
    df = table(
        [("a", 0, 2), ("a", 4, 3), ("a", 5, 1), ("b", 4, 1)], "word string, s bigint, n bigint"
    ).withColumn("ts", F.timestamp_seconds("s"))
    got = counts.tumbling_count(df, n="n").select(
        F.unix_seconds("window_start"), "word", "count"
    )
    assert sorted(map(tuple, got.collect())) == [(0, "a", 5), (0, "b", 1), (5, "a", 1)]
    assert {r["count"] for r in counts.tumbling_count(df).collect()} == {1, 2}


@pytest.fixture
def small_splits(spark):
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4096")
    yield
    spark.conf.set(setting, before)


def test_ordered_lines_of_a_split_file(spark, tmp_path, small_splits):
    lines = [f"line {i} " + "x" * (i % 7) for i in range(3000)] + ["", "", "end"]
    path = tmp_path / "long.txt"
    path.write_text("\n".join(lines))
    got = text.read_ordered_lines(spark, str(path)).orderBy(*text.LINE_ORDER).collect()
    assert [r.value for r in got] == lines
    assert len({r.start for r in got}) > 5


@pytest.mark.parametrize("group_rows", [10**6, 100])
def test_sums_over_text_files_in_order(spark, tmp_path, small_splits, group_rows):
    rng = random.Random(5)
    for name, size in (("a", 4000), ("b", 30)):
        items = [rng.choice(["clear", "x", *"123456789"]) for _ in range(size)]
        lines = [" ".join(items[i : i + 5]) for i in range(0, size, 5)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines))
    files = [str(tmp_path / f"{name}.txt") for name in "ab"]
    numbers = tokens.numbers(tokens.tokens(text.read_ordered_lines(spark, files)))
    layout = measure(numbers, "file", text.TOKEN_ORDER, group_rows=group_rows)
    assert bool(layout.heavy) == (group_rows == 100)
    sums = keyed.resettable_sum(numbers, layout).orderBy("file", *text.TOKEN_ORDER)
    want = []
    for path in files:
        total = 0
        for token in open(path).read().split():
            total = 0 if token == "clear" else total + int(token) if token != "x" else total
            if token not in ("clear", "x"):
                want.append((int(token), total))
    assert [(r.n, r.total) for r in sums.collect()] == want
