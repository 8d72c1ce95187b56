import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from model import split
from pyspark.sql import functions as F

from tidemark.functions import counted, guard_forbidden, parse_long, parse_marked, split_tokens
from tidemark.operators import tokens
from tidemark.plans import Layout, measure


def test_split_traces(table, collected):
    cases = {
        "a b": ["a", "b"],
        "": [""],
        "  ": [],
        " a  b ": ["", "a", "", "b"],
        "x\t\ty\r": ["x", "", "y"],
        "a\n": ["a"],
        "a \u0085": ["a", "\u0085"],
        "a b": ["a b"],
    }
    df = table([(line,) for line in cases], "value string")
    got = dict(df.select("value", split_tokens(F.col("value"))).collect())
    assert got == cases


@given(st.lists(st.text(alphabet="ab \t\n\r\x0b\f \u0085", max_size=12), min_size=1, max_size=60))
@settings(max_examples=8, deadline=None)
def test_split_random(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    for line, got in df.select("value", split_tokens(F.col("value"))).collect():
        assert got == split(line)


def test_parse(table):
    good = {"1": 1, "+1": 1, "-1": -1, "007": 7, "9223372036854775807": 2**63 - 1}
    bad = ["1.5", "1e3", "+", "-", "", "5L", " 5", "5 ", "9223372036854775808", "clear", "١"]
    df = table([(t,) for t in [*good, *bad]], "tok string")
    got = dict(df.select("tok", parse_long(F.col("tok"))).collect())
    assert got == good | dict.fromkeys(bad)
    got = dict(df.select("tok", parse_marked(F.col("tok"))).collect())
    assert got == good | dict.fromkeys(bad) | {"clear": -1}


def test_numbers_and_rejects_are_complements(table, collected):
    df = table(
        [("k", i, t) for i, t in enumerate("4 x 5 clear -1 1.5".split())] + [("k", 9, "")],
        "key string, seq bigint, tok string",
    )
    numbers, rejects = tokens.numbers(df), tokens.rejects(df)
    assert collected(numbers) == [("k", 0, 4), ("k", 2, 5), ("k", 3, -1), ("k", 4, -1)]
    assert collected(rejects) == [("k", 1, "x"), ("k", 5, "1.5"), ("k", 9, "")]


def test_tokens_keep_positions(table, collected):
    df = table([(1, " a  b "), (2, "")], "line bigint, value string")
    assert collected(tokens.tokens(df)) == [
        (1, 0, ""), (1, 1, "a"), (1, 2, ""), (1, 3, "b"), (2, 0, ""),
    ]


def test_guard_fails_on_the_forbidden_value_only(table):
    ok = table([(1,), (None,)], "n bigint").select(guard_forbidden(F.col("n")).alias("n"))
    assert {r.n for r in ok.collect()} == {1, None}
    with pytest.raises(Exception, match="not valid"):
        table([(155,)], "n bigint").select(guard_forbidden(F.col("n"))).collect()


def test_counted(table):
    df = table([("ok", 3)], "word string, count bigint")
    assert df.select(counted(F.col("word"), F.col("count"))).first()[0] == "ok : 3"


@pytest.mark.parametrize("split_it", [False, True])
def test_take_until(table, collected, split_it):
    rows = [(k, i, t) for k, text in {
        1: "a b quit c quit d", 2: "a b c", 3: "quit a", 4: "a b c d e f g quit",
    }.items() for i, t in enumerate(text.split())]
    df = table(rows, "key bigint, seq bigint, tok string")
    layout = measure(df, "key", "seq", group_rows=2) if split_it else Layout(("key",), ("seq",))
    assert bool(layout.heavy) == split_it
    got = collected(tokens.take_until(df, layout), "key", "tok")
    assert ["".join(t for k, t in got if k == key) for key in (1, 2, 3, 4)] == [
        "ab", "abc", "", "abcdefg",
    ]


def test_take_until_keeps_null_keys_and_needs_no_window(table, collected):
    rows = [(None, 0, "a"), (None, 1, "quit"), (None, 2, "b"), (1, 0, "quit"), (1, 1, "a"), (2, 0, None)]
    stream = table(rows, "key bigint, seq bigint, tok string")
    kept = tokens.take_until(stream, Layout(("key",), ("seq",)))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(None, 0, "a"), (2, 0, None)], key=repr)
    assert "Window" not in kept._jdf.queryExecution().toString()
    whole = tokens.take_until(stream.drop("key").filter("tok IS NOT NULL AND seq < 2"), Layout((), ("seq",)))
    assert whole.count() == 0
