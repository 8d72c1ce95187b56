import pytest
from model import Words, run, word_stream

from tidemark.operators import vocabulary as V
from tidemark.plans import Layout, measure

SCHEMA = "key bigint, seq bigint, word string"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a b a", [(2, "a"), (1, "b")]),
        ("a clearstate b", [(1, "b")]),
        ("clearstate a", [(1, "clearstate"), (1, "a")]),
        ("a clearstate clearstate b", [(1, "clearstate"), (1, "b")]),
    ],
)
def test_hand_traces(table, text, want):
    df = table([(1, i, w) for i, w in enumerate(text.split())], SCHEMA)
    got = V.vocabulary(df, Layout(("key",), ("seq",))).orderBy("pos").collect()
    assert [(r["count"], r.word) for r in got] == want


@pytest.mark.parametrize("group_rows", [10**6, 200, 3])
def test_random_streams(table, group_rows):
    rows = word_stream(7)
    df, models = table(rows, SCHEMA).repartition(4), run(Words, rows)
    layout = measure(df, "key", "seq", group_rows=group_rows)
    assert bool(layout.heavy) == (group_rows < 10**6)
    got = V.vocabulary(df, layout).select("key", "pos", "word", "count")
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        (k, i, w, c) for k, m in models.items() for i, (c, w) in enumerate(m.entries)
    )
    got = V.accepted_words(df, layout).select("key", "seq", "word")
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        (k, seq, w) for k, m in models.items() for seq, w in m.out
    )
