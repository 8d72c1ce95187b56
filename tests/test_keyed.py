import pytest
from model import Sums, number_stream, run
from pyspark.sql import functions as F

from tidemark.operators import keyed
from tidemark.plans import Layout, measure

SCHEMA = "key bigint, seq bigint, n bigint"


def stream(*numbers):
    return [(1, i, n) for i, n in enumerate(numbers)]


@pytest.fixture(params=["whole", "split", "split finely"])
def layout_for(request):
    """Layouts that keep keys whole, cut the hot key, or cut nearly every key."""

    def make(df, keys="key", order="seq"):
        if request.param == "whole":
            return measure(df, keys, order)
        layout = measure(df, keys, order, group_rows=200 if request.param == "split" else 3)
        assert layout.heavy
        return layout

    return make


def expected(rows):
    return run(Sums, rows)


def flat(models, attribute):
    return sorted(
        ((k, *row) for k, m in models.items() for row in getattr(m, attribute)), key=repr
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=[1, 2], ids=["keys", "null key"])
def case(request, table):
    rows = number_stream(request.param, null_key=request.param == 2)
    return table(rows, SCHEMA).repartition(5), expected(rows)


def test_hand_trace(table, collected):
    layout = Layout(("key",), ("seq",))

    def states(*numbers):
        df = table(stream(*numbers), SCHEMA)
        return (
            [r.total for r in keyed.resettable_sum(df, layout).orderBy("seq").collect()],
            [r.value for r in keyed.value_state(df, layout).collect()],
            [r.n for r in keyed.list_state(df, layout).orderBy("pos").collect()],
            [r.value for r in keyed.reducing_state(df, layout).collect()],
            [r.value for r in keyed.keyed_latest(df, layout).collect()],
        )

    assert states(1, 2, 3) == ([1, 3, 6], [6], [1, 2, 3], [6], [6])
    assert states(1, 2, 3, -1) == ([1, 3, 6], [0], [], [], [6])
    assert states(1, 2, 3, -1, 4, 5) == ([1, 3, 6, 4, 9], [9], [4, 5], [9], [9])


def test_sample_pairs(table):
    df = table(stream(3, 5, 7, 4, 2), SCHEMA)
    layout = Layout(("key",), ("seq",))
    average = keyed.running_average(df, layout).orderBy("seq").collect()
    assert [r.avg for r in average] == [4.0, 5.0, 4.75, 4.2]
    assert [r.avg for r in keyed.pair_average(df, layout).orderBy("seq").collect()] == [4.0, 5.5]
    sums = keyed.resettable_sum(df, layout).orderBy("seq").collect()
    assert [r.total for r in sums] == [3, 8, 15, 19, 21]
    labelled = keyed.labelled_inputs(df).orderBy("seq").collect()
    assert [(r.n, r.label) for r in labelled] == [(n, "avg") for n in (3, 5, 7, 4, 2)]
    assert keyed.last_input(keyed.labelled_inputs(df), "label").first().value == 2


def test_resettable_sum(case, layout_for):
    df, models = case
    got = keyed.resettable_sum(df, layout_for(df)).select("key", "seq", "n", "total")
    assert rows_of(got) == flat(models, "out")


def test_averages(case, layout_for):
    df, models = case
    layout = layout_for(df)
    got = rows_of(keyed.running_average(df, layout).select("key", "seq", "avg"))
    assert got == flat(models, "averages")
    got = rows_of(keyed.pair_average(df, layout).select("key", "seq", "avg"))
    assert got == flat(models, "pairs")


def test_final_states(case, layout_for):
    df, models = case
    layout = layout_for(df)
    live = {k: m.items for k, m in models.items()}
    got = rows_of(keyed.value_state(df, layout).select("key", "value"))
    assert got == sorted(((k, sum(v)) for k, v in live.items()), key=repr)
    got = rows_of(keyed.list_state(df, layout).select("key", "pos", "n"))
    assert got == sorted(((k, i, n) for k, v in live.items() for i, n in enumerate(v)), key=repr)
    got = rows_of(keyed.reducing_state(df, layout).select("key", "value"))
    assert got == sorted(((k, sum(v)) for k, v in live.items() if v), key=repr)
    got = rows_of(keyed.keyed_latest(df, layout).select("key", "value"))
    want = ((k, m.latest) for k, m in models.items() if m.latest is not None)
    assert got == sorted(want, key=repr)


def test_snapshot(table, layout_for):
    rows = number_stream(3)
    df, models = table(rows, SCHEMA), expected(rows)
    want = []
    for k, m in models.items():
        total, some = sum(m.items), bool(m.items)
        want.append(("value-query", k, None, None, total, True))
        want += [("list-query", k, i, None, n, True) for i, n in enumerate(m.items)]
        if not some:
            want.append(("list-query", k, None, None, None, False))
        held = total if some else None
        want.append(("map-query", k, None, str(k) if some else None, held, some))
        want.append(("reduce-query", k, None, None, held, some))
        want.append(("keyed-query", k, None, None, m.latest, m.latest is not None))
    got = keyed.state_snapshot(df, layout_for(df))
    assert rows_of(got) == sorted(want, key=repr)


def test_all_rows_as_one_stream(table, layout_for):
    rows = [(0, seq, n) for _, seq, n in number_stream(4)]
    df = table(rows, SCHEMA).drop("key")
    layout = layout_for(df, ())
    [model] = expected(rows).values()
    assert rows_of(keyed.resettable_sum(df, layout).select("seq", "n", "total")) == sorted(
        model.out, key=repr
    )
    assert rows_of(keyed.value_state(df, layout)) == [(sum(model.items),)]
    assert rows_of(keyed.map_state(df, layout)) == [("statekey", sum(model.items))]


def test_two_keys_and_two_order_columns(table, layout_for):
    rows = number_stream(5)
    df = table(rows, SCHEMA).select(
        F.col("key").alias("a"),
        F.concat(F.lit("k"), F.col("key").cast("string")).alias("b"),
        F.shiftright("seq", 3).alias("line"),
        F.col("seq").bitwiseAND(7).alias("pos"),
        "n",
    )
    layout = layout_for(df, ("a", "b"), ("line", "pos"))
    got = keyed.resettable_sum(df, layout).select(
        "a", (F.shiftleft("line", 3) + F.col("pos")).alias("seq"), "n", "total"
    )
    assert rows_of(got) == flat(expected(rows), "out")


def test_overflow_fails(table):
    df = table(stream(2**62, 2**62), SCHEMA)
    with pytest.raises(Exception, match="OVERFLOW"):
        keyed.resettable_sum(df, Layout(("key",), ("seq",))).collect()
    big = table(stream(2**62, -1, 2**62, -1, 2**62), SCHEMA)
    sums = keyed.resettable_sum(big, Layout(("key",), ("seq",)))
    assert {r.total for r in sums.collect()} == {2**62}
    edge = table(stream(-(2**63), 2**63 - 1, 5, -1, 2**63 - 1, -(2**63), -7), SCHEMA)
    sums = keyed.resettable_sum(edge, Layout(("key",), ("seq",))).orderBy("seq")
    assert [r.total for r in sums.collect()] == [-(2**63), -1, 4, 2**63 - 1, -1, -8]


def test_no_rows(table):
    df = table([], SCHEMA)
    layout = measure(df, "key", "seq")
    assert not layout.heavy
    assert keyed.state_snapshot(df, layout).collect() == []
