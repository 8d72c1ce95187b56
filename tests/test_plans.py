"""What the plans must look like: one exchange, splits for heavy keys, pruned scans."""

import re

import pytest
from model import number_stream
from pyspark.sql import functions as F

from tidemark.operators import counts, keyed, tokens, vocabulary
from tidemark.plans import Layout, measure
from tidemark.plans.layout import GROUP_ROWS, HEAVY, SLOTS, slots_for
from tidemark.session import scratch_folder
from tidemark.sources.tables import event_tokens, read_table

SF = "/root/testdata/sf0.001"
LIGHT = Layout(("key",), ("seq",))


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def final_plan(df, capsys):
    df.collect()
    return plan(df, capsys).split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "operator",
    [
        keyed.resettable_sum,
        keyed.running_average,
        keyed.pair_average,
        keyed.value_state,
        keyed.list_state,
        keyed.reducing_state,
        keyed.map_state,
        keyed.keyed_latest,
    ],
)
def test_light_keys_take_one_exchange(spark, capsys, operator):
    numbers = tokens.numbers(event_tokens(read_table(spark, SF, "events")))
    text = plan(operator(numbers, LIGHT), capsys)
    assert text.count("Exchange") == 1
    assert "Join" not in text


def test_vocabulary_takes_one_exchange(spark, capsys):
    words = read_table(spark, SF, "events").select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.col("event_type").alias("word")
    )
    assert plan(vocabulary.vocabulary(words, LIGHT), capsys).count("Exchange") == 1


def test_word_count_reads_one_column_and_counts_before_the_shuffle(spark, capsys):
    text = plan(counts.word_count(tokens.words(read_table(spark, SF, "documents"), "text")), capsys)
    assert "ReadSchema: struct<text:string>" in text
    assert text.index("partial_count") > text.index("Exchange")  # printed top down
    assert text.count("Exchange") == 1


def test_last_input_reduces_before_the_shuffle(spark, capsys):
    numbers = tokens.numbers(event_tokens(read_table(spark, SF, "events")))
    text = plan(keyed.last_input(numbers, "key"), capsys)
    assert "partial_max_by" in text and text.count("Exchange") == 1


def test_heavy_rows_are_shuffled_once_by_key_and_chunk(table, capsys):
    df = table(number_stream(1), "key bigint, seq bigint, n bigint")
    layout = measure(df, "key", "seq", group_rows=200)
    text = final_plan(keyed.resettable_sum(df, layout), capsys)
    built = re.findall(r"- Exchange hashpartitioning\((.*?), \d+\), REPARTITION", text)
    assert len(built) == 2  # the light keys; the heavy ones by key and chunk
    assert sum("__chunk" in columns for columns in built) == 1
    assert "ReusedExchange" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_measure_finds_the_hot_key(table):
    df = table(number_stream(1), "key bigint, seq bigint, n bigint")
    layout = measure(df, "key", "seq", group_rows=200)
    assert len(layout.heavy) == 1
    sizes = df.filter(layout.is_heavy()).groupBy(layout.chunk()).count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) <= 400
    assert not measure(df, "key", "seq").heavy
    assert measure(df, (), "seq", min_parts=16).heavy


def test_the_limit_of_a_heavy_slot_does_not_grow():
    for rows in (10**6, 10**9, 10**12):
        assert HEAVY * rows / slots_for(rows, GROUP_ROWS) <= max(GROUP_ROWS, HEAVY * rows / SLOTS)
    assert slots_for(10**12, GROUP_ROWS) * GROUP_ROWS >= HEAVY * 10**12
    assert slots_for(10**6, 5) == SLOTS


def test_chunks_stay_small_where_rows_are_dense(table):
    """Nine tenths of a key's rows lie in a hundredth of its range."""
    rows = [(1, i * 1000) for i in range(1000)] + [(1, 500_000 + i) for i in range(1, 9000)]
    rows = sorted({(k, s) for k, s in rows})
    layout = measure(table(rows, "key bigint, seq bigint"), "key", "seq", group_rows=100)
    df = table(rows, "key bigint, seq bigint")
    sizes = [r["count"] for r in df.groupBy(layout.chunk()).count().collect()]
    assert max(sizes) <= 200


class Session:
    def __init__(self, **conf):
        self.conf = self
        self.settings = {name.replace("_", "."): value for name, value in conf.items()}

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_scratch_folder_follows_the_setting(spark):
    cluster = Session(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    first, second = scratch_folder(cluster, "x"), scratch_folder(cluster, "x")
    assert first.startswith("hdfs://shared/x-") and first != second
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_folder(Session(spark_master="yarn"), "x")
    assert scratch_folder(spark, "x")
