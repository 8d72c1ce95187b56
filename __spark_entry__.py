"""Registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import counts, incremental, keyed, tokens, vocabulary  # noqa: E402
from tidemark.plans import measure  # noqa: E402
from tidemark.session import scratch_folder  # noqa: E402
from tidemark.functions import guard_forbidden  # noqa: E402
from tidemark.sources import text  # noqa: E402
from tidemark.sources.tables import (  # noqa: E402
    event_tokens,
    read_table,
    stream_events,
    stream_table,
    with_property,
)
from tidemark.streaming import operators as streams  # noqa: E402
from tidemark.streaming import run, state  # noqa: E402
from tidemark.streaming.batches import HeavySums  # noqa: E402
from tidemark.streaming.inputs import CountedWindows, QuitAll  # noqa: E402
from tidemark.streaming.published import KeyedTable  # noqa: E402

try:  # the corpus operators are an optional part
    import corpus_pipeline  # noqa: E402
    from tidemark.llm import queries as corpus  # noqa: E402
except ModuleNotFoundError as missing:  # any other failure is one
    if missing.name != "corpus_pipeline" and not str(missing.name).startswith("tidemark.llm"):
        raise
    corpus = corpus_pipeline = None

SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return resettable_sum(spark, SMOKE)


# --- inputs -----------------------------------------------------------------


def _events(spark, sf):
    return read_table(spark, sf, "events")


def _tokens(spark, sf):
    return event_tokens(_events(spark, sf))


def _numbers(spark, sf):
    return tokens.numbers(_tokens(spark, sf))


def _keyed(spark, sf, parts=1):
    """Numbers and their layout; the events hold no more of a key than numbers do.

    parts: cut keys that hold more than this share of the rows, also where they are short.
    """
    events = _events(spark, sf).select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"))
    return _numbers(spark, sf), measure(events, "key", "seq", min_parts=parts)


def _event_words(events):
    kind = F.col("event_type")
    word = F.when(kind == "error", "clearstate").otherwise(kind)
    return events.select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), word.alias("word")
    )


# --- batch queries ----------------------------------------------------------


def word_count(spark, sf):
    return counts.word_count(tokens.words(read_table(spark, sf, "documents"), "text"))


def word_count_formatted(spark, sf):
    return counts.formatted(word_count(spark, sf))


def line_tokens(spark, sf):
    lines = read_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return tokens.tokens(lines, "text")


def running_word_count(spark, sf):
    words = _events(spark, sf).select(
        F.col("event_type").alias("word"), F.col("event_id").alias("seq")
    )
    return counts.running_count(words, measure(words, "word", "seq"))


def tumbling_count(spark, sf):
    return counts.tumbling_count(_events(spark, sf), "event_type")


def parse_numbers(spark, sf):
    return _numbers(spark, sf)


def parse_rejects(spark, sf):
    return tokens.rejects(_tokens(spark, sf))


def _quits(events):
    quits = (F.col("event_type") == "purchase") & (F.col("k").try_cast("bigint") > 90)
    return with_property(events).select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        F.when(quits, "quit").otherwise(F.col("event_type")).alias("tok"),
    )


def take_until_quit(spark, sf):
    """A user's stream quits at their first purchase with k above 90."""
    rows = _quits(_events(spark, sf))
    return tokens.take_until(rows, measure(rows, "key", "seq"))


def guarded_numbers(spark, sf):
    """Numbers that would fail the query if the forbidden one were among them."""
    return _numbers(spark, sf).withColumn("n", guard_forbidden(F.col("n")))


def text_word_count(spark, sf):
    """Words of a text copy of the conversations, read back line by line."""
    folder = scratch_folder(spark, "lines")
    turns = read_table(spark, sf, "conversations").select("text").filter("text IS NOT NULL")
    turns.write.text(folder)
    return counts.word_count(tokens.words(text.read_lines(spark, folder)))


def resettable_sum(spark, sf):
    return keyed.resettable_sum(*_keyed(spark, sf))


def resettable_sum_chunked(spark, sf):
    """All numbers as one stream, cut into chunks also where it is short."""
    numbers = _numbers(spark, sf).select("seq", "n")
    layout = measure(_events(spark, sf).withColumnRenamed("event_id", "seq"), (), "seq", min_parts=16)
    return keyed.resettable_sum(numbers, layout)


def resettable_sum_resumed(spark, sf):
    """The sums of January's first half, then those of the rest from its state."""
    events = _events(spark, sf)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    rows, state = [], None
    for part in (early, ~early):
        numbers = tokens.numbers(event_tokens(events.filter(part)))
        layout = measure(numbers, "key", "seq")
        scanned = incremental.resume_sums(numbers, state, layout)
        state = incremental.state_after(scanned, layout)
        rows.append(incremental.emitted(scanned, layout))
    return rows[0].unionByName(rows[1])


def value_state(spark, sf):
    return keyed.value_state(*_keyed(spark, sf))


def list_state(spark, sf):
    return keyed.list_state(*_keyed(spark, sf))


def map_state(spark, sf):
    return keyed.map_state(*_keyed(spark, sf))


def reducing_state(spark, sf):
    return keyed.reducing_state(*_keyed(spark, sf))


def keyed_latest(spark, sf):
    return keyed.keyed_latest(*_keyed(spark, sf))


def labelled_inputs(spark, sf):
    return keyed.labelled_inputs(_numbers(spark, sf)).drop("key")


def last_input(spark, sf):
    return keyed.last_input(labelled_inputs(spark, sf), "label")


def state_snapshot(spark, sf):
    return keyed.state_snapshot(*_keyed(spark, sf))


def running_avg(spark, sf):
    return keyed.running_average(*_keyed(spark, sf))


def pair_avg(spark, sf):
    return keyed.pair_average(*_keyed(spark, sf))


def vocabulary_list(spark, sf):
    words = _event_words(_events(spark, sf))
    return vocabulary.vocabulary(words, measure(words, "key", "seq"))


def accepted_words(spark, sf):
    words = _event_words(_events(spark, sf))
    return vocabulary.accepted_words(words, measure(words, "key", "seq"))


# The same with every key of more than a 256th of the rows cut into chunks.
PARTS = 256


def resettable_sum_split(spark, sf):
    return keyed.resettable_sum(*_keyed(spark, sf, PARTS))


def list_state_split(spark, sf):
    return keyed.list_state(*_keyed(spark, sf, PARTS))


def state_snapshot_split(spark, sf):
    return keyed.state_snapshot(*_keyed(spark, sf, PARTS))


def running_avg_split(spark, sf):
    return keyed.running_average(*_keyed(spark, sf, PARTS))


def pair_avg_split(spark, sf):
    return keyed.pair_average(*_keyed(spark, sf, PARTS))


def vocabulary_split(spark, sf):
    words = _event_words(_events(spark, sf))
    return vocabulary.vocabulary(words, measure(words, "key", "seq", min_parts=PARTS))


# --- streaming queries ------------------------------------------------------


# Streams whose result depends on the order run in three micro-batches at least, with a
# restart before each but the first.
BATCHES = 3


def _folders(spark):
    base = scratch_folder(spark, "stream")
    return f"{base}/checkpoint", f"{base}/output"


def _run_events(spark, sf, writer, checkpoint, cuts=None):
    """Feeds the events to a stream in the order of their ids."""
    events = _events(spark, sf)
    if cuts is None:
        cuts = run.even_cuts(events, "event_id", least=BATCHES)
    run.run_in_order(writer, events, "event_id", cuts, scratch_folder(spark, "arrived"), checkpoint)


def _output_of(spark, sf, operator):
    """Rows that `operator`, a stream of a stream of events, emits."""
    checkpoint, output = _folders(spark)
    schemas = []

    def writer(events):
        stream = operator(events)
        schemas.append(stream.schema)
        return run.to_table(stream, output)

    _run_events(spark, sf, writer, checkpoint)
    return spark.read.schema(schemas[0]).parquet(output)


def _stream_numbers(events):
    return tokens.numbers(event_tokens(events))


def stream_word_count(spark, sf):
    """The state of a stream that counts the words of lines."""
    checkpoint, _ = _folders(spark)
    words = tokens.words(stream_table(spark, sf, "documents"), "text")
    run.run_available(run.to_state(streams.word_count(words)), checkpoint)
    stored = state.read_state(spark, checkpoint)
    return stored.select("key.word", "value.count")


def stream_running_word_count(spark, sf):
    def counted(events):
        words = events.select(F.col("event_type").alias("word"), F.col("event_id").alias("seq"))
        return streams.running_count(words)

    return _output_of(spark, sf, counted)


def stream_take_until_quit(spark, sf):
    return _output_of(spark, sf, lambda events: streams.take_until(_quits(events)))


def stream_tumbling_count(spark, sf):
    """Windows that the stream has closed, and those still open in its state.

    In one batch, since files of a table need not come in the order of time.
    """
    checkpoint, output = _folders(spark)
    stream = streams.tumbling_count(stream_events(spark, sf), "event_type", delay="0 seconds")
    run.run_available(run.to_table(stream, output), checkpoint)
    closed = spark.read.schema(stream.schema).parquet(output)
    still_open = state.read_state(spark, checkpoint).select(
        "key.window", "key.event_type", "value.count"
    )
    return closed.unionByName(still_open).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "count"
    )


def stream_last_input(spark, sf):
    checkpoint, _ = _folders(spark)
    inputs = _stream_numbers(stream_events(spark, sf)).withColumn("label", F.lit("avg"))
    run.run_available(run.to_state(streams.last_input(inputs, "label")), checkpoint)
    stored = state.read_state(spark, checkpoint)
    value = stored.schema["value"].dataType.names[0]
    return stored.select("key.label", F.col(f"value.{value}").alias("value"))


def _sums_state(spark, sf, keep_list=False, cuts=None, numbers=_stream_numbers):
    """Checkpoint of the streamed sums."""
    checkpoint, _ = _folders(spark)

    def writer(events):
        sums = streams.resettable_sum(numbers(events), keep_list=keep_list)
        return run.to_state(sums, "append")

    _run_events(spark, sf, writer, checkpoint, cuts)
    return checkpoint


def stream_resettable_sum(spark, sf):
    return _output_of(
        spark, sf, lambda events: streams.resettable_sum(_stream_numbers(events), keep_list=False)
    )


def _heavy_sums(spark, sf, numbers, parts, **keys):
    """Sums of `numbers` of the events, batch by batch, with heavy keys cut into chunks."""
    checkpoint, output = _folders(spark)
    sums = HeavySums(output, min_parts=parts, **keys)
    _run_events(spark, sf, lambda events: sums.writer(numbers(events)), checkpoint)
    return sums


def stream_resettable_sum_heavy(spark, sf):
    """All numbers under one constant key, which no task holds whole."""

    def constant(events):
        return _stream_numbers(events).withColumn("key", F.lit("all"))

    return _heavy_sums(spark, sf, constant, 16).emitted(spark).select("seq", "n", "total")


def stream_state_snapshot_heavy(spark, sf):
    """The five states of every user; a user of more than a 256th of a batch is cut."""
    return _heavy_sums(spark, sf, _stream_numbers, PARTS).snapshot(spark)


def stream_value_state(spark, sf):
    return state.value_state(spark, _sums_state(spark, sf))


def stream_value_state_past(spark, sf):
    """The sums as they were when the stream had seen the lower half of the ids."""
    middle = F.floor((F.min("event_id") + F.max("event_id")) / 2)
    cut = _events(spark, sf).agg(middle).first()[0]
    return state.value_state(spark, _sums_state(spark, sf, cuts=[cut]), batch=0)


def _middle(spark, sf):
    middle = F.floor((F.min("event_id") + F.max("event_id")) / 2)
    return _events(spark, sf).agg(middle).first()[0]


def stream_state_changes(spark, sf):
    """How each of two batches, cut in the middle of the ids, left the sums of its users."""
    checkpoint = _sums_state(spark, sf, cuts=[_middle(spark, sf)])
    rows = state.changes(spark, checkpoint, state.VALUE_STATE)
    return rows.select("batch", "key", "value", "size", "change")


def stream_resettable_sum_resumed(spark, sf):
    """The upper half of the ids in a new stream that starts from the state of the lower half."""
    middle = _middle(spark, sf)
    saved = state.saved_sums(spark, _sums_state(spark, sf, keep_list=True, cuts=[middle]), batch=0)
    later = _events(spark, sf).filter(F.col("event_id") > middle)
    checkpoint, output = _folders(spark)
    schemas = []

    def writer(events):
        stream = streams.resettable_sum(_stream_numbers(events), initial=saved)
        schemas.append(stream.schema)
        return run.to_table(stream, output)

    cuts = run.even_cuts(later, "event_id", least=2)
    run.run_in_order(writer, later, "event_id", cuts, scratch_folder(spark, "arrived"), checkpoint)
    return spark.read.schema(schemas[0]).parquet(output)


def stream_list_state(spark, sf):
    return state.list_state(spark, _sums_state(spark, sf, keep_list=True))


def stream_map_state(spark, sf):
    return state.map_state(spark, _sums_state(spark, sf))


def stream_state_snapshot(spark, sf):
    return state.snapshot(spark, _sums_state(spark, sf, keep_list=True))


def stream_lookup(spark, sf):
    """The five states of every user, and of as many keys that there are not."""
    users = F.array(F.col("user_id"), -1 - F.col("user_id"))
    keys = _events(spark, sf).select(F.explode(users).alias("key"))
    return state.lookup_many(keys, _sums_state(spark, sf, keep_list=True))


def stream_lookup_normalised(spark, sf):
    """The five states of every user, kept under a name that is asked for in capitals between blanks."""

    def named(events):
        return _stream_numbers(events).withColumn("key", F.concat(F.lit("user "), F.col("key").cast("string")))

    asked = F.concat(F.lit(" \t"), F.lit("USER "), F.col("user_id").cast("string"), F.lit("  "))
    checkpoint = _sums_state(spark, sf, keep_list=True, numbers=named)
    return state.lookup_many(_events(spark, sf).select(asked.alias("key")), checkpoint, normalise=True)


def _keyed_table(spark, sf):
    """The latest sum of every user, kept by upserts batch by batch."""
    checkpoint, output = _folders(spark)
    table = KeyedTable(output)

    def writer(events):
        return table.writer(streams.resettable_sum(_stream_numbers(events), keep_list=False))

    _run_events(spark, sf, writer, checkpoint)
    return table


def stream_keyed_table(spark, sf):
    return _keyed_table(spark, sf).table(spark)


def stream_lookup_point(spark, sf):
    """The latest sum of the user with the largest id, from the files of one slot."""
    user = _events(spark, sf).agg(F.max("user_id")).first()[0]
    return _keyed_table(spark, sf).lookup(spark, user)


def _all_quits(events):
    """Tokens of all users; the stream quits at the first purchase whose k is 99."""
    quits = (F.col("event_type") == "purchase") & (F.col("k").try_cast("bigint") == 99)
    return with_property(events).select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        F.when(quits, "quit").otherwise(F.col("event_type")).alias("tok"),
    )


def stream_quit_all(spark, sf):
    """Events of all users before the first marker of any of them."""
    checkpoint, output = _folders(spark)
    ending = QuitAll(output)
    _run_events(spark, sf, lambda events: ending.writer(_all_quits(events)), checkpoint)
    return ending.emitted(spark)


def stream_tumbling_count_late(spark, sf):
    """Windows fed in the order of event ids, not of time, with the rows that came too late."""
    checkpoint, output = _folders(spark)
    windows = CountedWindows(output, "0 seconds", "event_type")
    _run_events(spark, sf, windows.writer, checkpoint)
    late = windows.late(spark).groupBy(F.window(F.col("ts").cast("timestamp"), "5 seconds"), "event_type")
    late = late.agg(F.count("*").alias("count"))
    counted = windows.closed(spark).unionByName(windows.still_open(spark)).unionByName(late)
    start = F.col("window.start").cast("timestamp_ntz").alias("window_start")
    return counted.groupBy(start, "event_type").agg(F.sum("count").alias("count"))


def stream_running_avg(spark, sf):
    return _output_of(spark, sf, lambda events: streams.running_average(_stream_numbers(events)))


def stream_vocabulary(spark, sf):
    checkpoint, _ = _folders(spark)

    def writer(events):
        return run.to_state(streams.vocabulary(_event_words(events)), "append")

    _run_events(spark, sf, writer, checkpoint)
    return state.vocabulary(spark, checkpoint)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return stream_queries() | corpus_queries()


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**corpus.QUERIES, "pipeline": corpus_pipeline.run} if corpus else {}


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "word_count": word_count,
        "word_count_formatted": word_count_formatted,
        "tokens": line_tokens,
        "running_word_count": running_word_count,
        "tumbling_count": tumbling_count,
        "parse_numbers": parse_numbers,
        "parse_rejects": parse_rejects,
        "take_until_quit": take_until_quit,
        "resettable_sum": resettable_sum,
        "resettable_sum_chunked": resettable_sum_chunked,
        "resettable_sum_resumed": resettable_sum_resumed,
        "value_state": value_state,
        "list_state": list_state,
        "map_state": map_state,
        "reducing_state": reducing_state,
        "keyed_latest": keyed_latest,
        "labelled_inputs": labelled_inputs,
        "last_input": last_input,
        "state_snapshot": state_snapshot,
        "running_avg": running_avg,
        "pair_avg": pair_avg,
        "vocabulary": vocabulary_list,
        "accepted_words": accepted_words,
        "guarded_numbers": guarded_numbers,
        "text_word_count": text_word_count,
        "resettable_sum_split": resettable_sum_split,
        "list_state_split": list_state_split,
        "state_snapshot_split": state_snapshot_split,
        "running_avg_split": running_avg_split,
        "pair_avg_split": pair_avg_split,
        "vocabulary_split": vocabulary_split,
        "stream_word_count": stream_word_count,
        "stream_running_word_count": stream_running_word_count,
        "stream_take_until_quit": stream_take_until_quit,
        "stream_tumbling_count": stream_tumbling_count,
        "stream_last_input": stream_last_input,
        "stream_resettable_sum": stream_resettable_sum,
        "stream_resettable_sum_heavy": stream_resettable_sum_heavy,
        "stream_state_snapshot_heavy": stream_state_snapshot_heavy,
        "stream_value_state": stream_value_state,
        "stream_value_state_past": stream_value_state_past,
        "stream_state_changes": stream_state_changes,
        "stream_resettable_sum_resumed": stream_resettable_sum_resumed,
        "stream_lookup": stream_lookup,
        "stream_lookup_normalised": stream_lookup_normalised,
        "stream_lookup_point": stream_lookup_point,
        "stream_keyed_table": stream_keyed_table,
        "stream_quit_all": stream_quit_all,
        "stream_tumbling_count_late": stream_tumbling_count_late,
        "stream_list_state": stream_list_state,
        "stream_map_state": stream_map_state,
        "stream_state_snapshot": stream_state_snapshot,
        "stream_running_avg": stream_running_avg,
        "stream_vocabulary": stream_vocabulary,
    }


# --- the same in SQL --------------------------------------------------------

_BLANKS = r"E' \t\n\x0B\f\r'"
_SPLIT = rf"""
    CASE WHEN text = '' THEN ['']
         WHEN rtrim(text, {_BLANKS}) = '' THEN []
         ELSE regexp_split_to_array(rtrim(text, {_BLANKS}), '[ \t\n\x0B\f\r]')
    END"""

_WORDS = f"""
WITH words AS (SELECT unnest({_SPLIT}) AS word FROM documents)
"""

_TOKENS = """
WITH toks AS (
  SELECT user_id AS key, event_id AS seq,
         CASE event_type WHEN 'error' THEN 'clear'
                         WHEN 'view' THEN 'x' || event_id
                         ELSE json_extract_string(props, '$.k') END AS tok
  FROM events),
parsed AS (
  SELECT key, seq, tok,
         CASE WHEN tok = 'clear' THEN -1
              WHEN regexp_full_match(tok, '[+-]?[0-9]+') THEN TRY_CAST(tok AS BIGINT) END AS n
  FROM toks)
"""

_NUMBERS = _TOKENS + """,
num AS (SELECT key, seq, n FROM parsed WHERE n IS NOT NULL),
epochs AS (
  SELECT *, count(*) FILTER (n = -1)
              OVER (PARTITION BY key ORDER BY seq ROWS UNBOUNDED PRECEDING) AS epoch,
         count(*) FILTER (n = -1) OVER (PARTITION BY key) AS last_epoch
  FROM num),
sums AS (
  SELECT key, seq, n,
         CAST(sum(n) OVER run AS BIGINT) AS total,
         row_number() OVER run AS place,
         avg(n) OVER run AS avg,
         epoch, last_epoch
  FROM epochs WHERE n <> -1
  WINDOW run AS (PARTITION BY key, epoch ORDER BY seq ROWS UNBOUNDED PRECEDING)),
live AS (SELECT * FROM sums WHERE epoch = last_epoch),
current AS (SELECT key, CAST(sum(n) AS BIGINT) AS value FROM live GROUP BY key),
latest AS (SELECT key, arg_max(total, seq) AS value FROM sums GROUP BY key),
keys AS (SELECT DISTINCT key FROM num)
"""

_VALUE_STATE = _NUMBERS + """
SELECT key, coalesce(value, 0) AS value FROM keys LEFT JOIN current USING (key)"""

_LIST_STATE = _NUMBERS + "SELECT key, place - 1 AS pos, n FROM live"

_MAP_STATE = _NUMBERS + "SELECT key, CAST(key AS VARCHAR) AS map_key, value FROM current"

_SNAPSHOT = _NUMBERS + """
SELECT 'value-query' AS state_name, key, CAST(NULL AS BIGINT) AS pos,
       CAST(NULL AS VARCHAR) AS map_key, coalesce(value, 0) AS value, true AS found
FROM keys LEFT JOIN current USING (key)
UNION ALL
SELECT 'list-query', key, place - 1, NULL, n, n IS NOT NULL FROM keys LEFT JOIN live USING (key)
UNION ALL
SELECT 'map-query', key, NULL, CASE WHEN value IS NOT NULL THEN CAST(key AS VARCHAR) END, value,
       value IS NOT NULL
FROM keys LEFT JOIN current USING (key)
UNION ALL
SELECT 'reduce-query', key, NULL, NULL, value, value IS NOT NULL
FROM keys LEFT JOIN current USING (key)
UNION ALL
SELECT 'keyed-query', key, NULL, NULL, value, value IS NOT NULL
FROM keys LEFT JOIN latest USING (key)"""

_RUNNING_AVG = _NUMBERS + "SELECT key, seq, avg FROM sums WHERE place >= 2"

_LAST_INPUT = _NUMBERS + "SELECT 'avg' AS label, arg_max(n, seq) AS value FROM sums"

_WORD_STREAM = """
WITH words AS (
  SELECT user_id AS key, event_id AS seq,
         CASE event_type WHEN 'error' THEN 'clearstate' ELSE event_type END AS word
  FROM events),
filled AS (
  SELECT *, count(*) FILTER (word <> 'clearstate')
              OVER (PARTITION BY key ORDER BY seq ROWS UNBOUNDED PRECEDING) AS others
  FROM words),
runs AS (
  SELECT *, count(*) FILTER (word = 'clearstate')
              OVER (PARTITION BY key, others ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run
  FROM filled),
marked AS (
  SELECT *, word = 'clearstate' AND (run % 2 = 1) = (others > 0) AS clears FROM runs),
ends AS (SELECT key, max(seq) AS cleared FROM marked WHERE clears GROUP BY key),
entries AS (
  SELECT key, word, count(*) AS count, min(seq) AS first
  FROM marked LEFT JOIN ends USING (key) WHERE cleared IS NULL OR seq > cleared
  GROUP BY key, word)
"""

_VOCABULARY = _WORD_STREAM + """
SELECT key, row_number() OVER (PARTITION BY key ORDER BY first) - 1 AS pos, word, count
FROM entries"""

_PAIR_AVG = _NUMBERS + """,
pairs AS (
  SELECT key, seq, place, (n + lag(n) OVER (PARTITION BY key, epoch ORDER BY seq)) / 2.0 AS avg
  FROM sums)
SELECT key, seq, CAST(avg AS DOUBLE) AS avg FROM pairs WHERE place % 2 = 0"""

_PAST_VALUES = _VALUE_STATE.replace(
    "FROM events)",
    "FROM events WHERE event_id <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events))",
)

_CHANGES = _NUMBERS + """,
halves AS (
  SELECT key, seq, n, CAST(seq > (SELECT (min(event_id) + max(event_id)) // 2 FROM events) AS BIGINT)
           AS batch
  FROM num),
ends AS (SELECT key, batch, max(seq) AS upto FROM halves GROUP BY key, batch),
cleared AS (
  SELECT ends.*, (SELECT max(seq) FROM num
                  WHERE num.key = ends.key AND n = -1 AND seq <= ends.upto) AS clear
  FROM ends)
SELECT batch, cleared.key, CAST(coalesce(sum(n), 0) AS BIGINT) AS value, count(n) AS size,
       'update' AS change
FROM cleared LEFT JOIN num ON num.key = cleared.key AND num.seq <= upto
                              AND (clear IS NULL OR num.seq > clear)
GROUP BY batch, cleared.key"""

_LOOKUP = f"""
WITH snap AS ({_SNAPSHOT}),
wanted AS (SELECT DISTINCT unnest([user_id, -1 - user_id]) AS key FROM events),
names AS (SELECT unnest(['value-query', 'list-query', 'map-query', 'reduce-query', 'keyed-query'])
          AS state_name)
SELECT state_name, key, pos, map_key, value, coalesce(found, false) AS found
FROM (SELECT * FROM wanted CROSS JOIN names) LEFT JOIN snap USING (state_name, key)"""

_LOOKUP_NORMALISED = f"""
SELECT state_name, 'user ' || key AS key, pos, 'user ' || map_key AS map_key, value, found
FROM ({_LOOKUP}) WHERE key IN (SELECT user_id FROM events)"""

_PARSED = _TOKENS + "SELECT key, seq, n FROM parsed WHERE n IS NOT NULL"

_RUNNING_COUNT = """
SELECT event_type AS word, event_id AS seq,
       row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS count
FROM events"""

_UNTIL_QUIT = """
WITH toks AS (
  SELECT user_id AS key, event_id AS seq,
         CASE WHEN event_type = 'purchase'
                   AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) > 90
              THEN 'quit' ELSE event_type END AS tok
  FROM events),
ends AS (SELECT key, min(seq) AS ended FROM toks WHERE tok = 'quit' GROUP BY key)
SELECT key, seq, tok FROM toks LEFT JOIN ends USING (key)
WHERE ended IS NULL OR seq < ended"""

_QUIT_ALL = """
WITH toks AS (
  SELECT user_id AS key, event_id AS seq,
         CASE WHEN event_type = 'purchase'
                   AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) = 99
              THEN 'quit' ELSE event_type END AS tok
  FROM events)
SELECT key, seq, tok FROM toks
WHERE seq < coalesce((SELECT min(seq) FROM toks WHERE tok = 'quit'), 9223372036854775807)"""

_LATEST = """
SELECT * FROM (SELECT key, max(seq) AS seq, arg_max(total, seq) AS total FROM sums GROUP BY key)"""

_WORD_COUNT = _WORDS + "SELECT word, count(*) AS count FROM words GROUP BY word"

_ONE_STREAM = _TOKENS + """,
num AS (SELECT seq, n FROM parsed WHERE n IS NOT NULL),
epochs AS (
  SELECT *, count(*) FILTER (n = -1)
              OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS epoch
  FROM num)
SELECT seq, n, CAST(sum(n) OVER (PARTITION BY epoch ORDER BY seq
                                 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM epochs WHERE n <> -1"""

_SUMS = _NUMBERS + "SELECT key, seq, n, total FROM sums"

_TUMBLING = """
SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start, event_type, count(*) AS count
FROM events GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    return stream_sql() | (corpus.ORACLE_SQL if corpus else {})


def stream_sql() -> dict[str, str]:
    return {
        "word_count": _WORD_COUNT,
        "word_count_formatted": _WORDS
        + "SELECT word || ' : ' || count(*) AS line FROM words GROUP BY word",
        "tokens": f"""
            WITH split AS (SELECT conv_id, turn, {_SPLIT} AS toks FROM conversations)
            SELECT conv_id, turn, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos,
                   unnest(toks) AS tok
            FROM split""",
        "running_word_count": _RUNNING_COUNT,
        "tumbling_count": _TUMBLING,
        "parse_numbers": _PARSED,
        "parse_rejects": _TOKENS
        + "SELECT key, seq, tok FROM parsed WHERE n IS NULL AND tok IS NOT NULL",
        "take_until_quit": _UNTIL_QUIT,
        "resettable_sum": _SUMS,
        "resettable_sum_chunked": _ONE_STREAM,
        "resettable_sum_resumed": _NUMBERS + "SELECT key, seq, n, total, place AS size FROM sums",
        "value_state": _VALUE_STATE,
        "list_state": _LIST_STATE,
        "map_state": _MAP_STATE,
        "reducing_state": _NUMBERS + "SELECT key, value FROM current",
        "keyed_latest": _NUMBERS + "SELECT key, value FROM latest",
        "labelled_inputs": _NUMBERS + "SELECT seq, n, 'avg' AS label FROM sums",
        "last_input": _LAST_INPUT,
        "state_snapshot": _SNAPSHOT,
        "running_avg": _RUNNING_AVG,
        "pair_avg": _PAIR_AVG,
        "vocabulary": _VOCABULARY,
        "accepted_words": _WORD_STREAM + "SELECT key, seq, word FROM marked WHERE NOT clears",
        "guarded_numbers": _PARSED,
        "text_word_count": f"""
            WITH lines AS (
              SELECT unnest(string_split(text, E'\n')) AS text FROM conversations),
            words AS (SELECT unnest({_SPLIT}) AS word FROM lines)
            SELECT word, count(*) AS count FROM words GROUP BY word""",
        "resettable_sum_split": _SUMS,
        "list_state_split": _LIST_STATE,
        "state_snapshot_split": _SNAPSHOT,
        "running_avg_split": _RUNNING_AVG,
        "pair_avg_split": _PAIR_AVG,
        "vocabulary_split": _VOCABULARY,
        "stream_word_count": _WORD_COUNT,
        "stream_running_word_count": _RUNNING_COUNT,
        "stream_take_until_quit": _UNTIL_QUIT,
        "stream_tumbling_count": _TUMBLING,
        "stream_last_input": _LAST_INPUT,
        "stream_resettable_sum": _NUMBERS + "SELECT key, seq, total FROM sums",
        "stream_resettable_sum_heavy": _ONE_STREAM,
        "stream_state_snapshot_heavy": _SNAPSHOT,
        "stream_value_state": _VALUE_STATE,
        "stream_value_state_past": _PAST_VALUES,
        "stream_state_changes": _CHANGES,
        "stream_resettable_sum_resumed": _NUMBERS + """
            SELECT key, seq, total FROM sums
            WHERE seq > (SELECT (min(event_id) + max(event_id)) // 2 FROM events)""",
        "stream_lookup": _LOOKUP,
        "stream_lookup_normalised": _LOOKUP_NORMALISED,
        "stream_lookup_point": _NUMBERS + _LATEST + " WHERE key = (SELECT max(user_id) FROM events)",
        "stream_keyed_table": _NUMBERS + _LATEST,
        "stream_quit_all": _QUIT_ALL,
        "stream_tumbling_count_late": _TUMBLING,
        "stream_list_state": _LIST_STATE,
        "stream_map_state": _MAP_STATE,
        "stream_state_snapshot": _SNAPSHOT,
        "stream_running_avg": _RUNNING_AVG,
        "stream_vocabulary": _VOCABULARY,
    }
