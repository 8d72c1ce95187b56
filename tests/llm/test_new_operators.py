"""Phrases, hard negatives, line dedup and special tokens against plain Python."""

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracle import compare, connect  # noqa: E402

from tidemark.llm import lines, negatives, phrases, tokenids  # noqa: E402
from tidemark.llm.queries import tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ["op2_warc", "op8_topk", "op10_quotes", "op11_phrases", "op12_negatives", "op13_lines"])
def test_queries_equal_their_sql(spark, con, name):
    same, n, m, *_ = compare(spark, con, SF, name)
    assert same and n == m


# --- lines --------------------------------------------------------------------


def line_key(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def plain_lines(rows):
    """(doc_id, n_lines, n_dropped, kept) by the rule; null ids last."""
    owner = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            at = (doc is None, doc or 0)
            owner[line_key(line)] = min(owner.get(line_key(line), at), at)
    out = []
    for doc, text in rows:
        given = (text or "").split("\n")
        stay = [x for x in given if len(line_key(x)) < 10 or owner[line_key(x)] == (doc is None, doc or 0)]
        out.append((doc, len(given), len(given) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def line_rows():
    rnd = random.Random(5)
    stock = [f"line number {i} of the stock" for i in range(25)]
    stock += ["  LINE Number 3 of the stock\t", "ÉCOLE des beaux arts", "école des beaux arts", "short", "", "   ", "x" * 20_000]
    rows = [(i, "\n".join(rnd.choice(stock) for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    rows += [(7, "line number 1 of the stock\nanother text of doc 7"), rows[3], rows[3]]
    rows += [(None, "line number 2 of the stock\nonly in null rows"), (None, "only in null rows"), (61, None), (62, "")]
    rows += [(63, "\n".join(f"own line {i} of a long text" for i in range(5000)))]
    return rows


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_lines_equal_the_rule(spark, batches):
    rows = line_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, pos int").repartition(4)
    out = lines.deduplicate(docs, batches=batches)
    assert sorted(map(tuple, out.collect()), key=repr) == plain_lines(rows)


def test_no_lines(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lines.deduplicate(docs).collect() == []


def test_runs_are_kept_in_levels(spark):
    """Nine batches with a fan-out of two leave runs of 8 and 1; no key is in two of them."""
    runs = lines.Runs(spark, buckets=3, fan_out=2)
    for i in range(9):
        batch = spark.range(i * 50, i * 50 + 100).select(
            F.col("id").alias("h1"), (F.col("id") * 3).alias("h2"), F.lit(i).cast("bigint").alias("doc")
        )
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 0, 0, 1]
    rows = [tuple(r) for run in runs.tables() for r in run.collect()]
    assert sorted((h, d) for h, _, d in rows) == [(h, max(0, h // 50 - 1)) for h in range(500)]


def test_runs_meet_batches_without_a_shuffle_of_the_runs(spark):
    runs = lines.Runs(spark, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    batch = spark.range(1000).selectExpr("id AS h1", "id AS h2", "id AS doc")
    runs.add(batch)
    new = batch.groupBy("h1", "h2").agg(F.min("doc").alias("doc"))
    met = new.join(runs.tables()[0].select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


# --- phrases ------------------------------------------------------------------


def plain_phrases(rows, least, kept):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    some = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, words), a in some.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inside[lang, words[i : i + size]] = max(inside[lang, words[i : i + size]], a)
    out = defaultdict(list)
    for (lang, words), a in some.items():
        if inside[lang, words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), a, left, right, totals[lang], score))
    return sorted(
        (lang, rank, phrase.decode(), *numbers)
        for lang, found in out.items()
        for rank, (_, _, phrase, *numbers) in enumerate(sorted(found)[:kept], 1)
    )


def phrase_rows():
    rnd = random.Random(11)
    vocabulary = ["New", "york", "city", "the", "of", "Été", "x" * 300, "a-b", "-", " ", "und"] + [f"w{i}" for i in range(40)]
    rows = []
    for _ in range(300):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40))]
        for _ in range(3):
            words.insert(rnd.randint(0, len(words)), rnd.choice(["new york city", "NEW YORK", "the end of the road", "a a a a a a"]))
        text = "".join(w + rnd.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "]) for w in words)
        rows.append((rnd.choice(["en", "fr", None, "und"]), text))
    return rows + [("en", None), ("en", ""), ("fr", " . , \n"), rows[0], ("de", "the end " * 20_000)]


@pytest.mark.parametrize("least, kept", [(1, 50), (20, 2000), (300, 2000)])
def test_phrases_equal_the_rule(spark, least, kept):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 0) for r in rows], "lang string, text string, n int").repartition(3)
    out = phrases.collocations(docs, least=least, kept=kept)
    assert sorted(map(tuple, out.collect())) == plain_phrases(rows, least, kept)


def test_no_phrases(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_filters_leave_out_no_frequent_run():
    part = pa.record_batch({"lang": pa.array(["en"] * 50), "text": pa.array(["one two three four five six. seven"] * 50)})
    some = phrases.Slice.of(part, phrases.W.Hasher())
    full = np.full(1 << 10, 255, np.uint8)
    lengths = some.lengths(full, full).reshape(50, 7)
    assert (lengths == [5, 5, 4, 3, 2, 1, 1]).all()
    none = np.zeros(1 << 10, np.uint8)
    assert (some.lengths(full, none).reshape(50, 7) == [2, 2, 2, 2, 2, 1, 1]).all()
    assert (some.lengths(none) == 0).all()


# --- hard negatives -----------------------------------------------------------


def plain_negatives(rows, every, scale=256):
    rows = [
        (i, label, np.array([int(np.floor(float(np.float32(x)) * scale)) for x in v], object))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in rows:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (v.tolist(), label)), (v.tolist(), label))
    out = []
    for i, (v, label) in anchors.items():
        met = [(-int(np.dot(v, w)), j, own) for j, own, w in rows if j != i and len(w) == len(v)]
        for p, j, _ in sorted(x for x in met if x[2] == label)[:5]:
            fits = sorted(x for x in met if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)[:5]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(fits, 1)]
    return sorted(out)


def vector_rows(n, dim, seed, clusters):
    rnd = np.random.default_rng(seed)
    middles = rnd.normal(size=(clusters, dim))
    rows = []
    for i in range(n):
        v = middles[rnd.integers(clusters)] + rnd.normal(size=dim) * 0.2
        rows.append((i, [float(x) for x in v], int(rnd.integers(3)) if i % 11 else 0))
    return rows


SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("shard_rows, clusters", [(8192, 6), (40, 3)])
def test_negatives_equal_the_rule(spark, monkeypatch, shard_rows, clusters):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    rows = vector_rows(400, 6, 2, clusters)
    rows += [(400, rows[0][1], 1), (401, rows[0][1], 0), (402, rows[0][1], 2), (5, rows[5][1], rows[5][2])]
    rows += [(10, rows[3][1], 1), (403, None, 1), (404, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (405, [float("nan")] * 6, 0)]
    rows += [(406, rows[1][1], None), (None, rows[1][1], 1), (410, [0.5, 0.25], 1), (411, [0.5, 0.5], 1), (412, [0.25, 0.5], 0)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string").repartition(5)
    out = negatives.mine(vectors, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, out.collect())) == plain_negatives(rows, 10)


def test_negatives_past_2_53(spark):
    """Products are whole numbers of any size that fit 64 bits."""
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randint(-(1 << 22), 1 << 22)) for _ in range(3)], i % 2) for i in range(60)]
    out = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, out.collect())) == plain_negatives(rows, 10)


def test_no_negatives(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, F.col("vec_id") % 10 == 0).collect() == []


def test_tree_skips_what_lies_outside():
    rnd = np.random.default_rng(1)
    middles = rnd.integers(-4000, 4000, (40, 8))
    rows = np.concatenate([m + rnd.integers(-20, 20, (100, 8)) for m in middles])
    ids = np.arange(len(rows))
    tree = negatives.build(ids, rows)
    assert sorted(tree.ids.tolist()) == ids.tolist()
    tree.rows = tree.rows.astype(np.float64)
    query = rows[5]
    wanted = [negatives.Wanted(float("-inf"), float("inf"), 5, [])]
    looked = negatives.descend(tree, 5, query, np.float64, wanted)
    products = rows @ query
    best = sorted((-p, i) for i, p in enumerate(products.tolist()) if i != 5)[:5]
    assert sorted((-p, -n) for p, n in wanted[0].found) == [(float(p), i) for p, i in best]
    assert looked < len(rows) / 4


# --- special tokens -----------------------------------------------------------


def test_special_tokens_in_any_case():
    encoder, rnd = tokenids.Encoder(tokenizer_path()), random.Random(3)
    parts = ["<|EndOfText|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "Hello", "wörld", "ÉCLAIR", "x<|endoftext|>y", "a<|b", "<", "|", "<|", " ", "'s", "12,3", "…"]
    texts = ["".join(rnd.choice(parts) + rnd.choice([" ", "", "\n"]) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    ids, ends = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_kept_hash_is_of_the_kept_lines(spark):
    docs = spark.createDataFrame([(1, "the same line\nown one here"), (2, "The same line \nx")], "doc_id bigint, text string")
    out = lines.deduplicate(docs).select("doc_id", F.sha2("kept", 256)).collect()
    assert dict(map(tuple, out))[2] == hashlib.sha256(b"x").hexdigest()
