"""The corpus operators against brute force, round trips and awkward rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    jaccard,
    language,
    mails,
    mixing,
    quality,
    quotes,
    substrings,
    tiling,
    tokenids,
    topk,
    warc,
)
from tidemark.llm.components import components
from tidemark.llm.queries import op10_quotes, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, size int, row string"
BASE = " ".join(f"word{i % 37} w{i}" for i in range(120))
ROWS = [
    (0, BASE, "en", "a", 1, "x"),
    (1, BASE, "en", "a", 1, "x"),  # an exact copy
    (2, BASE.replace("w7 ", "changed "), "en", "b", 1, "x"),  # a near copy
    (3, None, None, None, None, None),
    (4, "", "en", "b", 1, "x"),
    (5, "Two words", "en", "é", 1, "x"),
    (6, "two  WORDS", "en", "a", 1, "x"),
    (7, "!!! \t ...", "en", "a", 1, "x"),
    (8, "other " + " ".join(f"z{i}" for i in range(90)) + " " + " ".join(BASE.split()[40:75]), "de", "b", 1, "x"),
    (9, "long " * 30_000, "de", "b", 1, "x"),
    (9, "long " * 30_000, "de", "b", 1, "x"),  # a repeated row
    (None, "no id here", "de", "b", 1, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return WORD.findall(text or "")


def test_mixing(docs, none):
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(r["size"] for r in rows) == sorted(len(words(r[1])) for r in ROWS)
    total = sum(r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) <= total
    assert sorted(rows, key=repr) == sorted(mixing.taken_words(docs).collect(), key=repr)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = {}
    for r in mixed.collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(words(r["text"]))
    want = {}
    for r in rows:
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert taken == {k: v for k, v in want.items() if k in taken}
    assert sum(taken.values()) == sum(want.values())
    assert mixing.mix(none).count() == mixing.taken_words(none).count() == 0


def test_mixing_spreads_documents_of_one_id(spark):
    """A third of a source without an id: no bucket of its order holds more than a few of them."""
    rows = [(None if i % 3 == 0 else i, f"word{i} " * (i % 7 + 1), "s") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    scheduled, cut = mixing.scheduled_mix(docs)
    assert scheduled.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 12
    total = sum(i % 7 + 1 for i in range(3000))
    taken = mixing.taken_words(docs).agg(F.sum("taken")).first()[0]
    assert total - 7 <= taken <= total


def test_the_order_and_the_cut_of_a_mix_equal_a_loop(spark):
    rows = [(i, f"w{i} " * (i * 7 % 11 + 1), f"s{i % 4 if i % 9 else 0}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    scheduled, cut = mixing.scheduled_mix(docs)
    known = scheduled.select("doc_id", "size", "source_no", "source_size", "target", "budget", "place").collect()
    copies = []
    for no in {r["source_no"] for r in known}:
        given = 0
        for r in sorted((r for r in known if r["source_no"] == no), key=lambda r: (r["place"], r["doc_id"])):
            given += r["size"]
            for c in range(mixing.EPOCHS):
                copies.append(((c * r["source_size"] + given) / r["target"], no, r["place"], r["doc_id"], c, r["size"]))
    left, taken = int(known[0]["budget"]), dict.fromkeys(range(200), 0)
    for copy in sorted(copies):
        left -= copy[-1]
        if left < 0:
            break
        taken[copy[3]] += copy[-1]
    assert {r["doc_id"]: r["taken"] for r in mixing.taken_words(docs).collect()} == taken


def test_targets_fill_like_the_loop(spark):
    sizes = {"a": 10, "b": 2000, "c": 500, None: 40, "d": 0}
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    order = [*sorted(k for k in sizes if k is not None), None]
    weight = {k: i % 3 + 1 for i, k in enumerate(order)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        open_ = [k for k in order if k not in full]
        share = left / max(sum(weight[k] for k in open_), 1)
        over = [k for k in open_ if share * weight[k] > 3 * sizes[k]]
        for k in open_:
            target[k] = min(share * weight[k], 3 * sizes[k])
        if not over:
            break
        full |= set(over)
        left -= sum(3 * sizes[k] for k in over)
    assert got == pytest.approx(target)


def test_substrings(docs, none):
    want = []
    for i, text in sorted(((r[0] if r[0] is not None else -1, r[1]) for r in ROWS), key=lambda r: r[0]):
        w = words(text)
        gone = [False] * len(w)
        want.append((i, w, gone))
    first = {}
    for i, w, _ in want:
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            first[key] = min(first.get(key, (i, s)), (i, s))
    expected = []
    for i, w, gone in want:
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (i, s):
                gone[s : s + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = [(-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, substrings.deduplicate(docs).collect())]
    assert sorted(got) == sorted(expected)
    assert substrings.deduplicate(none).count() == 0


def test_rows_that_share_an_id_keep_their_own_words(spark, monkeypatch):
    own = {k: [f"{k}{i}" for i in range(50)] for k in "abcdef"}
    shared = [f"s{i}" for i in range(30)]
    rows = [
        (None, own["a"] + shared),
        (None, own["b"][:10] + shared + own["b"][10:] + shared),  # comes first at place 10
        (None, own["c"][:3]),
        (7, own["d"][:5] + shared + own["d"][5:]),
        (7, own["e"][:5] + shared + own["e"][5:30]),  # the same place as in the row before
        (7, own["f"]),
        (8, own["f"][:25]),
    ]
    gone = [(50, 80), (80, 110), (0, 0), (5, 35), (5, 35), (0, 0), (0, 25)]
    want = []
    for (i, w), (a, b) in zip(rows, gone, strict=True):
        want.append((i, len(w), b - a, " ".join(w[:a] + w[b:])))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    for parts in (1, 7):
        got = substrings.deduplicate(table.repartition(parts)).drop("kept_sha256").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def brute_components(rows, size, percent):
    sets = []
    for _, text in rows:
        w = [x.lower() if x.isascii() else x for x in words(text)]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = root[b] = min(root[a], root[b])
    return [len(s) for s in sets], root


@pytest.mark.parametrize(("size", "percent", "last", "rows_per_task"), [(4, 85, 1, 4096), (5, 80, 0, 2)])
def test_jaccard(spark, docs, none, monkeypatch, size, percent, last, rows_per_task):
    monkeypatch.setattr(jaccard, "LAST_ROUND", last)
    monkeypatch.setattr(jaccard, "TILE_ROWS", rows_per_task)
    rng = np.random.default_rng(size)
    base = [f"v{i}" for i in range(60)]
    many = [(100 + k, " ".join("q%d" % rng.integers(1000) if rng.random() < 0.02 else x for x in base)) for k in range(40)]
    rows = [(r[0] if r[0] is not None else -1, r[1]) for r in ROWS] + many
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(many, "doc_id bigint, text string"))
    sizes, root = brute_components(rows, size, percent)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, i), i)
    want = sorted((i, n, least[r]) for (i, _), n, r in zip(rows, sizes, root, strict=True))
    got = [tuple(-1 if x is None else x for x in r) for r in jaccard.similar(table, size, percent).collect()]
    assert sorted(got) == want
    kept = jaccard.representatives(docs, size, percent)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {3, 4, 7, 8, 9, None} <= set(ids) and 1 not in ids
    assert jaccard.representatives(none, size, percent).count() == 0


def test_rows_that_share_an_id_are_judged_alone(spark):
    own = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcdef"}
    rows = [
        (None, own["a"], "stays"),
        (None, own["b"], "stays"),
        (None, own["b"] + " b", "near"),
        (1, own["c"], "stays"),
        (1, own["a"], "copy"),
        (2, own["d"], "stays"),
        (3, own["d"], "copy"),
        (3, own["e"], "stays"),
        (4, None, "stays"),
        (4, None, "stays"),
        (5, own["f"], "stays"),
        (5, own["f"], "stays"),
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, note string")
    kept = sorted(map(tuple, jaccard.representatives(table).collect()), key=repr)
    assert kept == sorted([r for r in rows[:-1] if r[2] == "stays"], key=repr)
    items = spark.createDataFrame([(1, own["a"]), (2, own["e"])], "item_id bigint, text string")
    left = sorted(map(tuple, tiling.clean(table, items).collect()), key=repr)
    assert left == sorted([r for r in rows if r[1] not in (own["a"], own["e"])], key=repr)


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(0)
    for n in (1, 3, 40, 700):
        a = np.unique(rng.integers(0, 1 << 48, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 1 << 48, n // 2 + 1).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        assert jaccard.overlap_bound(jaccard.signature(a), jaccard.signature(b), len(a), len(b)) >= both
        assert (jaccard.unpack(jaccard.pack(a)) == a).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (10, 3), *[(20 + i, 21 + i) for i in range(30)]]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert found == {1: 1, 2: 1, 3: 1, 10: 1, 4: 4, 5: 4} | {20 + i: 20 for i in range(31)}


def test_tiles_are_greedy():
    item = np.arange(1, 31, dtype=np.uint64)
    moved = np.concatenate([item[20:], [99], item[:20]]).astype(np.uint64)
    assert sorted(t[2] for t in tiling.tiles(item, moved)) == [10, 20]
    assert tiling.tiles(item, np.array([7, 7, 7], np.uint64)) == []
    assert sum(t[2] for t in tiling.tiles(item, np.tile(item, 5))) == 30
    half = np.concatenate([item[:12], [0], item[10:30]]).astype(np.uint64)
    assert sum(t[2] for t in tiling.tiles(item, half)) == 30


def test_decontamination(spark, docs, none):
    text = "The first, second and third question; what is the answer to it? It is so. " * 2
    items = spark.createDataFrame([(1, text), (2, None), (3, "too short"), (None, "")], "item_id bigint, text string")
    halves = text.split("?")
    rows = [(50, "before " + "? ".join(reversed(halves)).upper() + " behind"), (51, "the first second and third day")]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = tiling.leaks(table, items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(50, 1)] and found[0]["coverage"] > 0.8
    assert tiling.clean(table, items).count() == table.count() - 1
    assert tiling.clean(docs, items).columns == docs.columns
    assert tiling.leaks(none, items).count() == tiling.leaks(docs, items.limit(0)).count() == 0


def test_accented_capitals_are_leaks(spark):
    text = "¿Qué canción oirían mañana los niños del último pueblo según el rey Ōtaka?"
    items = spark.createDataFrame([(1, text), (2, text.upper())], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, text), (2, text.upper()), (3, "nothing of it")], "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in tiling.leaks(docs, items).collect()}
    assert found == {(d, i): 1.0 for d in (1, 2) for i in (1, 2)}
    assert [r["doc_id"] for r in tiling.clean(docs, items).collect()] == [3]


PAGES = [
    (1, "http://a", "<p>same</p>"),
    (2, "http://b\r\nX: y", "<p>same</p>"),
    (3, None, None),
    (4, "http://d", ""),
    (5, "http://e", "é" * 50_000),
    (5, "http://e", "é" * 50_000),
    (None, "http://f", "<p>same</p>"),
    *[(100 + i, f"http://x/{i}", f"<html>{i}" + "text " * 40) for i in range(300)],
]


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 100)
    monkeypatch.setattr(warc, "DICTIONARY_RECORDS", 40)
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").coalesce(2)
    warc.write(pages, f"file://{tmp_path}/w")
    rows = warc.read(spark, f"file://{tmp_path}/w").collect()
    groups = {}
    for i, _, html in PAGES:
        groups.setdefault(html or "", []).append(i)
    want = []
    for i, _, html in PAGES:
        best = max(x for x in groups[html or ""] if x is not None)
        payload = (html or "").encode()
        visit = i != best
        want.append((i or -1, len(payload), warc.digest(payload), "revisit" if visit else "response", best if visit else -1, None if visit else payload))
    got = [(r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or -1, None if r["payload"] is None else bytes(r["payload"])) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    none = pages.limit(0)
    warc.write(none, f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").count() == 0


def test_warc_refuses_damage():
    made = warc.record(1, "http://a", b"abc", None, 0, "2024-01-01T00:00:00Z")
    assert warc.parse(made)["payload"] == b"abc"
    for bad in (made[:-1], made.replace(b"abc", b"abd"), made.replace(b"WARC/1.1", b"WARC/9"), made.replace(b"Content-Length: ", b"Content-Length: 1")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        list(warc.records(b"junk"))


def test_variable_length_code():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)
        control, data = tokenids.encode_values(values)
        back = tokenids.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert (back == values).all()
    with pytest.raises(ValueError):
        tokenids.decode_values(np.zeros(1, np.uint8), np.zeros(3, np.uint8), 4)


def test_token_ids(spark, docs, none, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenids, "SHARD_BYTES", 100_000)
    monkeypatch.setattr(tokenids, "BLOCK_IDS", 10_000)
    odd = [(60, "ÀÉ naïve Σίσυφος İstanbul don't we'll <|endoftext|> x:y... é   3,141 snake_case ΟΔΟΣ ''s")]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    tokenids.write(table, f"file://{tmp_path}/t", tokenizer_path())
    rows = tokenids.read(spark, f"file://{tmp_path}/t").orderBy("start").collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    at = 0
    ordered = sorted([(r[0] if r[0] is not None else -1, r[1]) for r in ROWS] + odd, key=lambda r: r[0])
    for (i, text), r in zip(ordered, rows, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (-1 if r["doc_id"] is None else r["doc_id"], r["start"], r["ids"]) == (i, at, ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    tokenids.write(none, f"file://{tmp_path}/none", tokenizer_path())
    assert tokenids.read(spark, f"file://{tmp_path}/none").count() == 0


def test_quality(spark, docs, none):
    good = [(i, f"A plain line of words number {i} that ends well, as texts do.", 1) for i in range(60)]
    bad = [(i, "$$$ !!! " + f"*** {i} ### BUY|NOW" * 5, 0) for i in range(60, 120)]
    table = spark.createDataFrame([r[:2] for r in good + bad], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in good + bad] + [(5, None)], "doc_id bigint, quality int")
    model = quality.train(table, labels, "quality", F.lit(True))
    assert 0 < len(model.rules) < 60
    held = quality.scored(table, model).join(labels.dropna(), "doc_id").collect()
    assert all((r["score"] >= 0.5) == (r["quality"] == 1) for r in held)
    out = quality.scored(docs, model)
    assert out.columns == [*docs.columns, "score"] and out.count() == len(ROWS)
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    unlearnt = quality.train(table, labels.limit(0), "quality", F.lit(True))
    assert {r["score"] for r in quality.scored(docs, unlearnt).collect()} == {0.5}
    assert quality.scored(none, model).count() == 0


def plain_tiles(item, text, least):
    """Covered tokens by the greedy rule: again and again the longest run that is still free in both."""
    free_item, free_text, covered = [True] * len(item), [True] * len(text), 0

    def run(i, j):
        n = 0
        while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and free_item[i + n] and free_text[j + n]:
            n += 1
        return n

    while True:
        n, i, j = max(((run(i, j), -i, -j) for i in range(len(item)) for j in range(len(text))), default=(0, 0, 0))
        if n < least:
            return covered
        for k in range(n):
            free_item[k - i] = free_text[k - j] = False
        covered += n


def test_tiles_equal_the_greedy_rule():
    """Tokens that are unlike within an item, so that the greedy rule has one result."""
    random = np.random.default_rng(5)
    for _ in range(60):
        item = random.permutation(40).astype(np.uint64) + np.uint64(1)
        cuts = np.split(item, np.sort(random.choice(np.arange(1, 40), 4, replace=False)))
        random.shuffle(cuts)
        text = np.concatenate([np.append(c, np.uint64(99)) for c in cuts[: random.integers(1, 6)]])
        found = tiling.tiles(item, text, 5)
        assert sum(t[2] for t in found) == plain_tiles(item.tolist(), text.tolist(), 5)


def test_rows_of_one_id_meet_their_own_items_only(spark, monkeypatch):
    """60 rows without an id, each with one item: 60 pairs are tiled, not 3600."""
    texts = [" ".join(f"t{i}x{k}" for k in range(12)) for i in range(60)]
    rows = spark.createDataFrame([(None, f"some words before {t}") for t in texts], "doc_id bigint, text string")
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    tiled = tiling._tiled
    pairs = spark.sparkContext.accumulator(0)

    def counted(least):
        work = tiled(least)

        def count(batches):
            def seen():
                for batch in batches:
                    pairs.add(batch.num_rows)
                    yield batch

            return work(seen())

        return count

    monkeypatch.setattr(tiling, "_tiled", counted)
    found = tiling.coverage(rows, items).collect()
    assert {(r["doc_id"], r["item_id"], r["coverage"]) for r in found} == {(None, i, 1.0) for i in range(60)}
    assert pairs.value == 60


def test_every_language_is_learned(spark, monkeypatch):
    """30 languages under a bound of 60 windows; one of them has three texts, a third have no id."""
    seen = {}

    def train(x, y, languages):
        seen.update(dict(zip(languages, np.bincount(y, minlength=len(languages)), strict=True)))
        return language.Network([], np.zeros((0, 0)), [], np.zeros((0, 0)), np.zeros(0))

    monkeypatch.setattr(language, "train", train)
    monkeypatch.setattr(language, "MOST_SAMPLED", 60)
    rows = [(None if i % 3 == 0 else i, f"text {i} of a language", f"l{i % 29:02}") for i in range(900)]
    rows += [(i, f"rare text {i}", "rare") for i in range(1000, 1003)]
    language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    assert len(seen) == 30 and set(seen.values()) == {2}


def test_language(spark, docs, none):
    rng = np.random.default_rng(0)
    kinds = {"xx": ["ba", "lo", "mi", "ta"], "yy": ["schr", "äu", "ung", "pf"]}
    rows = [
        (i, " ".join("".join(rng.choice(parts, 3)) for _ in range(60)), lang)
        for lang, parts in kinds.items()
        for i in range(0 if lang == "xx" else 50, 50 if lang == "xx" else 100)
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.learn(table, F.col("doc_id") % 5 != 0)
    found = {r["doc_id"]: r for r in language.predict(table, net).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows if i % 5 == 0)
    odd = {(r["doc_id"], r["lang_pred"]) for r in language.predict(docs, net).collect()}
    assert {(3, "und"), (4, "und"), (7, "und")} <= odd
    empty = language.learn(none, F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(none, net).count() == 0


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(90)]
    rows += [(200, None), (220, [1.0, float("nan"), 0.0, 0.0]), (240, [1.0, None, 0.0, 0.0]), (260, [float("inf")] * 4), (280, [1.0, 2.0]), (300, []), (None, [1.0] * 4), (20, rows[20][1])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in topk.search(table, F.pmod("vec_id", F.lit(20)) == 0, k=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, np.floor(64 * np.float32(v).astype(float)).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    for q, v in whole[:90]:
        if q % 20 == 0:
            scores = sorted((-int(v @ w), i) for i, w in whole if i != q and len(w) == len(v))[:7]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert topk.search(table.limit(0), F.lit(True)).count() == 0


def test_quotes(spark):
    rows = [
        (1, "t", "Hello there my old friends.\nSecond line of it."),
        (2, "t", "Someone wrote:\n> hello there  my old friends.\n\nAn answer that says much more."),
        (3, "t", "> > Hello there my old friends.\n> An answer that says much more.\nAnd a third."),
        (4, "u", "> An answer that says much more.\n> unknown words in here too\nFrom elsewhere."),
        (5, "t", None),
        (6, None, "> nothing known by anyone at all\nAlone."),
        (7, "t", ">> Hello there my old friends.\nSkips one."),
        (None, "t", "no id"),
    ]
    table = spark.createDataFrame(rows, "msg bigint, thread string, text string")
    got = {r["msg"]: (r["root"], r["parent"], r["depth"], r["position"], r["text"]) for r in quotes.conversations(table).collect()}
    assert got == {
        1: (1, None, 0, 0, "Hello there my old friends.\nSecond line of it."),
        2: (1, 1, 1, 1, "An answer that says much more."),
        3: (1, 2, 2, 2, "And a third."),
        4: (1, 2, 2, 3, "From elsewhere."),
        5: (5, None, 0, 0, ""),
        6: (6, None, 0, 0, "Alone."),
        7: (1, 1, 1, 4, "Skips one."),
    }
    assert quotes.conversations(table.limit(0)).count() == 0


@pytest.mark.parametrize("parts", ["1", "7"])
def test_turns_quote_across_tasks(spark, tmp_path, parts):
    def said(conv, turn):
        return f"Turn {turn} of {conv} says something of its own.\nIts line {turn * 7 + 1} for {conv}."

    gaps = {(5, 0), (5, 3), (5, 4), *((7, t) for t in range(4, 30))}
    keys = [(5, t) for t in range(41)] + [(7, t) for t in range(40)] + [(6, 0), (6, 1 << 20), (6, (1 << 20) + 1)]
    keys += [(4, (1 << 20)), (None, 1), (None, 2)]  # the first has had the id of (5, 0)
    rows = [(c, t, None if (c, t) in gaps else said(c, t)) for c, t in keys]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    settings = {"spark.sql.shuffle.partitions": parts, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = {(r["conv_id"], r["turn"]): tuple(r)[2:] for r in op10_quotes(spark, f"file://{tmp_path}").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want, depth = {}, {}
    for conv in {c for c, _ in keys}:
        seen = None  # the last turn with a text
        for position, turn in enumerate(sorted(t for c, t in keys if c == conv)):
            depth[conv, turn] = 0 if seen is None else depth[conv, seen] + 1
            want[conv, turn] = (conv, seen, depth[conv, turn], position, None if (conv, turn) in gaps else said(conv, turn))
            seen = seen if (conv, turn) in gaps else turn
    # Before any turn with a text there is nothing to quote, so (5, 0) stands alone.
    want = {k: (v[0], v[1], v[2], v[3] - 1 if k[0] == 5 and k[1] else v[3], v[4]) for k, v in want.items()}
    assert got == want


def test_sources_of_tasks_without_texts():
    tails = [(0, 3, 1, 1), (2, 3, 0, 2), (3, 3, 1, 1), (4, 3, 2, 0), (5, 8, 0, 2), (6, 8, 1, 1)]
    assert mails.sources(tails) == [(2, 3, 1, 0, 1), (3, 3, 1, 0, 1), (4, 3, 1, 3, 1), (4, 3, 2, 0, 1), (5, 3, 1, 4, 1), (5, 3, 2, 4, 2)]
