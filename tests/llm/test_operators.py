"""Operators against brute force, on real rows and on odd ones."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import (
    context_mixing,
    decontamination,
    jaccard_join,
    language_id,
    licenses,
    packing,
    quality_crf,
    quality_rules,
    substring_dedup,
    suffix_dedup,
)
from tickloom.llm.frames import is_learned
from tickloom.llm.queries import tokenizer_json

SF_DIR = "/root/testdata/sf0.001"
# Names that the operators use for themselves, to see that they never clash.
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, result INT, row STRING, spans INT, doc INT, code INT, uid INT, held INT, n_words INT"


def _odd():
    long = " ".join(f"w{i % 977}x{i // 977} a b" for i in range(40_000))
    words = [f"term{i}" for i in range(60)]
    ring = " ".join(words)
    rows = [
        (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "Ünïcode ßtraße"), (905, "one"), (906, "x" * 2000), (907, "ab" * 1500),
        (908, long), (909, ring), (909, ring), (910, "Released under the MIT license. Apache License, Version 2.0; CC BY-NC"),
        (911, "a <|endoftext|> b's 12 don't x"), (None, ring + " end"), (None, None), (912, ring + " " + ring), (913, "\x00 zero \x1f unit"),
        (914, "UNDER THE MIT LİCENSE under the mit license"), (915, "!!! 123 ???"),
    ]
    for n in range(12):  # near copies: one of 60 words differs, so shingle similarity is about 0.9
        own = list(words)
        own[5 * n % 60] = f"other{n}"
        rows.append((920 + n, " ".join(own)))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(110)
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table.collect()] + [(i, t, None, "odd") for i, t in _odd()]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5, 6, 7) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(found, *columns):
    return Counter(tuple(r) for r in found.select(*columns).collect())


def expect(rows, results):
    return Counter((doc, *result) for (doc, *_), result in zip(rows, results))


def test_decontamination(spark, docs, rows, empty):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    items += [(5000, None), (5001, ""), (5002, "one"), (None, "term1 term2"), (5003, "term3 term4"), (5003, "term3 term4")]
    table = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    columns = ["row.doc_id", "result.n_words", "result.n_hit", F.size("result.items").cast("long"), F.sha2(F.array_join("result.items", ","), 256), decontamination.is_contaminated()]
    wanted = expect(rows, [brute.decontaminate(text, items) for _, text, *_ in rows])
    assert bag(decontamination.decontaminate(docs, table), *columns) == wanted
    # The same through several automata.
    assert bag(decontamination.decontaminate(docs, table, max_key_chars=9000), *columns) == wanted
    assert decontamination.decontaminate(empty, table).count() == 0
    clean = decontamination.decontaminate(docs, table.limit(0))
    assert clean.where("result.n_hit > 0").count() == 0 and clean.count() == len(rows)
    spans = decontamination.decontaminate(docs, table).where("row.doc_id = 903").select("row.text", "result.spans").first()
    assert [spans["text"][s["first_char"] : s["end_char"]] for s in spans["spans"]] == ["one"]


def test_quality_statistics_and_rules(docs, rows, empty):
    found = quality_rules.outliers(docs)
    stats = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    wanted = expect(rows, [brute.quality(text) for _, text, *_ in rows])
    assert bag(found, "row.doc_id", *(f"result.{s}" for s in stats), "base_failed") == wanted
    assert found.where("base_failed AND kept").count() == 0
    assert quality_rules.outliers(empty).count() == 0


def test_mcd_ignores_outliers(spark):
    """Outliers move the mean and the covariance of all points, but not the MCD estimate; it rejects them."""
    draw = np.random.default_rng(3)
    size = len(quality_rules.FEATURES)
    good = draw.normal(size=(4000, size)) * 2
    bad = draw.normal(size=(600, size)) * 0.5 + 25
    points = [("g", dict(zip(quality_rules.FEATURES, map(float, p)))) for p in np.vstack([good, bad])]
    kind = ", ".join(f"{f}: DOUBLE" for f in quality_rules.FEATURES)
    model = quality_rules.fit_mcd(spark.createDataFrame(points, f"`group` STRING, x STRUCT<{kind}>")).first()
    centre, whiten = np.array(model["centre"]), np.array(model["whiten"]).reshape(size, size)
    assert np.abs(centre).max() < 0.3
    far = lambda x: (((x - centre) @ whiten.T) ** 2).sum(axis=1) > quality_rules.CUTOFF
    assert far(bad).all() and far(good).mean() < 0.01


def test_quality_rules_tell_labels(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality_rules.outliers(table).where("NOT base_failed").select("row.doc_id", "kept").join(labels, "doc_id")
    rate = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rate[1] > 0.98 and rate[0] < 0.3


def test_language(spark, docs, rows, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(table, table.where(is_learned("doc_id", 5, 0)))
    held = found.where(~is_learned("row.doc_id", 5, 0)).select(F.avg((F.col("row.lang") == F.col("result.lang_pred")).cast("int"))).first()[0]
    assert held > 0.98
    odd = language_id.identify(docs, table)
    by_id = {(r["doc_id"], r["text"]): r for r in odd.select("row.doc_id", "row.text", "result.*").collect()}
    assert len(odd.collect()) == len(rows)
    for doc in ((900, None), (901, ""), (902, " \n\t "), (915, "!!! 123 ???"), (None, None)):
        assert by_id[doc]["lang_pred"] == "und" and by_id[doc]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in by_id.values())
    assert by_id[(903, "one")]["lang_pred"] != "und"
    assert {r[0] for r in language_id.identify(docs, empty).select("result.lang_pred").collect()} == {"und"}
    assert language_id.identify(empty, table).count() == 0


def test_language_vectors_by_definition():
    text = "Aß b"
    grams, counts = language_id.gram_counts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    listed = {"".join(map(chr, g)): int(c) for g, c in zip(grams, counts[0])}
    assert listed == {" aß": 1, "aß ": 1, "ß b": 1, " b ": 1}
    a, b, c = (language_id.letter_vectors(np.array([ord(x)]), 64)[0] for x in "abc")
    bound = language_id.gram_vectors(np.array([[ord("a"), ord("b"), ord("c")]]), 64)[0]
    assert (bound == np.roll(a, 2) * np.roll(b, 1) * c).all()


@pytest.mark.parametrize("max_bucket", [512, 1])
def test_repeated_bytes(docs, rows, empty, max_bucket):
    found = suffix_dedup.remove_repeats(docs, window=60, gram=8, max_bucket=max_bucket)
    wanted = expect(rows, brute.cut_bytes([r[:2] for r in rows], 60))
    assert bag(found, "row.doc_id", "result.n_bytes", "result.n_removed", "result.n_spans", F.sha2("result.kept", 256)) == wanted
    if max_bucket == 1:
        assert suffix_dedup.remove_repeats(empty).count() == 0


def test_maximal_repeats_by_definition():
    text = np.frombuffer(b"xabcdyabcdzabcqabcd", np.uint8).astype(np.int64)
    order, common = suffix_dedup.suffix_array(text, len(text) + 1)
    raw = text.astype(np.uint8).tobytes()
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
    prefix = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert common.tolist()[1:] == [prefix(raw[i:], raw[j:]) for i, j in zip(order[:-1], order[1:])]
    found = {(raw[order[a] :][:n], tuple(sorted(order[a:b].tolist()))) for n, a, b in suffix_dedup.maximal_repeats(order, common, np.concatenate([[999], text[:-1]]), 2)}
    assert found == {(b"abcd", (1, 6, 15)), (b"abc", (1, 6, 11, 15))}


@pytest.mark.parametrize("max_bucket", [512, 1])
def test_later_word_windows(docs, rows, empty, max_bucket):
    found = substring_dedup.remove_later(docs, window=12, gram=3, max_bucket=max_bucket)
    wanted = expect(rows, brute.cut_words([r[:2] for r in rows], 12))
    assert bag(found, "row.doc_id", "result.n_words", "result.n_removed", F.sha2(F.col("result.kept").cast("binary"), 256)) == wanted
    if max_bucket == 1:
        assert substring_dedup.remove_later(empty).count() == 0


def test_window_counts(docs, rows):
    """Every window of two runs or more has its exact count."""
    size, counts = 12, Counter()
    for _, text, *_ in rows:
        words = brute.SPACE_WORD.findall(text or "")
        counts.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = substring_dedup.count_windows(docs, window=size, gram=3)
    assert set(r[0] for r in found.select("count").distinct().collect()) <= set(counts.values())


def test_context_mixing(docs, rows, empty):
    learned = [brute.remainder(doc, 10) not in (0, None) for doc, *_ in rows]
    found = context_mixing.score(docs, docs.where(is_learned("doc_id", 10, 0)), bits=16, held_words=50)
    wanted = defaultdict(list)
    for (doc, text, *_), result in zip(rows, brute.unigram([r[:2] for r in rows], learned)):
        wanted[(doc, text)].append(result)
    got = found.select("row.doc_id", "row.text", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base = wanted[(r["doc_id"], r["text"])][0]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    assert context_mixing.score(empty, docs).count() == 0
    assert context_mixing.score(docs, empty).where("train_tokens = 0").count() == len(rows)


def test_licenses(docs, rows, empty):
    found = licenses.scan(docs)
    wanted = expect(rows, [brute.licenses(text, licenses.PHRASES) for _, text, *_ in rows])
    assert bag(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == wanted
    assert found.where("NOT labels LIKE base_labels || '%' AND base_labels <> ''").count() == 0
    assert licenses.scan(empty).count() == 0


def test_license_template_with_changes(spark):
    label, text = licenses.TEMPLATES[2]
    words = text.split()
    changed = words[:6] + ["inserted", "words"] + words[6:]
    table = spark.createDataFrame([(1, "intro " + " ".join(changed)), (2, " ".join(words[:7])), (3, text.upper())], "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: r for r in licenses.scan(table).collect()}
    assert found[1]["labels"] == label and licenses.MIN_COVERAGE <= found[1]["score"] < 1
    assert found[2]["labels"] == "" and found[3]["score"] == 1


@pytest.mark.parametrize("limits", [(500_000, 500_000), (1, 150)])
def test_jaccard_join(docs, rows, empty, limits):
    found = jaccard_join.join_components(docs, small_region=limits[0], block_shingles=limits[1])
    assert bag(found, "doc_id", "n_shingles", "component_id") == expect(rows, brute.jaccard([r[:2] for r in rows]))
    if limits[0] == 1:
        assert jaccard_join.join_components(empty).count() == 0


def test_line_crf(spark, docs, rows, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learn = table.where(is_learned("doc_id", 4, 2)).join(labels, "doc_id")
    model = quality_crf.train(learn, "doc_id", "text", "quality")
    held = quality_crf.score(table, model).where(~is_learned("row.doc_id", 4, 2)).select("row.doc_id", "result.score").join(labels, "doc_id").toPandas()
    assert ((held["score"] >= 0.7) == (held["quality"] == 1)).mean() > 0.93
    odd = quality_crf.score(docs, model).select("result.score").collect()
    assert len(odd) == len(rows) and all(0 <= r[0] <= 1 for r in odd)
    assert quality_crf.score(empty, model).count() == 0
    nothing = quality_crf.train(learn.limit(0), "doc_id", "text", "quality")
    assert {round(r[0], 6) for r in quality_crf.score(docs, nothing).select("result.score").collect()} == {0.5}


def test_forward_backward_by_enumeration():
    draw = np.random.default_rng(5)
    emission, step = draw.normal(size=7), draw.normal(size=(2, 2))
    first = np.array([0, 3, 4, 7])
    odds = quality_crf.log_odds(emission, first, step)[2]
    for a, b in zip(first[:-1], first[1:]):
        total = np.zeros((b - a, 2))
        for number in range(2 ** (b - a)):
            states = [number >> k & 1 for k in range(b - a)]
            weight = np.exp(sum(e * s for e, s in zip(emission[a:b], states)) + sum(step[x, y] for x, y in zip(states, states[1:])))
            for k, s in enumerate(states):
                total[k, s] += weight
        assert odds[a:b] == pytest.approx(np.log(total[:, 1] / total[:, 0]))


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json())
    pieces = packing.pack(docs, tokenizer_json(), length=512).collect()
    whole = Counter()
    streams = defaultdict(dict)
    for r in pieces:
        streams[r["sequence_id"]][r["offset"]] = r
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    last = max(streams)
    flow = []
    for number, held in sorted(streams.items()):
        at = 0
        for offset in sorted(held):
            assert offset == at
            at += held[offset]["length"]
            flow.append(held[offset])
        assert at == 512 or number == last
    # Pieces of one document follow each other, so the stream can be put together again.
    ids = b""
    for r in flow:
        ids = r["ids"] if r["start"] == 0 else ids + r["ids"]
        if r["start"] + r["length"] == r["doc_tokens"]:
            whole[(r["doc_id"], ids)] += 1
    wanted = Counter((doc, np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for doc, text, *_ in rows)
    assert whole == wanted
    assert packing.pack(empty, tokenizer_json()).count() == 0


def test_hilbert_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
