import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import toxicity


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(30):
        lengths = rng.integers(0, 6, 4)
        step = rng.normal(size=3)
        score = rng.normal(size=lengths.sum())
        first = np.concatenate(([0], np.cumsum(lengths)))
        move = np.array([[0, step[0]], [step[1], step[2]]])
        want = []
        for a, b in zip(first, first[1:]):
            s, total, of_toxic = score[a:b], 0.0, np.zeros(b - a)
            for tags in itertools.product([0, 1], repeat=b - a):
                w = np.exp(np.dot(s, tags) + sum(move[x, y] for x, y in zip((0, *tags), tags)))
                total += w
                of_toxic += w * np.array(tags)
            want.append(of_toxic / total)
        assert np.allclose(toxicity.marginals(np.exp(score), first, step), np.concatenate(want))


def corpus(n=700, seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "ti", "é"]) for _ in range(rng.randint(1, 4)))
    rows, toxic = [], {}
    for k in range(n):
        w = [word() for _ in range(rng.randint(8, 60))]
        toxic[k] = rng.random() < 0.3
        if toxic[k]:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["Gorm,", "blurk", "GORM!", "skza" + word()]))
        rows.append((k, " ".join(w)))
    return rows, toxic


@pytest.fixture(scope="module")
def scored(spark, frame):
    rows, toxic = corpus()
    labels = spark.createDataFrame([(k, int(v), 1) for k, v in toxic.items()], "doc_id long, toxic int, quality int")
    out = toxicity.toxicity(frame(rows), labels).collect()
    return dict(rows), toxic, {r.doc_id: r for r in out}


def test_held_out_accuracy(scored):
    texts, toxic, out = scored
    assert len(out) == len(texts)
    held = [k for k in texts if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sorted(held) == sorted(k for k, r in out.items() if r.held_out)
    assert np.mean([(out[k].predicted == 1) == toxic[k] for k in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())


def test_spans_are_the_marked_words(scored):
    texts, _, out = scored
    found = {texts[k][s.start : s.end].lower() for k, r in out.items() for s in r.spans}
    assert {"gorm", "blurk"} <= found
    share = np.mean([w.startswith(("gorm", "blurk", "skza")) for w in found])
    assert share > 0.9


def test_labels_of_held_out_rows_change_nothing(spark, frame):
    rows, toxic = corpus(300, 8)
    docs = frame(rows)
    labels = spark.createDataFrame([(k, int(v)) for k, v in toxic.items()], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(tuple(r)[:4] for r in toxicity.toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_odd_rows_and_bounded_sample(spark, frame, odd_rows):
    rows, toxic = corpus(200, 9)
    labels = spark.createDataFrame(
        [(k, int(v)) for k, v in toxic.items()] + [(0, 1), (None, 1), (3, None)], "doc_id long, toxic int"
    )
    docs = frame(odd_rows + [(k + 2000, t) for k, t in rows] + rows)
    out = toxicity.toxicity(docs, labels, max_docs=25).collect()
    assert len(out) == len(odd_rows) + 400
    empty = {r.score for r in out if r.doc_id in (2, 3) and not r.spans}
    assert empty and all(0 <= s <= 1 for s in empty)
    assert all(r.held_out for r in out if r.doc_id is None)


@pytest.mark.parametrize("rows, want", [([], 0.0), ([(2, 0)], 0.0), ([(2, 1), (4, 1)], 1.0)])
def test_labels_of_one_class(spark, frame, rows, want):
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    docs = frame([(k, "a b") for k in range(8)])
    assert {round(r.score, 6) for r in toxicity.toxicity(docs, labels).collect()} == {want}


def test_clean_rows_stay_with_their_columns(spark, frame):
    rows, toxic = corpus(400, 11)
    docs = frame(rows)
    labels = spark.createDataFrame([(k, int(v)) for k, v in toxic.items()], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.keep_clean(docs, model)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert np.mean([(k in kept) != v for k, v in toxic.items()]) > 0.97
    assert toxicity.keep_clean(frame([]), model).count() == 0


def test_sample_is_bounded_in_bytes(spark, frame):
    sized = lambda *sizes: [{"doc_id": k, "bytes": n} for k, n in enumerate(sizes)]
    assert [r["doc_id"] for r in toxicity._within(sized(5, 90, 4, 1), 10)] == [0, 2, 3]
    assert [r["doc_id"] for r in toxicity._within(sized(50, 30, 40), 10)] == [1]
    assert toxicity._within([], 10) == []
    rows, toxic = corpus(200)
    labels = [(k, int(v)) for k, v in toxic.items()]
    model = toxicity.train(frame(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), max_bytes=2000)
    assert toxicity.score(frame(rows), model).count() == len(rows)
