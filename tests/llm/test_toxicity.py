import random

import numpy as np
from pyspark.sql import functions as F

from quadrat.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    draw = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 4))) for _ in range(40)]
        toxic, junk = k % 5 == 0, k % 7 == 0
        if toxic:
            words[draw.randrange(40)] = draw.choice(["idiot", "scum", "moron,"])
        if junk:
            words[draw.randrange(40)] = "zzz!!"
        rows.append((k, " ".join(words)))
        labels.append((k, int(not junk), int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_cases(spark, make):
    rows, labels = corpus(500, 1)
    labels += [(3, None, None), (None, 1, 1), (10**6, 1, 1), (5, 0, 0)]
    extra = [(None, "scum"), (10_000, None), (10_001, ""), (10_002, "x " * 20000), (5, rows[5][1])]
    docs, table = make(rows + extra), spark.createDataFrame(labels, LABELS)
    chain = toxicity.train(docs, table, toxicity._label_columns())
    new, truth = corpus(300, 2)
    got = {r.doc_id: r.is_toxic for r in toxicity.scores(make(new), chain).collect()}
    assert sum(got[k] == bool(t) for k, _, t in truth) >= 291
    scored = toxicity.judge(docs, table).collect()
    assert len(scored) == len(rows) + len(extra)
    kept = toxicity.keep_clean(docs, table)
    assert kept.columns == docs.columns
    gone = sum(r.rejected for r in scored)
    assert kept.count() == len(scored) - gone and 95 <= gone <= 110


def test_nothing_to_learn_from(spark, make):
    docs = make([(1, "scum"), (2, None)])
    for labels in ([], [(1, 1, 0)], [(1, None, None)]):
        table = spark.createDataFrame(labels, LABELS)
        assert not any(r.rejected for r in toxicity.judge(docs, table).collect())
    assert toxicity.judge(make([]), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0


def test_chain_feeds_earlier_categories():
    draw = np.random.default_rng(0)
    n = 900
    first = draw.random(n) < 0.4
    # the second category is the first one's shadow: no feature of its own tells it
    second = first & (draw.random(n) < 0.95)
    third = draw.random(n) < 0.2
    rows = []
    for a, c in zip(first, third):
        row = set(draw.integers(3, 50, 6).tolist()) | ({0} if a else set()) | ({1} if c else set())
        rows.append(np.array(sorted(row)))
    labels = {"a": first.astype(int), "b": second.astype(int), "c": np.where(np.arange(n) < 30, -1, third)}
    links = toxicity.fit_chain(toxicity.Rows(rows, 50), labels, np.arange(n) % 3)
    assert [len(x.earlier) for x in links] == [0, 1, 2]
    assert links[1].earlier[0] > 0 and all(0 < x.threshold < 1 for x in links)


def test_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1.0, 1, 0, 0])) == 0.5
    assert toxicity.best_threshold(np.array([0.9]), np.array([0.0])) > 1


def test_label_columns(spark):
    df = spark.createDataFrame([(1, 0, 1)], LABELS).select(*[c.alias(n) for n, c in toxicity._label_columns().items()])
    assert tuple(df.first()) == (1, 1) and F is not None


def test_the_sample_is_bounded_by_rows(spark, make):
    """An id that many rows share brings one of them, the same one whatever their order."""
    rows = [(1, f"text {k}") for k in range(300)] + [(2, "two"), (2, None), (3, "three"), (None, "x")]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in (1, 2, 3, 9)], "doc_id long, quality int, toxic int")
    categories = toxicity._label_columns()
    for sample in (2, 3):
        picked = [sorted(tuple(r) for r in toxicity.labelled(make(order), labels, categories, sample).select("text").fillna("").collect()) for order in (rows, rows[::-1])]
        assert picked[0] == picked[1] and len(picked[0]) <= sample
