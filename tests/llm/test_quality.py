import random
import re
from collections import Counter

from quadrat.llm import quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    counts, covered = Counter(wins), set()
    for i, x in enumerate(wins):
        if counts[x] > 1:
            covered |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_statistics_equal_brute_force(make):
    draw = random.Random(3)
    word = lambda: draw.choice(["a", "b", "é😀", "c#", "<d>", "longer"])
    texts = [None, "", " \n\n", "x", "a b c d e f g h", "a " * 500, "same line\nsame line\n same line\n\n\n", "w " * 5000]
    texts += ["".join(word() + draw.choice([" ", "\n", "\t", "  ", "\xa0"]) for _ in range(draw.randint(1, 80))) for _ in range(150)]
    texts += [" ".join(f"u{k}" for k in range(30)) + " " + " ".join(f"u{k}" for k in range(5, 14))]
    rows = list(enumerate(texts)) + [(None, "q"), (3, "x"), (3, "x")]
    stats = quality.statistics(make(rows)).withColumn("base_failed", quality.base_failed()).collect()
    got = sorted(
        (repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in stats
    )
    assert got == sorted((repr(i), *brute(t)) for i, t in rows)


def corpus(n, seed):
    draw = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(25, 60))]
        kind = k % 4
        if kind == 1:
            words = [w + "##" for w in words]
        elif kind == 2:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, 0 if kind in (1, 2) else 1))
    return rows, labels


def test_list_on_held_out_texts(spark, make):
    rows, labels = corpus(600, 1)
    table = spark.createDataFrame(labels + [(9999, 1), (0, None)], "doc_id long, quality int")
    rules = quality.learn(quality.statistics(make(rows)), table)
    assert 1 <= len(rules) <= quality.RULES
    assert all(str(c) for rule in rules for c in rule)
    rows, labels = corpus(200, 2)
    stats = quality.statistics(make(rows)).select("*", *quality.measures())
    found = {r.doc_id: r.rule for r in stats.withColumn("rule", quality.fired(rules)).collect()}
    assert sum((found[k] is None) == bool(q) for k, q in labels) >= 196


def test_without_labels(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = [(1, " ".join(f"w{k}" for k in range(40))), (2, None)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(make(rows), none).collect()}
    assert got == {1: (False, True), 2: (True, False)}
    assert quality.judge(make([]), none).count() == 0
