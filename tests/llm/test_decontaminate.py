import re

from quadrat.llm import decontaminate as d

A = " ".join(f"w{k}" for k in range(14))
ITEMS = [(1, A), (2, "Short ITEM here"), (3, None), (4, " -- "), (None, "lone"), (2, "Short item here"), (5, A)]
TEXTS = [
    (0, f"start {A.upper()} end"),
    (1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 only nine"),
    (2, "w1, w2; w3 w4 w5 w6 w7 w8 w9 w10!"),
    (3, "a short-item HERE, and short item here"),
    (4, None),
    (5, ""),
    (6, " ... "),
    (7, "É lone é"),
    (None, A),
    (0, f"start {A.upper()} end"),
    (0, "another text of the same id"),
    (9, "lone " * 3000),
]


def words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                ids.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(ids), bool(hit)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_report_equals_brute_force(spark, make):
    found = d.report(make(TEXTS), items_table(spark, ITEMS)).collect()
    got = sorted((tuple(r) for r in found), key=repr)
    assert got == sorted(((i, *brute(t, ITEMS)) for i, t in TEXTS), key=repr)


def test_blocks_find_the_same(spark, make, monkeypatch):
    monkeypatch.setattr(d, "SET_BYTES", 300)
    found = d.report(make(TEXTS), items_table(spark, ITEMS)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(
        ((i, *brute(t, ITEMS)) for i, t in TEXTS), key=repr
    )


def test_removal(spark, make):
    docs, items = make(TEXTS), items_table(spark, ITEMS)
    kept = d.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 4, 5, 6]
    texts = {(r.doc_id, r.text) for r in d.remove_spans(docs, items).collect()}
    assert (0, "start end") in texts and (2, "!") in texts and (4, None) in texts
    assert (3, "a, and") in texts and (7, "É é") in texts


def test_empty_tables(spark, make):
    assert d.report(make([]), items_table(spark, ITEMS)).count() == 0
    found = d.report(make(TEXTS), items_table(spark, [])).collect()
    assert not any(r.contaminated for r in found) and len(found) == len(TEXTS)
