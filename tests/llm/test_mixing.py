from collections import defaultdict

import pytest

from quadrat.llm import mixing

ROWS = [(k, "w " * (1 + k % 7), f"s{k % 5}") for k in range(200)] + [
    (1000, "one two", None),
    (1001, None, "s1"),
    (1002, "", "empty"),
    (None, "a b c", "s2"),
    (3, "w " * 4, "s3"),
    (5000, "big " * 3000, "s0"),
]


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        heavy = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / heavy > 3 * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / heavy for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_plan(make):
    sizes = defaultdict(int)
    for _, text, source in ROWS:
        sizes[source] += len((text or "").split())
    want = targets(sizes)
    docs = make(ROWS)
    got = mixing.plan(docs).collect()
    assert len(got) == len(ROWS)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_target[round(r.target, 6)] += r.taken
    assert sorted(by_target) == sorted({round(t, 6) for t in want.values()})
    for s, t in want.items():
        same = [x for x in want if abs(want[x] - t) < 1e-6]
        assert by_target[round(t, 6)] == pytest.approx(sum(round(want[x]) for x in same), abs=len(same))
    again = mixing.plan(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_mix_gives_what_was_planned(make):
    docs = make(ROWS)
    steps = mixing.plan(docs).collect()
    rows = mixing.mix(docs)
    assert rows.columns == docs.columns
    got = rows.collect()
    assert sum(len(r.text.split()) for r in got) == sum(r.taken for r in steps)
    texts = {t for _, t, _ in ROWS}
    assert sum(r.text not in texts for r in got) <= 7  # one cut per source


def test_slices_give_the_same_order(make, monkeypatch):
    import quadrat.llm.common as common

    one = mixing.plan(make(ROWS)).collect()
    monkeypatch.setattr(common, "SLICE_ROWS", 10)
    many = mixing.plan(make(ROWS)).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)


def test_empty(make):
    assert mixing.plan(make([])).count() == 0
    assert mixing.mix(make([(1, None), (2, " ")])).count() == 0
