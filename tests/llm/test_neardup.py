import random

import numpy as np

from quadrat.llm import neardup as nd


def brute(rows):
    sets = []
    for _, t in rows:
        w = nd.words_of(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and label[i] != label[j]:
                    low = min(label[i], label[j])
                    old = {label[i], label[j]}
                    label = [low if x in old else x for x in label]
                    changed = True
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        if not sets[i]:
            ids = [doc] if doc is not None else []
        first = min(ids, default=None)
        out.append((doc, len(sets[i]), first, first is None or doc == first))
    return out


def corpus():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    rows = [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "One TWO"), (105, "two one")]
    rows += [(106, "É a b c d"), (107, "é a b c d"), (108, "a a a a a"), (109, "a a a a a a a")]
    rows += [(None, "no id but a text with several words here"), (110, "no id but a text with several words here")]
    rows += [(None, "never an id"), (103, "one two")]
    n = 1000
    for _ in range(25):
        base = [word() for _ in range(draw.randint(12, 90))]
        rows.append((n, " ".join(base)))
        for _ in range(draw.randint(1, 6)):
            n += 1
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy).upper() if n % 3 else "\t".join(copy)))
        n += 1
    return rows


def test_equals_brute_force(make):
    rows = corpus()
    got = sorted((tuple(r) for r in nd.near_duplicates(make(rows)).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_groups_in_small_blocks(make, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_NODES", 4)
    draw = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for n in range(120):
        copy = list(base)
        for _ in range(draw.randint(0, 5)):
            copy[draw.randrange(60)] = f"x{draw.randrange(1000)}"
        rows.append((n, " ".join(copy)))
    got = sorted(tuple(r) for r in nd.near_duplicates(make(rows)).collect())
    assert got == sorted(brute(rows))


def test_what_is_moved_follows_the_members(make, monkeypatch):
    """Many texts that are nearly linked: no row per pair, and what must be joined is."""
    common = [f"w{k}" for k in range(200)]
    texts = [" ".join(common[:165] + [f"u{i}x{k}" for k in range(35)]) for i in range(60)]
    texts += [" ".join(common[:190] + [f"v{i}x{k}" for k in range(10)]) for i in range(3)]
    rows = list(enumerate(texts))
    made = []
    real = nd.cut_lineage

    def counting(df):
        out = real(df)
        if set(df.columns) in ({"a", "b"}, set("key band first block sides pairs".split())):
            made.append(out.count())
        return out

    monkeypatch.setattr(nd, "HUB_ROUNDS", ((0, 1), (1, 2)), raising=False)
    monkeypatch.setattr(nd, "cut_lineage", counting)
    # every sketch looks likely, as those near the bound do
    monkeypatch.setattr(nd, "DEVIATIONS", 40.0)
    found = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(make(rows)).collect()}
    assert found == {r[0]: r[2] for r in brute(rows)}
    assert max(made) < 4 * len(rows)


def test_keep_one_and_empty(make):
    rows = corpus()
    docs = make(rows)
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    want = [r[0] for r in brute(rows) if r[3]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(set(want) - {None}, key=repr) + [
        None for w in want if w is None
    ]
    assert nd.near_duplicates(make([])).count() == 0


def test_estimate_is_close():
    mix = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.75, 0.9):
        union = mix.integers(0, 1 << 63, 2000, dtype=np.uint64)
        common = int(share * 2000)
        rest = (2000 - common) // 2
        a, b = union[: common + rest], np.concatenate([union[:common], union[common + rest :]])
        sketches = [nd.registers(np.unique(x))[None] for x in (a, b)]
        got = nd.jaccard_estimate(*sketches, np.array([len(a)]), np.array([len(b)]))
        assert abs(got[0] - share) < 4 * np.sqrt(share * (1 - share) / nd.REGISTERS)


def test_sketches_merge():
    x = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 900, dtype=np.uint64))
    merged = np.maximum(nd.registers(x[:500]), nd.registers(x[400:]))
    assert (merged == nd.registers(x)).all()
