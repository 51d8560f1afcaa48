import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from quadrat.llm import columnwise as cw

DRAW = random.Random(8)


def brute(texts, length):
    """Removed spans and remaining bytes of each text."""
    data = [(t or "").encode() for t in texts]
    places = {}
    for i, x in enumerate(data):
        for at in range(len(x) - length + 1):
            places.setdefault(x[at : at + length], []).append((i, at))
    gone = [bytearray(len(x)) for x in data]
    for hits in places.values():
        if len(hits) > 1:
            for i, at in hits:
                gone[i][at : at + length] = b"\1" * length
    out = []
    for x, g in zip(data, gone):
        edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + bytes(g) + b"\0", np.uint8).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((spans, bytes(c for c, z in zip(x, g) if not z)))
    return out


def expected(rows, length):
    found = brute([t for _, t in rows], length)
    return sorted(
        [
            (i, len((t or "").encode()), spans, hashlib.sha256(left).hexdigest())
            for (i, t), (spans, left) in zip(rows, found)
        ],
        key=repr,
    )


def reported(docs, length):
    rows = cw.report(docs, length).collect()
    return sorted([(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], r.kept_sha256) for r in rows], key=repr)


def corpus(length):
    word = lambda: "".join(DRAW.choices("abcdeé ", k=5))
    text = lambda n: "".join(word() for _ in range(n))
    passage, line = text(length), text(length // 8 + 1)
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * (length - 1)), (5, "y" * length), (6, "z" * (3 * length))]
    rows += [(7, "ab" * length), (8, "0" * (2 * length)), (9, "0" * length + text(9)), (None, text(length))]
    rows += [(10, text(40)), (11, "\0" * length + passage), (12, "\0" + passage + "\0")]
    for k in range(20, 40):
        rows.append((k, text(DRAW.randint(1, length)) + passage[DRAW.randint(0, 5) :] + text(DRAW.randint(0, 30))))
    for k in range(40, 60):
        rows.append((k, "\n".join([text(3), line, text(4), line, line])))
    base = text(2 * length)
    for k in range(60, 80):
        copy = list(base)
        for _ in range(DRAW.randint(0, 3)):
            copy[DRAW.randrange(len(copy))] = "#"
        rows.append((k, "".join(copy)))
    # repeats within one piece: a stretch of a short period amid other text
    rows += [(90 + k, text(length) + "abcdefghij"[: k + 2] * (2 + 2 * length // (k + 2)) + text(length)) for k in range(3)]
    rows += [(95, text(9) + "0123456789" * (1 + length // 10) + "01234567" + text(9))]
    return rows + [(80, base), (80, base), (81, base), (82, base + base)]


@pytest.mark.parametrize("length", [1, 2, 16, 50])
def test_equals_brute_force(make, length):
    rows = corpus(max(length, 16))
    assert reported(make(rows), length) == expected(rows, length)


def test_small_collections_and_files(make, monkeypatch):
    monkeypatch.setattr(cw, "COLLECTION", 300)
    monkeypatch.setattr(cw, "SPOOL", 200)
    monkeypatch.setattr(cw, "CHUNK", 16)
    rows = corpus(16)
    assert reported(make(rows), 16) == expected(rows, 16)


def test_large_groups_are_counted(make, monkeypatch):
    monkeypatch.setattr(cw, "GROUP", 200)
    rows = corpus(16)
    assert reported(make(rows), 16) == expected(rows, 16)


def test_long_texts_and_remove(make):
    words = [f"w{k}" for k in range(3000)]
    long = " ".join(DRAW.choices(words, k=20_000))
    rows = [(1, long), (2, long[50_000:51_000] + "Ω"), (3, " ".join(words)), (4, None)]
    docs = make(rows)
    assert reported(docs, 400) == expected(rows, 400)
    left = cw.remove(docs)
    assert left.columns == [c for c in docs.columns if c != "kept"] + ["kept"]
    want = dict(zip((r[0] for r in rows), (kept for _, kept in brute([t for _, t in rows], 400))))
    assert {r.doc_id: bytes(r.kept) for r in left.collect()} == want


def test_empty(make):
    assert reported(make([]), 400) == []
    assert reported(make([(1, None), (2, "a")]), 400) == expected([(1, None), (2, "a")], 400)


@pytest.mark.parametrize("spool", [40, 1 << 20])
def test_order_and_prefixes(tmp_path, monkeypatch, spool):
    """Every suffix's place and common prefix, against sorting them all."""
    monkeypatch.setattr(cw, "SPOOL", spool)
    monkeypatch.setattr(cw, "CHUNK", 3 if spool == 40 else 1 << 20)
    for letters in (b"ab", b"abcd\0"):
        for _ in range(40):
            texts = [bytes(DRAW.choices(letters, k=DRAW.randint(1, 12))) for _ in range(DRAW.randint(1, 8))]
            texts.sort(key=lambda t: -len(t))
            common, whole, shorter = cw.suffix_places(texts, str(tmp_path))
            at = {}
            for i, text in enumerate(texts):
                place = int(whole[i])
                for j in range(len(text)):
                    at[place] = text[j:]
                    place = int(shorter[place - len(texts)])
                assert place == i
            assert sorted(at) == list(range(len(texts), len(common)))
            order = [at[p] for p in sorted(at)]
            assert order == sorted(order)
            shared = [0] + [next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y))) for x, y in zip(order, order[1:])]
            assert common.tolist() == [0] * len(texts) + shared
    assert not list(tmp_path.iterdir())


def test_memory_of_a_collection(tmp_path):
    """Bytes held at once for each byte of the pieces, all different but for a passage."""
    words = [bytes(DRAW.choices(b"abcdefgh", k=9)) for _ in range(4000)]
    passage = b" ".join(DRAW.choices(words, k=45))
    texts = [b" ".join(DRAW.choices(words, k=15)) + passage[: 400 + k % 40] for k in range(1500)]
    tracemalloc.start()
    found = cw.repeated_starts(texts, [1] * len(texts), 400, str(tmp_path))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(ranges[0][0] <= 149 <= ranges[0][1] for ranges in found)
    assert peak < 20 * sum(map(len, texts))
