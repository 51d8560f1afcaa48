import os
import zlib

import numpy as np
import pytest

from quadrat.llm import repair, tokenids
from quadrat.llm.queries import tokenizer_file

pytest.importorskip("public_tokenizers")
FILE = tokenizer_file("word_bpe_49k.json")
TEXTS = [
    "", "  ", "It's  DON'T x1²  ½ É ß ÀÖ you'll", "a<|endoftext|>b", "Straße İstanbul ΣΑΣ", "x\x1cy z\x85w",
    "naïve—dash “q”", "''s 's'S ' s", "éa é", "1,000.00!!! ###$%^ _a_b_", "ÿŸ µ ª º × ÷ ¿¡", "a'llb 'LL",
    "日本語 text", "word " * 5000, "\xa0no-break\xa0", "x" * 3000, "​ zero", "ǅ ﬁ",
]


def whole(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    coder = tokenids.Encoder(FILE)
    for text, got in zip(TEXTS, coder.encode(TEXTS)):
        assert got.tolist() == whole(text), text
    every = "".join(map(chr, range(1, 256)))
    pairs = [f"{a}{b} {a} {b}{a}'s" for a in every for b in "a 1'é"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(FILE).encode_batch(pairs, add_special_tokens=False)
    for text, got, want in zip(pairs, coder.encode(pairs), library):
        assert got.tolist() == want.ids, repr(text)


@pytest.mark.parametrize("kind", ["random", "repeats", "one", "runs"])
def test_round_trip(kind):
    draw = np.random.default_rng(4)
    lengths = draw.integers(1, 400, 60)
    n = int(lengths.sum())
    ids = {
        "random": draw.integers(0, 49408, n),
        "repeats": np.resize(draw.integers(0, 99, 37), n),
        "one": np.ones(n, int),
        "runs": np.repeat(draw.integers(0, 5, n), 9)[:n],
    }[kind].astype(np.uint32)
    data = repair.pack([None, *range(59)], lengths, ids, 49408)
    shard = repair.Shard(data)
    assert (shard.all_ids() == ids).all() and shard.doc_ids == [None, *range(59)]
    edges = np.concatenate([[0], np.cumsum(lengths)])
    for k in range(60):
        assert (shard.document(k) == ids[edges[k] : edges[k + 1]]).all()
    for a, b in draw.integers(0, n, (200, 2)):
        assert (shard.ids(min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()
    if kind != "random":
        assert len(data) < n  # of 4 n bytes


def test_table(make, monkeypatch):
    rows = [(50 - k, t) for k, t in enumerate(TEXTS)] + [(None, "null id"), (50, "again"), (3, None)]
    monkeypatch.setattr(tokenids, "SHARD_IDS", 64)
    got = tokenids.token_table(make(rows).repartition(5), FILE).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = []
    for doc, text in rows:
        tokens = np.array([*whole(text), 1], "<u4")
        want.append((doc, len(tokens), zlib.crc32(tokens.tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert tokenids.token_table(make([]), FILE).count() == 0


def test_no_frequent_pair_is_left():
    draw = np.random.default_rng(6)
    passage = draw.integers(0, 49408, 500)
    ids = np.tile(np.append(passage, 1), 40).astype(np.uint32)
    last = ids == 1
    last[:-1] |= np.diff(np.arange(len(ids)) // 501) > 0
    symbols, last, rules = repair.grammar(ids, last.copy(), 49408)
    # each copy, a document of its own, is one symbol, not one for every 16 ids
    assert len(symbols) == 40 and len(set(symbols.tolist())) == 1 and last.all()
    for seq in (np.repeat(draw.integers(0, 5, 3000), 9), draw.integers(0, 40, 20000)):
        symbols, last, rules = repair.grammar(seq.astype(np.uint32), np.zeros(len(seq), bool), 49408)
        pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
        assert len(rules) + 49408 < 1 << 16
        assert np.unique(pairs, return_counts=True)[1].max() < repair.LEAST
    # many different passages: symbols may run out, and no more than there are
    lots = np.tile(draw.integers(0, 49408, 40000), 10).astype(np.uint32)
    _, _, rules = repair.grammar(lots, np.zeros(len(lots), bool), 49408)
    assert len(rules) + 49408 == 1 << 16


def test_reading_shards_lets_go_of_the_encoder():
    import sys

    tokenids.encoder(FILE)
    assert "_worker_encoders" in sys.modules
    assert list(tokenids._documents(iter([]))) == []
    assert "_worker_encoders" not in sys.modules


def test_memory_and_library_see_pieces_not_words(monkeypatch):
    coder = tokenids.Encoder(FILE)
    words = [f"{a}-{b}{c}" for a in ("Ab", "cd'LL", "É") for b in ("x", "Yz", "don't") for c in range(100)]
    texts = [" ".join(words[k::7]) for k in range(7)]
    got = coder.encode(texts)
    # ab cd 'll é - x yz don 't and ten digits, whatever words they stand in
    held = [len(v) for v in vars(coder).values() if isinstance(v, dict)]
    assert sum(held) == 19
    for text, ids in zip(texts, got):
        assert ids.tolist() == whole(text)
    learned = []
    monkeypatch.setattr(coder, "_learn", learned.append)
    coder.encode([" ".join(reversed(words))])
    assert not learned


def test_texts_that_are_all_cut_or_all_whole():
    coder = tokenids.Encoder(FILE)
    for texts in ([], ["日本語", "a<|b"], [""], ["", " \xa0\x85", ""], ["'"], ["x'"], ["x'l", "l", "'r", "e's'm"], ["''d", "9't"]):
        assert [x.tolist() for x in coder.encode(texts)] == [whole(t) for t in texts]


def test_documents_are_gathered_in_order(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokenids, "BATCH_CHARS", 5)
    batches = [
        pa.RecordBatch.from_pydict({"doc_id": pa.array(d, pa.int64()), "text": pa.array(t, pa.string())})
        for d, t in (([None, 1], ["ab", None]), ([], []), ([2, 3], ["cdef", "g" * 9]), ([4], ["h"]))
    ]
    got = list(tokenids._gathered(iter(batches)))
    assert got == [([None, 1, 2], ["ab", "", "cdef"]), ([3], ["g" * 9]), ([4], ["h"])]


def test_encoder_learns_in_lots(monkeypatch):
    monkeypatch.setattr(tokenids, "LEARN", 5)
    coder, lots = tokenids.Encoder(FILE), []
    add = coder._add
    monkeypatch.setattr(coder, "_add", lambda pieces: (lots.append(len(pieces)), add(pieces)))
    for text, got in zip(TEXTS, coder.encode(TEXTS)):
        assert got.tolist() == whole(text), text
    assert max(lots) == 5 and sum(lots) == len(coder.pieces) == len(coder.lengths)
    assert coder.starts.dtype == coder.lengths.dtype == np.int32
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
