import random

import pytest

from quadrat.llm import piececounts
from quadrat.llm.queries import tokenizer_file


def greedy(word, initial, continuing):
    pieces, vocabulary, at = 0, initial, 0
    while at < len(word):
        stop = next((j for j in range(len(word), at, -1) if word[at:j] in vocabulary), None)
        if stop is None:
            return 0
        at, vocabulary, pieces = stop, continuing, pieces + 1
    return pieces


def test_automaton_equals_longest_match():
    draw = random.Random(1)
    for t in range(2000):
        letters = b"ab" if t % 2 else b"abc"

        def some():
            return {bytes(draw.choice(letters) for _ in range(draw.randint(1, 5))) for _ in range(draw.randint(0, 8))}

        initial, continuing = some(), some()
        automaton = piececounts.Automaton(initial, continuing)
        for _ in range(15):
            word = bytes(draw.choice(letters) for _ in range(draw.randint(1, 12)))
            assert automaton.count(word) == greedy(word, initial, continuing)


def test_counts(make):
    pytest.importorskip("public_tokenizers")
    vocabulary = piececounts.byte_vocabulary(tokenizer_file("byte_bpe_50k.json"))
    initial, continuing = map(set, vocabulary)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "naïve Straße 日本語 😀 !!!"), (None, "word " * 9000), (3, "hello, world")]
    got = piececounts.count_pieces(make(rows), vocabulary).collect()
    want = []
    for doc, text in rows:
        words = (text or "").encode().split()
        counts = [greedy(w, initial, continuing) for w in words]
        want.append((doc, len(words), sum(counts) + counts.count(0), counts.count(0)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    unknown = piececounts.count_pieces(make(rows), ([b"a"], [])).collect()
    assert all(r.n_tokens == r.n_unknown == r.n_words for r in unknown)


def test_equals_word_pieces_of_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    initial, continuing = {b"un", b"a", b"able", b"b"}, {b"aff", b"able", b"ab", b"l", b"e", b"a"}
    vocabulary = {"[UNK]": 0}
    for piece in [p.decode() for p in initial] + ["##" + p.decode() for p in continuing]:
        vocabulary[piece] = len(vocabulary)
    model = tokenizers.models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**6)
    automaton = piececounts.Automaton(initial, continuing)
    draw = random.Random(2)
    for _ in range(3000):
        word = "".join(draw.choice(["un", "aff", "able", "ab", "l", "e", "a", "b", "f"]) for _ in range(draw.randint(1, 6)))
        tokens = [t.value for t in model.tokenize(word)]
        assert automaton.count(word.encode()) == (0 if "[UNK]" in tokens else len(tokens))


def lone_greedy(word, initial, continuing):
    """Where no initial piece fits: one piece for the lone start, then continuing pieces."""
    if any(word[:j] in initial for j in range(1, len(word) + 1)):
        return greedy(word, initial, continuing)
    rest = greedy(word, continuing, continuing)
    return rest and rest + 1


def test_empty_initial_piece_reads_no_byte():
    draw = random.Random(3)
    for _ in range(1000):
        initial, continuing = (
            {bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(0, 6))}
            for _ in range(2)
        )
        automaton = piececounts.Automaton([b"", *initial], continuing)
        for _ in range(15):
            word = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 10)))
            assert automaton.count(word) == lone_greedy(word, initial, continuing)


def test_no_utf8_text_is_unknown(make):
    pytest.importorskip("public_tokenizers")
    file = tokenizer_file("byte_bpe_50k.json")
    vocabulary = piececounts.byte_vocabulary(file, lone_blank=True)
    initial, continuing = map(set, vocabulary)
    texts = ["中文 カタカナ 한국어 😀 ไทย ɑ", "中文没有空格的一整段文字" * 50]
    texts += [" ".join(chr(c) for c in range(a, min(a + 4096, 0x110000)) if not 0xD800 <= c < 0xE000) for a in range(0, 0x110000, 4096)]
    got = piececounts.count_pieces(make(list(enumerate(texts))), vocabulary).collect()
    assert len(got) == len(texts) and all(r.n_unknown == 0 for r in got)
    by_id = {r.doc_id: r for r in got}
    for k in (0, 1):
        want = sum(lone_greedy(w, initial, continuing) for w in texts[k].encode().split())
        assert by_id[k].n_tokens == want > by_id[k].n_words
    old = piececounts.byte_vocabulary(file)
    assert set(old[0]) == initial - {b""} and old[1] == vocabulary[1]
