"""Word-piece counts by a linear longest-match automaton.

A word is cut greedily into the longest pieces of a vocabulary; only the number of pieces
is wanted. The trie of the pieces gets failure links: where no child fits, the link leads to
the node for what remains of the text read so far once the longest piece, or several, has
been popped, and says how many were popped. Each byte is then read once, and no piece is
ever built.

Words stand between ASCII white space. A word's first piece comes from the initial pieces,
all others from the continuing ones; a word that cannot be cut counts as one unknown piece.
An empty initial piece stands for the lone start of a word: where no longer initial piece
fits, it is popped without reading a byte, and the continuing pieces go on. Bytes are UTF-8.

Defined cases: null, empty and blank texts have no words; a vocabulary without pieces makes
every word unknown; rows that repeat are counted each; other columns are not looked at.
"""

from __future__ import annotations

import json
import sys
import types
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship_with_tasks

ship_with_tasks(__name__)

MEMORY_WORDS = 400_000


class Automaton:
    """The trie of initial pieces, from node 0, and of continuing pieces, from node 1."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes]) -> None:
        self.children: list[dict[int, int]] = [{}, {}]
        ends, lone = [False, False], False
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                node = root
                for byte in piece:
                    after = self.children[node].get(byte)
                    if after is None:
                        after = self.children[node][byte] = len(self.children)
                        self.children.append({})
                        ends.append(False)
                    node = after
                ends[node] = node > 1
                lone |= node == 0
        # where to go on when no child fits (-1: nowhere), and how many pieces that pops
        self.link, self.popped = [-1] * len(ends), [0] * len(ends)
        if lone:
            self.link[0], self.popped[0] = 1, 1
        queue = deque([0, 1])
        while queue:
            above = queue.popleft()
            for byte, node in self.children[above].items():
                queue.append(node)
                if ends[node]:
                    # all that was read is one piece: nothing remains
                    self.link[node], self.popped[node] = 1, 1
                else:
                    at, pops = self.link[above], self.popped[above]
                    while at >= 0 and byte not in self.children[at]:
                        pops += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[node], self.popped[node] = self.children[at][byte], pops

    def count(self, word: bytes) -> int:
        """Number of pieces; 0 where the word cannot be cut."""
        children, link, popped = self.children, self.link, self.popped
        node = pieces = 0
        for byte in word:
            after = children[node].get(byte)
            while after is None:
                pieces += popped[node]
                node = link[node]
                if node < 0:
                    return 0
                after = children[node].get(byte)
            node = after
        # pop what is left until nothing remains after a piece
        while node != 1:
            pieces += popped[node]
            node = link[node]
            if node < 0:
                return 0
        return pieces


def byte_vocabulary(path: str, lone_blank: bool = False) -> tuple[list[bytes], list[bytes]]:
    """(initial, continuing) pieces of a byte-level vocabulary file.

    Its pieces spell bytes as printable characters; those that begin with a blank start a
    word. With ``lone_blank`` the blank alone, where the file has it, is an empty initial
    piece, so that a word can begin with any continuing piece.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in plain}
    spelled |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    initial, continuing = [], []
    for token in sorted(tokens):
        if all(c in spelled for c in token):
            piece = bytes(spelled[c] for c in token)
            if piece[:1] == b" ":
                initial.append(piece[1:])
            else:
                continuing.append(piece)
    return [p for p in initial if p or lone_blank], continuing


def _memory(key: str) -> dict[bytes, int]:
    """The worker's memory of counted words: it outlives the task."""
    place = sys.modules.setdefault("_worker_counts", types.ModuleType("_worker_counts"))
    return place.__dict__.setdefault(key, {})


def count_pieces(docs: DataFrame, vocabulary: tuple[list[bytes], list[bytes]]) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens, n_unknown (longs).

    ``n_tokens`` counts pieces, one for each unknown word.
    """
    initial, continuing = vocabulary
    name = f"{len(initial)}:{len(continuing)}:{hash((tuple(initial), tuple(continuing)))}"
    made = docs.sparkSession.sparkContext.broadcast((initial, continuing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = Automaton(*made.value), _memory(name)
        for batch in batches:
            sizes, totals, unknown = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                if len(known) > MEMORY_WORDS:
                    known.clear()
                for word in set(words).difference(known):
                    known[word] = automaton.count(word)
                counts = list(map(known.__getitem__, words))
                none = counts.count(0)
                sizes.append(len(words))
                totals.append(sum(counts) + none)
                unknown.append(none)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, totals, unknown))],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    kinds = "doc_id long, n_words long, n_tokens long, n_unknown long"
    return docs.select("doc_id", "text").mapInArrow(run, kinds)
