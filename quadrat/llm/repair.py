"""Re-Pair grammars over token ids, and the shard format that stores them.

A shard holds whole documents. Pairs of neighbouring symbols that are frequent in it are
replaced by a nonterminal, again and again, until no pair occurs LEAST times or no symbol is
left; a pair never spans two documents. Each round replaces many pairs at once: where chosen pairs overlap, the left one goes first, every
second one of a run is taken.

Layout, little-endian: the head ``<4sIIQQQB`` (magic, first nonterminal, rules, documents,
symbols, ids, bytes of a symbol); one byte per document that is 1 where its id is null; then
arrays: document ids (int64), where each document's symbols begin (uint64, one more than
documents), where its ids begin (same), left and right symbol of each rule (uint32), length
of each rule's expansion (uint32), ids before every STEP-th symbol (uint64), symbols.
"""

from __future__ import annotations

import struct

import numpy as np

from ..session import ship_with_tasks

ship_with_tasks(__name__)

MAGIC, HEAD = b"RPG1", "<4sIIQQQB"
PER_ROUND, LEAST = 4096, 8
HASH_BITS = 17
STEP = 256


def grammar(ids: np.ndarray, last: np.ndarray, base: int, limit: int = 1 << 16):
    """(symbols, last, rules): ``last`` marks each document's last symbol.

    Symbols from ``base`` on are rules, a pair of smaller symbols each. At most ``limit``
    symbols exist; a limit of 2**16 keeps them in two bytes.
    """
    wide = limit > 1 << 16
    kind, shift = (np.uint64, np.uint64(32)) if wide else (np.uint32, np.uint32(16))
    seq, rules = ids.astype(kind), []
    while True:
        room = min(PER_ROUND, limit - base - len(rules))
        if len(seq) < 2 or room <= 0:
            break
        code = (seq[:-1] << shift) | seq[1:]
        inside = ~last[:-1]
        pairs, uses = np.unique(code[inside], return_counts=True)
        often = np.flatnonzero(uses >= LEAST)
        if not len(often):
            break
        if len(often) > room:
            often = np.sort(often[np.argsort(-uses[often], kind="stable")[:room]])
        chosen = pairs[often]
        slot = _slots(chosen, uses[often], code)
        at = np.flatnonzero((chosen[slot] == code) & inside)
        # every second position of a run of neighbouring positions
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) > 1
        order = np.arange(len(at))
        at = at[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
        used = np.bincount(slot[at], minlength=len(chosen))
        # a rule pays from its third use on
        pays = used >= 3
        at = at[pays[slot[at]]]
        if not len(at):
            break
        name = base + len(rules) + np.cumsum(pays) - 1
        rules += [(int(c >> shift), int(c & ((kind(1) << shift) - kind(1)))) for c in chosen[pays]]
        seq[at] = name[slot[at]]
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
    return seq, last, np.array(rules, np.uint32).reshape(-1, 2)


def _slots(chosen: np.ndarray, uses: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each code the only place in ``chosen`` where it can stand, by a hash table.

    Of two chosen codes with one hash the more frequent stays; the next round has the other.
    """
    kind = code.dtype.type
    factor, shift = kind(2654435769), kind(code.dtype.itemsize * 8 - HASH_BITS)
    table = np.zeros(1 << HASH_BITS, np.int32)
    order = np.argsort(uses, kind="stable")
    table[(chosen[order] * factor) >> shift] = order
    return table[(code * factor) >> shift]


def _expansions(base: int, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, start, length): each rule's expansion as a stretch of ``ids``."""
    parts: list[bytes] = []
    for a, b in rules.tolist():
        left = parts[a - base] if a >= base else a.to_bytes(4, "little")
        parts.append(left + (parts[b - base] if b >= base else b.to_bytes(4, "little")))
    length = np.array([len(p) // 4 for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), "<u4"), np.cumsum(length) - length, length


def stretches(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` one after another."""
    if not size.all():
        start, size = start[size > 0], size[size > 0]
    if not len(size):
        return pool[:0]
    ends = np.cumsum(size)
    # places grow by one, and jump where a stretch begins
    step = np.ones(ends[-1], np.int64)
    step[0] = start[0]
    step[ends[:-1]] = start[1:] - start[:-1] - size[:-1] + 1
    return pool[np.cumsum(step, out=step)]


def _lengths(base: int, rules: np.ndarray) -> np.ndarray:
    """Length of each rule's expansion."""
    length: list[int] = []
    for pair in rules.tolist():
        length.append(sum(length[s - base] if s >= base else 1 for s in pair))
    return np.array(length, np.int64)


def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, base: int) -> bytes:
    """A shard of documents whose ids, end ids included, follow each other in ``ids``."""
    last = np.zeros(len(ids), bool)
    stops = np.cumsum(lengths)
    last[stops - 1] = True
    symbols, last, rules = grammar(ids, last, base)
    length = _lengths(base, rules)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    size = np.concatenate([np.ones(base, np.int64), length])[symbols]
    offsets = np.concatenate([[0], np.cumsum(size)])
    head = struct.pack(HEAD, MAGIC, base, len(rules), len(doc_ids), len(symbols), len(ids), width)
    arrays = [
        (np.array([d is None for d in doc_ids]), "u1"),
        (np.array([d or 0 for d in doc_ids], np.int64), "<i8"),
        (np.concatenate([[0], np.flatnonzero(last) + 1]), "<u8"),
        (np.concatenate([[0], stops]), "<u8"),
        (rules[:, 0], "<u4"),
        (rules[:, 1], "<u4"),
        (length, "<u4"),
        (offsets[:-1][::STEP], "<u8"),
        (symbols, f"<u{width}"),
    ]
    return head + b"".join(a.astype(kind).tobytes() for a, kind in arrays)


class Shard:
    """Reads a packed shard; any stretch of ids is decoded from the symbols it lies in."""

    def __init__(self, data: bytes) -> None:
        magic, self.base, rules, docs, symbols, self.n_ids, width = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        nulls, ids = take("u1", docs), take("<i8", docs)
        self.doc_ids = [None if no else int(d) for no, d in zip(nulls, ids)]
        self.symbol_starts = take("<u8", docs + 1).astype(np.int64)
        self.id_starts = take("<u8", docs + 1).astype(np.int64)
        left, right = take("<u4", rules), take("<u4", rules)
        self.lengths = np.concatenate([np.ones(self.base, np.int64), take("<u4", rules)])
        self.index = take("<u8", -(-symbols // STEP)).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols)
        own, start, _ = _expansions(self.base, np.stack([left, right], axis=1))
        self.pool = np.concatenate([np.arange(self.base, dtype=np.uint32), own])
        self.starts = np.concatenate([np.arange(self.base), self.base + start])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return stretches(self.pool, self.starts[symbols], self.lengths[symbols])

    def all_ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, counted over the shard."""
        if stop <= start:
            return np.empty(0, np.uint32)
        block = int(np.searchsorted(self.index, start, "right")) - 1
        end = int(np.searchsorted(self.index, stop, "left"))
        got = self._expand(self.symbols[block * STEP : end * STEP])
        return got[start - self.index[block] : stop - self.index[block]]

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's k-th document."""
        return self._expand(self.symbols[self.symbol_starts[k] : self.symbol_starts[k + 1]])
