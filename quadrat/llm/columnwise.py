"""Repeated passages by column-wise suffix sorting of many texts at once.

Every byte that lies in a string of ``length`` bytes which starts at a second place of the
collection, in the same text or another, is found, byte-exactly.

1. A text is cut into pieces: the strings of ``length`` bytes that start one after another
   and hold the same anchor (the least hash of any K bytes within) make a piece. Equal strings
   have equal anchors, so pieces of different anchors need no comparison.
2. Equal pieces are one class with a count, made map-side. Classes whose anchor occurs once
   in the collection hold nothing that repeats; a class that alone holds its anchor, once,
   repeats as a whole. All classes that share an anchor, or hold it twice, are sorted.
3. Collections of such pieces are sorted column by column, from the last to the first: each
   round inserts one symbol per piece into the collection's Burrows-Wheeler transform, kept
   as one sequential file of positions per symbol, and the common prefixes of neighbouring
   suffixes into another sequential file. Files are read from start to end, and the next one
   is written; the transform's take the insertions of a few rounds at once. A new suffix's
   place follows from the rank of its symbol, its common prefix is one more than the least
   between the symbol's neighbouring occurrences.
4. Suffixes that share ``length`` symbols with a neighbour repeat. Following the transform
   from the whole pieces on gives every start its place; the starts go back to the texts.

Files stay in a worker's memory up to SPOOL bytes and lie in the shared folder beyond that.
A collection is cut between anchors at COLLECTION bytes. An anchor with more than GROUP
bytes of different pieces is not sorted by one task: its strings are counted one by one,
by 128-bit hash, which finds the same starts.

Defined cases: a null or short text has no such string and stays whole; equal rows are copies
of each other; cuts are in bytes, so what is left may split a character; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_dir, ship_with_tasks

ship_with_tasks(__name__)

LENGTH = 400
ANCHOR = 192  # bytes of an anchor, at most about half of the length
COLLECTION, GROUP, PARTITION = 6 << 20, 8 << 20, 64 << 20
SPOOL, CHUNK = 64 << 20, 1 << 20  # bytes of a file kept in memory, items read at once

_RANDOM = np.random.default_rng(20130613)
_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)


# --- pieces -----------------------------------------------------------------------


def anchor_size(length: int) -> int:
    return max(1, min(ANCHOR, length // 2))


def _powers(count: int, base: int) -> np.ndarray:
    steps = np.full(count + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def least_hashes(
    data: np.ndarray, length: int, powers: np.ndarray, inverse: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each K bytes, and for each start the least one within ``length`` bytes."""
    k = anchor_size(length)
    n = len(data)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * powers[:n])])
    hashes = (sums[k:] - sums[:-k]) * inverse[: n - k + 1]
    hashes = (hashes ^ (hashes >> np.uint64(29))) * _MULTIPLY
    hashes ^= hashes >> np.uint64(32)
    low, width, have = hashes, length - k + 1, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return hashes, low


def runs_of(low: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """First start and number of starts of each piece."""
    cuts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    sizes = np.diff(np.append(cuts, len(low)))
    if sizes.max() > longest:
        cuts = np.concatenate([np.arange(c, c + s, longest) for c, s in zip(cuts, sizes)])
        sizes = np.diff(np.append(cuts, len(low)))
    return cuts, sizes


def _pieces(length: int):
    """(digest, bytes) -> (digest, starts, runs, anchors, owns, pieces) of each text.

    ``owns`` counts how often a piece holds its anchor: a piece may repeat within itself.
    """
    longest = length - anchor_size(length) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = inverse = _powers(0, 1)
        for batch in batches:
            starts, runs, anchors, owns, pieces = [], [], [], [], []
            for text in batch.column("bytes"):
                text = text.as_py()
                if len(text) > len(powers):
                    powers = _powers(2 * len(text), _STEP)
                    inverse = _powers(2 * len(text), pow(_STEP, -1, 1 << 64))
                hashes, low = least_hashes(np.frombuffer(text, np.uint8), length, powers, inverse)
                first, size = runs_of(low, longest)
                starts.append(first.astype(np.int32))
                runs.append(size.astype(np.int32))
                anchors.append(low[first].view(np.int64))
                edges = list(zip(first.tolist(), (first + size).tolist()))
                owns.append(
                    [np.count_nonzero(hashes[a : b + longest - 1] == low[a]) for a, b in edges]
                )
                pieces.append([xxhash.xxh3_128_digest(text[a : b + length - 1]) for a, b in edges])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            lists = (starts, runs, anchors, owns, pieces)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), *(pa.array(c, pa.list_(k)) for c, k in zip(lists, kinds))],
                names=["digest", *LISTS],
            )

    return cut


LISTS = ["starts", "runs", "anchors", "owns", "pieces"]
PIECES = (
    "digest binary, starts array<int>, runs array<int>, anchors array<long>, "
    "owns array<int>, pieces array<binary>"
)


# --- the collection's transform and common prefixes -------------------------------


class Tape:
    """A sequential file of numbers: written from start to end, then read in chunks."""

    def __init__(self, folder: str, kind) -> None:
        self.folder, self.kind = folder, np.dtype(kind)
        self.parts: list[np.ndarray] = []
        self.held = self.items = 0
        self.path = self.out = self.files = None

    def write(self, numbers: np.ndarray) -> None:
        numbers = numbers.astype(self.kind, copy=False)
        self.items += len(numbers)
        self.parts.append(numbers)
        self.held += numbers.nbytes
        if self.held > SPOOL or self.out:
            if not self.out:
                self.files, base = pafs.FileSystem.from_uri(self.folder)
                self.files.create_dir(base)
                self.path = f"{base}/{uuid.uuid4().hex}"
                self.out = self.files.open_output_stream(self.path)
            for part in self.parts:
                self.out.write(part.tobytes())
            self.parts, self.held = [], 0

    def chunks(self) -> Iterator[tuple[np.ndarray, bool]]:
        """The numbers in order, and whether the chunk is the last one (there is always one)."""
        if not self.out:
            if len(self.parts) != 1:
                self.parts = [np.concatenate([np.empty(0, self.kind), *self.parts])]
            yield self.parts[0], True
            return
        if not self.out.closed:
            self.out.close()
        left = self.items
        with self.files.open_input_stream(self.path) as source:
            while left:
                chunk = np.frombuffer(source.read(min(left, CHUNK) * self.kind.itemsize), self.kind)
                left -= len(chunk)
                yield chunk, not left

    def all(self) -> np.ndarray:
        return np.concatenate([chunk for chunk, _ in self.chunks()])

    def drop(self) -> None:
        self.parts = []
        if self.out:
            self.out.close()
            self.files.delete_file(self.path)


def _woven(old: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    """A copy of ``old`` with the ``new`` items at the places ``at`` of the result."""
    if not len(at):
        return old.copy()
    out = np.empty(len(old) + len(at), old.dtype)
    stays = np.ones(len(out), bool)
    stays[at] = False
    out[stays] = old
    out[at] = new
    return out


def _prefixes(tape: Tape, places: np.ndarray, own: np.ndarray, after: np.ndarray) -> Tape:
    """The next file of common prefixes: ``own`` at ``places``, ``after`` right behind them.

    ``after`` below 0 leaves the suffix behind as it is.
    """
    out = Tape(tape.folder, tape.kind)
    slots = places - np.arange(len(places))
    done, base, behind = 0, 0, -1
    for chunk, last in tape.chunks():
        upto = len(places) if last else int(np.searchsorted(slots, base - done + len(chunk)))
        woven = _woven(chunk, places[done:upto] - base, own[done:upto])
        if behind >= 0:
            woven[0] = behind
        behind = -1
        where, value = places[done:upto] - base + 1, after[done:upto]
        if len(where) and where[-1] == len(woven):
            where, value, behind = where[:-1], value[:-1], int(value[-1])
        known = value >= 0
        woven[where[known]] = value[known]
        out.write(woven)
        base += len(woven)
        done = upto
    return out


def _merged(tape: Tape, shift: np.ndarray, new: np.ndarray) -> Tape:
    """The next file of a symbol's positions: the old ones moved by ``shift``, new ones between."""
    out = Tape(tape.folder, tape.kind)
    done = 0
    for chunk, last in tape.chunks():
        moved = chunk + shift.take(chunk)
        upto = len(new) if last else int(np.searchsorted(new, moved[-1]))
        fresh = new[done:upto]
        out.write(_woven(moved, np.searchsorted(moved, fresh) + np.arange(len(fresh)), fresh))
        done = upto
    tape.drop()
    return out


def _neighbours(tape: Tape, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many of a symbol's positions lie before each of ``at``, the last of those, and the next.

    -1 stands for none.
    """
    rank, before, after = np.zeros(len(at), np.int64), np.full(len(at), -1), np.full(len(at), -1)
    for chunk, _ in tape.chunks():
        if not len(chunk):
            continue
        below = np.searchsorted(chunk, at)
        rank += below
        before = np.where(below > 0, chunk[below - 1], before)
        next_one = chunk[np.minimum(below, len(chunk) - 1)]
        after = np.where((after < 0) & (below < len(chunk)), next_one, after)
    return rank, before, after


def _range_minima(tape: Tape, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least item of the file between each pair of places, both included."""
    points = np.sort(np.concatenate([first, last + 1]))
    points = points[np.diff(points, prepend=-1) > 0]
    least = np.full(len(points), np.iinfo(tape.kind).max, tape.kind)
    base = 0
    for chunk, _ in tape.chunks():
        a, b = np.searchsorted(points, (base, base + len(chunk)))
        inner = points[a:b] - base
        if a and not (len(inner) and inner[0] == 0):
            inner, a = np.concatenate([[0], inner]), a - 1
        if len(inner):
            least[a:b] = np.minimum(least[a:b], np.minimum.reduceat(chunk, inner))
        base += len(chunk)
    # minima of 1, 2, 4 ... neighbouring stretches answer any range by two look-ups
    levels = [least]
    while 2 ** len(levels) <= len(points):
        step = 2 ** (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    a, b = np.searchsorted(points, first), np.searchsorted(points, last + 1)
    level = np.frexp(b - a)[1] - 1
    out = np.empty(len(first), tape.kind)
    for k in np.unique(level):
        here = level == k
        table = levels[k]
        out[here] = np.minimum(table[a[here]], table[b[here] - 2**k])
    return out


class Transform:
    """The symbol before each suffix, as a growing set of (symbol, position in the order).

    Each symbol has a sequential file of its positions. The insertions of some rounds wait in
    ``place`` and ``symbol``, in the order of the suffixes, and are then merged into all the
    files at once; positions in the files count without the waiting ones.
    """

    def __init__(self, symbols: int, folder: str) -> None:
        self.tapes = [Tape(folder, np.int32) for _ in range(symbols)]
        self.place, self.symbol = np.empty(0, np.int64), np.empty(0, np.uint8)
        self.items = 0

    def insert(self, place: np.ndarray, symbol: np.ndarray):
        """Insert suffixes at ``place`` (of the order with them), preceded by ``symbol``.

        -> for each one how many equal symbols stand before it, the place of the last of them
        and of the next one (-1: none), and how many there are of each symbol.
        """
        slots = place - np.arange(len(place))
        moved = self.place + np.searchsorted(slots, self.place, "right")
        at = np.searchsorted(moved, place) + np.arange(len(place))
        self.place = _woven(moved, at, place)
        self.symbol = _woven(self.symbol, at, symbol)
        waiting = len(self.place)
        # among the waiting ones
        order = np.argsort(self.symbol, kind="stable")
        rank = np.empty(waiting, np.int64)
        rank[order] = np.arange(waiting)
        counts = np.bincount(self.symbol, minlength=len(self.tapes))
        ends = np.cumsum(counts)
        mine = rank[at]
        first, last = (ends - counts)[symbol], ends[symbol] - 1
        before = np.where(mine > first, self.place[order[mine - 1]], -1)
        after = np.where(mine < last, self.place[order[np.minimum(mine + 1, waiting - 1)]], -1)
        rank = mine - first
        # among those in the files
        slot = self.place - np.arange(waiting)
        asked = place - at
        by_symbol = np.argsort(symbol, kind="stable")
        edges = np.searchsorted(symbol[by_symbol], np.arange(len(self.tapes) + 1))
        for s in np.flatnonzero(np.diff(edges)):
            some = by_symbol[edges[s] : edges[s + 1]]
            if not self.tapes[s].items:
                continue
            below, left, right = _neighbours(self.tapes[s], asked[some])
            rank[some] += below
            left = np.where(left >= 0, left + np.searchsorted(slot, left, "right"), -1)
            right = np.where(right >= 0, right + np.searchsorted(slot, right, "right"), -1)
            before[some] = np.maximum(before[some], left)
            both = (after[some] >= 0) & (right >= 0)
            after[some] = np.where(both, np.minimum(after[some], right), np.maximum(after[some], right))
        self.items += len(place)
        return rank, before, after, counts + [t.items for t in self.tapes]

    def merge(self, more: np.ndarray | None = None) -> None:
        """Write the next files; ``more`` are places of suffixes without a symbol before them."""
        slot = self.place - np.arange(len(self.place))
        gaps = np.diff(np.concatenate([[0], slot, [self.items - len(slot)]]))
        shift = np.repeat(np.arange(len(slot) + 1, dtype=np.int32), gaps)
        for s, tape in enumerate(self.tapes):
            self.tapes[s] = _merged(tape, shift, self.place[self.symbol == s].astype(np.int32))
        self.place, self.symbol = self.place[:0], self.symbol[:0]
        if more is not None:
            slot = more - np.arange(len(more))
            gaps = np.diff(np.concatenate([[0], slot, [self.items]]))
            shift = np.repeat(np.arange(len(more) + 1, dtype=np.int32), gaps)
            self.tapes = [_merged(tape, shift, np.empty(0, np.int32)) for tape in self.tapes]

    def waits_too_long(self) -> bool:
        """Whether the waiting insertions cost a round about as much as their share of a merge."""
        return len(self.place) ** 2 * 4 > self.items * self.latest

    latest = 1


def suffix_places(texts: list[bytes], folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort all suffixes of the texts, which are given longest first.

    -> (common prefix of each suffix with the one before it, place of each text as a whole,
    place of the suffix one symbol shorter, for the suffixes behind the empty ones).
    """
    widest, total = len(texts[0]), len(texts)
    sizes = np.array([len(t) for t in texts])
    columns = np.frombuffer(b"".join(t.ljust(widest, b"\0") for t in texts), np.uint8)
    symbols = np.unique(np.frombuffer(b"".join(texts), np.uint8))
    code = np.zeros(256, np.uint8)
    code[symbols] = np.arange(len(symbols))
    columns = np.ascontiguousarray(code[columns].reshape(total, widest).T)
    transform = Transform(len(symbols), folder)
    prefixes = Tape(folder, np.int16 if widest < 32_000 else np.int32)
    entered = 0
    # of the texts under way: their current suffix's place, common prefix, and that behind it
    who, place, own, after = (np.empty(0, np.int64) for _ in range(4))
    for j in range(widest - 1, -2, -1):
        fresh = np.arange(entered, int(np.searchsorted(-sizes, -j)) if j >= 0 else entered)
        # empty suffixes come first, in the order of the texts
        who = np.concatenate([fresh, who])
        place = np.concatenate([fresh, place])
        own = np.concatenate([np.zeros(len(fresh), np.int64), own])
        after = np.concatenate([np.full(len(fresh), -1), after])
        entered += len(fresh)
        grown = _prefixes(prefixes, place, own, after)
        prefixes.drop()
        prefixes = grown
        if j < 0:
            transform.merge(place)
            break
        column = columns[j, who]
        rank, before, behind, counts = transform.insert(place, column)
        transform.latest = len(place)
        if transform.waits_too_long():
            transform.merge()
        led, followed = before >= 0, behind >= 0
        minima = _range_minima(
            prefixes,
            np.concatenate([before[led] + 1, place[followed] + 1]),
            np.concatenate([place[led], behind[followed]]),
        ).astype(np.int64)
        own, after = np.zeros(len(who), np.int64), np.full(len(who), -1)
        own[led], after[followed] = minima[: led.sum()] + 1, minima[led.sum() :] + 1
        # texts that end one column further left enter next and push all others behind
        coming = int(np.searchsorted(-sizes, 1 - j)) - entered if j else 0
        place = entered + coming + (np.cumsum(counts) - counts)[column] + rank
        order = np.argsort(place)
        who, place, own, after = who[order], place[order], own[order], after[order]
    whole = np.empty(total, np.int64)
    whole[who] = place
    common = prefixes.all()
    prefixes.drop()
    shorter, done = np.empty(transform.items, np.int32), 0
    for tape in transform.tapes:
        for chunk, _ in tape.chunks():
            shorter[done : done + len(chunk)] = chunk
            done += len(chunk)
        tape.drop()
    return common, whole, shorter


def repeated_starts(texts: list[bytes], copies: list[int], length: int, folder: str) -> list[list[tuple[int, int]]]:
    """For each text the ranges (first, last) of starts whose ``length`` bytes start elsewhere too.

    A text stands for so many ``copies``.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    common, place, shorter = suffix_places([texts[i] for i in order], folder)
    weight = np.array([min(copies[i], 2) for i in order], np.int32)
    starts = np.array([len(texts[i]) - length + 1 for i in order])
    group = np.cumsum(common < length, dtype=np.int32)
    del common
    groups = np.full((int(starts[0]), len(order)), -1, np.int32)
    total = np.zeros(int(group[-1]) + 1, np.int32)
    for s in range(len(groups)):
        # longer texts come first, and have more starts
        here = int(np.searchsorted(-starts, -s, "left"))
        groups[s, :here] = group[place[:here]]
        np.add.at(total, groups[s, :here], weight[:here])
        place = shorter[place[:here] - len(order)]
    again = (groups >= 0) & (total >= 2)[groups]
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for k, i in enumerate(order):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], again[:, k], [0]])))
        out[i] = [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]
    return out


def _sorted_collections(length: int, folder: str):
    """(anchor, piece, copies, bytes) by anchor -> (piece, ranges of repeated starts)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, bytes]] = []
        size, at = 0, None

        def done() -> pa.RecordBatch:
            found = repeated_starts([h[2] for h in held], [h[1] for h in held], length, folder)
            rows = [
                (h[0], [{"first": a, "last": b} for a, b in ranges]) for h, ranges in zip(held, found) if ranges
            ]
            return _ranges(rows)

        for batch in batches:
            for anchor, *row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "piece", "copies", "bytes"))):
                if anchor != at and size >= COLLECTION:
                    yield done()
                    held, size = [], 0
                at = anchor
                held.append(tuple(row))
                size += len(row[2])
        if held:
            yield done()

    return build


RANGES = "piece binary, ranges array<struct<first:int,last:int>>"


def _ranges(rows: list[tuple[bytes, list[dict]]]) -> pa.RecordBatch:
    inner = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], inner)],
        names=["piece", "ranges"],
    )


# --- the jobs ---------------------------------------------------------------------


def _extracted(length: int):
    """(bytes, wanted) -> (anchor, piece, copies, bytes) of the wanted pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column("bytes"), batch.column("wanted")):
                text = text.as_py()
                for w in wanted.as_py():
                    end = w["start"] + w["run"] + length - 1
                    rows.append((w["anchor"], w["piece"], w["copies"], text[w["start"] : end]))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "piece", "copies", "bytes"])

    return cut


def _strings(length: int):
    """(piece, copies, bytes) -> one row per start: (piece, at, copies, string)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, copies, text in zip(*(batch.column(c).to_pylist() for c in ("piece", "copies", "bytes"))):
                n = len(text) - length + 1
                digests = [xxhash.xxh3_128_digest(text[s : s + length]) for s in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece] * n, pa.binary()),
                        pa.array(range(n), pa.int32()),
                        pa.array([copies] * n, pa.int64()),
                        pa.array(digests, pa.binary()),
                    ],
                    names=["piece", "at", "copies", "string"],
                )

    return cut


def _counted_strings(pieces: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated starts for groups too large to be sorted in one task."""
    rows = cut_lineage(
        pieces.select("piece", "copies", "bytes").mapInArrow(
            _strings(length), "piece binary, at int, copies long, string binary"
        )
    )
    again = rows.groupBy("string").agg(F.sum("copies").alias("n")).where("n > 1").select("string")
    hits = rows.join(cut_lineage(again).hint("merge"), "string")
    one = F.struct(F.col("at").alias("first"), F.col("at").alias("last"))
    return hits.groupBy("piece").agg(F.collect_list(one).alias("ranges"))


def _cut_out(length: int):
    """(digest, bytes, ranges) -> (digest, spans, kept): the text without its repeats."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for text, ranges in zip(batch.column("bytes"), batch.column("ranges")):
                text, merged = text.as_py(), []
                for r in sorted((r["first"], r["last"]) for r in ranges.as_py()):
                    if merged and r[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r[1] + length)
                    else:
                        merged.append([r[0], r[1] + length])
                edges = [0, *(e for m in merged for e in m), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "end": b} for a, b in merged])
            inner = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(spans, inner), pa.array(kept, pa.binary())],
                names=["digest", "spans", "kept"],
            )

    return cut


def _bytes_of(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", data.alias("bytes"), F.unhex(F.sha2(data, 256)).alias("digest"))


def _distinct(texts: DataFrame) -> DataFrame:
    """One row per text; copies are folded map-side."""
    return texts.groupBy("digest").agg(F.first("bytes").alias("bytes"))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(digest, spans, kept) of the distinct texts that hold a repeat.

    ``digest`` is the text's SHA-256, ``spans`` are its maximal repeated stretches (start,
    end) in bytes, ``kept`` is what is left of it.
    """
    spark = docs.sparkSession
    long = _bytes_of(docs).where(F.octet_length("bytes") >= length).select("digest", "bytes")
    cut = long.mapInArrow(_pieces(length), PIECES)
    texts = cut_lineage(
        cut.groupBy("digest").agg(*[F.first(c).alias(c) for c in LISTS], F.count(F.lit(1)).alias("n"))
    )
    anchors = texts.select("n", F.explode(F.arrays_zip("anchors", "owns")).alias("p"))
    often = F.sum(F.col("n") * F.col("p.owns"))
    again = anchors.groupBy(F.col("p.anchors").alias("anchor")).agg(often.alias("m"))
    again = cut_lineage(again.where("m > 1").select("anchor"))
    all_places = texts.select("digest", "n", F.explode(F.arrays_zip(*LISTS)).alias("p")).select(
        "digest",
        "n",
        *[F.col(f"p.{c}").alias(c.removesuffix("s")) for c in LISTS],
    )
    # these tables grow with the corpus: they are joined the same way at every size
    places = cut_lineage(all_places.join(again.hint("merge"), "anchor"))
    classes = cut_lineage(
        places.groupBy("anchor", "piece").agg(
            F.sum("n").alias("copies"),
            F.first("run").alias("run"),
            F.first("own").alias("own"),
            F.min(F.struct("digest", "start")).alias("at"),
        )
    )
    # an anchor with different pieces, or one piece that may repeat within itself
    groups = classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.max("own").alias("own"),
        F.sum(F.col("run") + F.lit(length - 1)).alias("size"),
    )
    groups = cut_lineage(groups.where("kinds > 1 OR own > 1").select("anchor", "size"))
    shared = classes.join(groups.hint("merge"), "anchor")
    alone = classes.join(groups.hint("merge"), "anchor", "left_anti")
    everywhere = F.array(F.struct(F.lit(0).alias("first"), (F.col("run") - 1).alias("last")))
    found = alone.select("piece", everywhere.alias("ranges"))

    wanted = places.select("digest").distinct()
    held = cut_lineage(_distinct(long).join(wanted.hint("merge"), "digest", "left_semi"))

    asked = F.struct(F.col("at.start").alias("start"), "run", "anchor", "piece", "copies", "size")
    asked = shared.groupBy(F.col("at.digest").alias("digest")).agg(F.collect_list(asked).alias("wanted"))
    asked = cut_lineage(asked)
    for large in (False, True):
        limit = F.lit(GROUP)
        part = F.filter("wanted", lambda w: (w["size"] > limit) if large else (w["size"] <= limit))
        some = asked.select("digest", part.alias("wanted")).where(F.size("wanted") > 0)
        if large and some.isEmpty():
            continue
        pieces = held.join(some.hint("merge"), "digest").select("bytes", "wanted")
        pieces = pieces.mapInArrow(_extracted(length), "anchor long, piece binary, copies long, bytes binary")
        if large:
            found = found.union(_counted_strings(pieces, length))
            continue
        total = groups.where(F.col("size") <= GROUP).agg(F.sum("size")).first()[0] or 0
        few = int(spark.conf.get("spark.sql.shuffle.partitions"))
        count = max(1, math.ceil(total / PARTITION), min(few, math.ceil(total / COLLECTION)))
        dealt = pieces.repartition(count, "anchor").sortWithinPartitions("anchor")
        found = found.union(
            cut_lineage(dealt.mapInArrow(_sorted_collections(length, shared_dir(spark, "columns")), RANGES))
        )

    moved = F.transform(
        "ranges", lambda r: F.struct((r["first"] + F.col("start")).alias("first"), (r["last"] + F.col("start")).alias("last"))
    )
    ranges = places.join(found.hint("merge"), "piece").select("digest", F.explode(moved).alias("r"))
    ranges = cut_lineage(ranges.groupBy("digest").agg(F.collect_list("r").alias("ranges")))
    return cut_lineage(
        held.join(ranges.hint("merge"), "digest").mapInArrow(
            _cut_out(length), "digest binary, spans array<struct<start:int,end:int>>, kept binary"
        )
    )


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (empty without a repeat), kept_sha256."""
    left = repeats(docs, length).select(
        F.col("digest").alias("_digest"), "spans", F.sha2("kept", 256).alias("_sha")
    )
    rows = _bytes_of(docs).select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), "digest")
    joined = rows.join(left.hint("merge"), F.col("digest") == F.col("_digest"), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("_sha", F.lower(F.hex("digest"))).alias("kept_sha256"),
    )


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` and ``kept`` (binary, in place of a column of that name): the text without repeats."""
    left = repeats(docs, length).select(F.col("digest").alias("_digest"), F.col("kept").alias("_kept"))
    data = F.coalesce(F.col("_doc.text"), F.lit("")).cast("binary")
    whole = docs.select(F.struct("*").alias("_doc"))
    joined = whole.join(left.hint("merge"), F.unhex(F.sha2(data, 256)) == F.col("_digest"), "left")
    others = [F.col(f"_doc.`{c}`") for c in docs.columns if c != "kept"]
    return joined.select(*others, F.coalesce("_kept", data).alias("kept"))
