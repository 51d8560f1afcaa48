"""Token ids of all documents, written as Re-Pair shards and read back.

Documents are range-partitioned and sorted by id; each task tokenizes its range in order
and packs whole documents into shards of about SHARD_IDS ids. Shards are rows of a Parquet
table (part, seq, n_docs, n_ids, data), so a lost executor repeats its range and the
commit stays atomic. ``repair`` has the layout of ``data``.

Texts with no character above U+00FF are cut by the tokenizer's pattern, many texts at a time,
and each distinct piece is encoded once per worker: for them its steps before (composing,
lower-casing) change each character on its own. Its vocabulary still does the merging.
Other texts, and texts that spell a special token, are encoded whole.

Defined cases: null and empty texts have the end id alone; a null id comes first; rows
with equal ids follow each other, ordered by their text's hash; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..session import shared_dir, ship_with_tasks
from .repair import Shard, pack, stretches

ship_with_tasks(__name__)

END = 1
SHARD_IDS = 1 << 20
CACHE_PIECES = 400_000
BATCH_CHARS, LEARN = 2 << 20, 1 << 14
# The tokenizer's own pattern for the letters, digits and signs up to U+00FF, in lower case:
# 's 't 're 've 'm 'll 'd, letters, a digit, or other signs.
LETTERS, DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
SPACE, LETTER, DIGIT, SIGN = range(4)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each character up to U+00FF its lower case, and for each of those its kind."""
    every = "".join(map(chr, range(256)))
    kinds = [(SPACE, r"\s"), (LETTER, f"[{LETTERS}]"), (DIGIT, f"[{DIGITS}]"), (SIGN, "")]
    kind = [next(k for k, pattern in kinds if re.match(pattern, c)) for c in every]
    return np.frombuffer(every.lower().encode("latin-1"), np.uint8), np.array(kind, np.uint8)


class Encoder:
    """A tokenizer file with a memory of pieces."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        # a task has one core; each further thread would keep memory of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = path
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(" ", "removed"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.merges.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.lower, self.kind = _tables()
        self.forget()

    @cached_property
    def whole(self):
        """The tokenizer as it is, for texts that are not cut; read when the first one comes."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def forget(self) -> None:
        self.pieces: dict[bytes, int] = {}
        self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int32)
        self.pool = np.empty(0, np.uint32)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces, LEARN at a time: what the library returns is far larger than the ids."""
        for k in range(0, len(pieces), LEARN):
            self._add(pieces[k : k + LEARN])

    def _add(self, pieces: list[bytes]) -> None:
        """Each piece's last token carries the end mark."""
        joined = [b" ".join(pieces[k : k + 1000]).decode("latin-1") for k in range(0, len(pieces), 1000)]
        got = self.merges.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in got])
        stop = np.flatnonzero(self.ends[ids]) + 1
        start = np.concatenate([[0], stop[:-1]])
        first = len(self.pieces)
        self.pieces.update(zip(pieces, range(first, first + len(pieces))))
        self.starts = np.concatenate([self.starts, (start + len(self.pool)).astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, (stop - start).astype(np.int32)])
        self.pool = np.concatenate([self.pool, ids])

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All pieces of the texts, and which of them is each text's first, and the end."""
        low = self.lower[np.frombuffer(" ".join([*texts, ""]).encode("latin-1"), np.uint8)]
        kind = self.kind[low]
        begins = kind != SPACE
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        # a sign that begins a piece and is an apostrophe takes certain letters along
        at = np.flatnonzero((low == ord("'")) & begins)
        one, two = low[at + 1], low[np.minimum(at + 2, len(low) - 1)]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e"))
        long |= (one == ord("l")) & (two == ord("l"))
        begins[at[short | long] + 1] = False
        after = np.concatenate([at[short] + 2, at[long] + 3])
        begins[after[kind[after] == LETTER]] = True
        inked = kind != SPACE
        data = low[inked]
        offsets = np.append(np.flatnonzero(begins[inked]), len(data)).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        edges = np.searchsorted(np.flatnonzero(begins), np.concatenate([[0], np.cumsum(sizes)]))
        return pieces, edges

    def _known(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that may be cut: each different piece is looked up once."""
        if len(self.pieces) > CACHE_PIECES:
            self.forget()
        pieces, edges = self._cut(texts)
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh = [p for p in names if p not in self.pieces]
        if fresh:
            self._learn(fresh)
        number = np.fromiter(map(self.pieces.__getitem__, names), np.int32, len(names))
        k = number[coded.indices.to_numpy()]
        size = self.lengths[k]
        ids = stretches(self.pool, self.starts[k], size)
        stops = np.concatenate([[0], np.cumsum(size)])[edges].tolist()
        return [ids[a:b] for a, b in zip(stops[:-1], stops[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        odd = [_odd(text) for text in texts]
        known = iter(self._known([text for text, no in zip(texts, odd) if not no]))
        return [
            np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32) if no else next(known)
            for text, no in zip(texts, odd)
        ]


def _odd(text: str) -> bool:
    """Whether a text cannot be cut at white space before it is encoded.

    It has a character above U+00FF, one that is white space to one side only, or may
    spell a special token.
    """
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return any(mark in text for mark in ODD)


def encoder(path: str) -> Encoder:
    """The worker's encoder: it outlives the task, as workers are used again."""
    place = sys.modules.setdefault("_worker_encoders", types.ModuleType("_worker_encoders"))
    if path not in place.__dict__:
        place.__dict__[path] = Encoder(path)
    return place.__dict__[path]


def _give_back() -> None:
    """Return memory that this worker holds but does not use, be it from earlier stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Document ids and texts, about BATCH_CHARS characters at a time, in order."""
    names, texts, chars = [], [], 0
    for batch in batches:
        for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            names.append(name)
            texts.append(text or "")
            chars += len(texts[-1])
            if chars >= BATCH_CHARS:
                yield names, texts
                names, texts, chars = [], [], 0
    if names:
        yield names, texts


def _packer(path: str, shard_ids: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()
        coder, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        names, ids, total = [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in ids], np.int64)
            data = pack(names, lengths, np.concatenate(ids), coder.size)
            columns = [[part], [seq], [len(names)], [total], [data]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                names=["part", "seq", "n_docs", "n_ids", "data"],
            )

        for some, texts in _gathered(batches):
            for name, got in zip(some, coder.encode(texts)):
                names.append(name)
                ids.append(np.append(got, np.uint32(END)))
                total += len(ids[-1])
                if total >= shard_ids:
                    yield shard()
                    names, ids, total, seq = [], [], 0, seq + 1
        if names:
            yield shard()
        _give_back()

    return shards


def write_shards(docs: DataFrame, tokenizer: str, path: str, shard_ids: int = SHARD_IDS) -> None:
    """Write the documents' ids to ``path`` in ascending order of doc_id."""
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )
    shards = ordered.mapInArrow(
        _packer(tokenizer, shard_ids), "part int, seq int, n_docs long, n_ids long, data binary"
    )
    shards.write.option("compression", "zstd").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # reading needs no tokenizer: what the worker keeps from writing goes first
    sys.modules.pop("_worker_encoders", None)
    _give_back()
    for batch in batches:
        for part, seq, data in zip(*(batch.column(c) for c in ("part", "seq", "data"))):
            shard = Shard(data.as_py())
            ids, edges = shard.all_ids().astype("<u4"), shard.id_starts
            bounds = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            n = len(bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.as_py()] * n, pa.int32()),
                    pa.array([seq.as_py()] * n, pa.int32()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(edges[:-1], pa.int64()),
                    pa.array(np.diff(edges), pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in bounds], pa.int64()),
                ],
                names=["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.parquet(path)
    counts = shards.select("part", "seq", "n_ids")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier(Window.orderBy("part"))), F.lit(0)).alias("ahead")
    )
    inside = F.sum("n_ids").over(earlier(Window.partitionBy("part").orderBy("seq")))
    begins = counts.join(parts, "part").select(
        "part", "seq", (F.col("ahead") + F.coalesce(inside, F.lit(0))).alias("begin")
    )
    docs = shards.select("part", "seq", "data").mapInArrow(
        _documents, "part int, seq int, doc_id long, within long, n_tokens long, ids_crc32 long"
    )
    return docs.join(broadcast_if_small(begins), ["part", "seq"]).select(
        "doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents below the shared folder and return what the files hold."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_shards(docs, tokenizer, path)
    return read_shards(docs.sparkSession, path)
