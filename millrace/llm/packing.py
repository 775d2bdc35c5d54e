"""Hierarchical multi-length packing of tokenized documents.

Documents are cut into full windows of the longest context; what is left of each
is routed to the smallest context that holds it.  Windows of the longest context
are then filled from the shorter tiers, best fit first, and the last gap is
closed by cutting a piece; what the long windows leave over is packed the same
way into its own, shorter context, which as a power of two needs no padding.
Each task packs its own documents and carries less than one window from batch to
batch, so at most one window per task is padded.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from millrace.llm.common import give_back, smaller_batches, texts_of

CONTEXTS = (1024, 512, 256, 128)
END = 0
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary as byte_bpe_50k.json
TOKENIZER = "byte_bpe_50k.json"
SPECIAL = {"<|endoftext|>": 50256}
LONG_SPACE = 100_000  # characters of a white-space run from which the tokenizer file is used
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")
STEP_TOKENS = 1 << 16

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, context int, step_group long"
)


@functools.cache
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


@functools.cache
def whole_tokenizer(name: str = TOKENIZER) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def tokens(text: str, path: str) -> np.ndarray:
    """Ids of the text and the id that ends it.

    The rank file's pattern runs out of stack on very long white space; a text with
    such a run goes through the tokenizer file itself, which gives the same ids.
    """
    if len(text) > LONG_SPACE and _LONG_SPACE.search(text):
        ids = np.array(whole_tokenizer().encode(text, add_special_tokens=False).ids, np.uint32)
    else:
        ids = encoder(path).encode_to_numpy(text, allowed_special="all")
    return np.append(ids, END).astype("<u4")


class Piece:
    """A run of ids of one document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start, ids, total):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, size: int) -> tuple["Piece", "Piece"]:
        head = Piece(self.doc, self.start, self.ids[:size], self.total)
        return head, Piece(self.doc, self.start + size, self.ids[size:], self.total)


class Pool:
    """Waiting pieces by length, the longest last."""

    def __init__(self, pieces=()):
        self.pieces = sorted(pieces, key=lambda p: len(p.ids))
        self.lengths = [len(p.ids) for p in self.pieces]

    def __len__(self):
        return len(self.pieces)

    def add(self, piece: Piece) -> None:
        at = bisect_right(self.lengths, len(piece.ids))
        self.pieces.insert(at, piece)
        self.lengths.insert(at, len(piece.ids))

    def fitting(self, gap: int) -> Piece | None:
        """The longest piece that fits into the gap."""
        at = bisect_right(self.lengths, gap)
        return self._pop(at - 1) if at else None

    def longest(self) -> Piece:
        return self._pop(-1)

    def _pop(self, at: int) -> Piece:
        self.lengths.pop(at)
        return self.pieces.pop(at)


def fill(window: list[Piece], gap: int, pools: list[Pool]) -> int:
    """Fill the gap from the pools, longer tiers first, and cut a piece to close it; the gap that stays."""
    for pool in pools:
        while gap and (piece := pool.fitting(gap)):
            window.append(piece)
            gap -= len(piece.ids)
    for pool in reversed(pools):
        if gap and len(pool):
            head, rest = pool.longest().cut(gap)
            window.append(head)
            pool.add(rest)
            gap = 0
    return gap


def pack(pieces: list[Piece], contexts: tuple[int, ...] = CONTEXTS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows as (context, pieces), and pieces of less than one longest window in all."""
    full, tails = [], {c: [] for c in contexts}
    for piece in pieces:
        while len(piece.ids) >= contexts[0]:
            head, piece = piece.cut(contexts[0])
            full.append((contexts[0], [head]))
        if len(piece.ids):
            tails[min(c for c in contexts if c >= len(piece.ids))].append(piece)
    pools = [Pool(tails[c]) for c in contexts]
    for k, context in enumerate(contexts):
        while len(pools[k]):
            window = [pools[k].longest()]
            if fill(window, context - len(window[0].ids), pools[k + 1 :]) == 0:
                full.append((context, window))
                continue
            # nothing shorter waits: close the window from its own tier
            gap = context - sum(len(p.ids) for p in window)
            while gap and len(pools[k]):
                piece = pools[k].longest()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    pools[k].add(rest)
                window.append(piece)
                gap -= len(piece.ids)
            if gap:
                return full, window
            full.append((context, window))
    return full, []


def step_groups(lengths: list[int], size: int = STEP_TOKENS) -> list[int]:
    """A group per window, of about `size` tokens each and with like shares of every length."""
    groups = max(1, round(sum(lengths) / size))
    dealt = [0] * len(lengths)
    for turn, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        lap, place = divmod(turn, groups)
        dealt[i] = place if lap % 2 == 0 else groups - 1 - place
    return dealt


def _packer(path: str, contexts: tuple[int, ...], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        made = steps = 0
        left: list[Piece] = []

        def rows(windows):
            nonlocal made, steps
            lengths = [sum(len(p.ids) for p in w) for _, w in windows]
            groups = step_groups(lengths)
            columns = [[] for _ in range(9 + with_ids)]
            for (context, window), group in zip(windows, groups):
                offset = 0
                for p in window:
                    values = (p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total, base + made, offset, context, base + steps + group)
                    for column, value in zip(columns, (*values, p.ids) if with_ids else values):
                        column.append(value)
                    offset += len(p.ids)
                made += 1
            steps += max(groups, default=-1) + 1
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            arrays += [pa.array(columns[7], pa.int32()), pa.array(columns[8], pa.int64())]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            if with_ids:
                arrays.append(pa.array(columns[9], pa.list_(pa.uint32())).cast(pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            fresh = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                ids = tokens(text, path)
                fresh.append(Piece(doc, 0, ids, len(ids)))
            windows, left = pack(left + fresh, contexts)
            if windows:
                yield rows(windows)
        if left:
            yield rows([(contexts[0], left)])
        give_back()

    return run


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    contexts: tuple[int, ...] = CONTEXTS,
    ranks: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it was cut, where it lies, its window's context and step group, and its `ids`.

    A window is padded to its `context`; only the last one of a task is shorter
    than that.  A null or empty text is its end id alone.  Rows are packed one by
    one, so repeated rows and null ids give pieces of their own.  `ranks` names
    the vocabulary file on every executor.  Other columns are not read.
    """
    smaller_batches(docs.sparkSession)
    path = ranks or public_tokenizers.path(RANKS)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(_packer(path, contexts, with_ids), SCHEMA + (", ids array<int>" if with_ids else ""))
