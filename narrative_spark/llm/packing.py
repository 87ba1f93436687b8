"""Operator 10: bounded-space online packing of documents into token windows.

Each task keeps a fixed number of open windows. A document goes whole into the open window it fits best;
where none has room, the fullest is topped up with the document's head and emitted, and the rest
looks for a place again. At a task's end its open windows are poured together, so that one unfilled
window at most is left; those leftovers are merged in groups of MERGE tasks, level by level. The last one is cut
at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm.common import materialize, tidy
from narrative_spark.llm.tokens import UnitTokenizer

CAPACITY, OPEN, MERGE, END_ID = 2048, 16, 64, 1
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_OPEN = _PIECE + ", task long, open boolean, ids binary"
_NAMES = [x.split()[0] for x in _OPEN.split(", ")]

Piece = tuple[object, int, np.ndarray, int]  # doc_id, start, ids, tokens of the document


class Windows:
    """The open windows of one task. closed takes a list of pieces for each window that is full."""

    def __init__(self, capacity: int, count: int):
        self.capacity, self.limit = capacity, count
        self.open: list[list[Piece]] = []
        self.room: list[int] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        doc_id, start, ids, total = piece
        while len(ids) > self.capacity:
            yield [(doc_id, start, ids[: self.capacity], total)]
            start, ids = start + self.capacity, ids[self.capacity :]
        fits = [(room, k) for k, room in enumerate(self.room) if room >= len(ids)]
        if fits:
            k = min(fits)[1]
        elif len(self.open) < self.limit:
            k = len(self.open)
            self.open.append([])
            self.room.append(self.capacity)
        else:
            room, k = min((room, k) for k, room in enumerate(self.room))
            self.open[k].append((doc_id, start, ids[:room], total))
            yield self.open[k]
            self.open[k], self.room[k] = [], self.capacity
            start, ids = start + room, ids[room:]
            k = min((room, k) for k, room in enumerate(self.room) if room >= len(ids))[1]
        self.open[k].append((doc_id, start, ids, total))
        self.room[k] -= len(ids)
        if not self.room[k]:
            yield self.open[k]
            del self.open[k], self.room[k]

    def pour(self) -> Iterator[list[Piece]]:
        """Pour the open windows together, the fullest first: full windows, then what is left over as the last."""
        now, room = [], self.capacity
        for k in sorted(range(len(self.open)), key=lambda k: self.room[k]):
            for doc_id, start, ids, total in self.open[k]:
                while len(ids) >= room:
                    yield [*now, (doc_id, start, ids[:room], total)]
                    start, ids, now, room = start + room, ids[room:], [], self.capacity
                if len(ids):
                    now, room = [*now, (doc_id, start, ids, total)], room - len(ids)
        self.open, self.room = [], []
        if now:
            yield now


def _rows(pieces: list[Piece], task: int, number: int, level: int, open_: bool) -> Iterator[tuple]:
    offset = 0
    for doc_id, start, ids, total in pieces:
        raw = ids.astype("<u4").tobytes()
        yield (doc_id, start, len(ids), zlib.crc32(raw), total, (level << 56) | (task << 28) | number, offset, task, open_, raw if open_ else None)
        offset += len(ids)


def _powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cut one window into windows of lengths that are powers of two."""
    left = sum(len(p[2]) for p in pieces)
    now, room = [], 1 << (left.bit_length() - 1)
    for doc_id, start, ids, total in pieces:
        while len(ids) >= room:
            yield [*now, (doc_id, start, ids[:room], total)]
            left -= sum(len(p[2]) for p in now) + room
            start, ids, now = start + room, ids[room:], []
            room = 1 << (left.bit_length() - 1) if left else CAPACITY
        if len(ids):
            now, room = [*now, (doc_id, start, ids, total)], room - len(ids)


def _packed(pieces: Iterable[Piece], task: int, level: int, capacity: int, windows: int, last: bool = False) -> Iterator[tuple]:
    space, number = Windows(capacity, windows), 0

    def full() -> Iterator[list[Piece]]:
        for piece in pieces:
            yield from space.add(piece)

    for made in full():
        yield from _rows(made, task, number, level, False)
        number += 1
    for made in space.pour():
        size = sum(len(p[2]) for p in made)
        if size == capacity:
            yield from _rows(made, task, number, level, False)
            number += 1
        elif last:
            for part in _powers(made):
                yield from _rows(part, task, number, level, False)
                number += 1
        else:
            yield from _rows(made, task, number, level, True)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, windows: int = OPEN, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of packed windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts have the end id alone; repeated rows are packed each for itself, under the same doc_id; null
    ids stay null; an empty table gives no pieces; other columns are not read. A text longer than a window
    fills windows of its own and its rest is placed as any other; of windows that fit alike the first opened is taken.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = UnitTokenizer.loaded(tokenizer), TaskContext.get().partitionId()

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                names = batch.column(0).to_pylist()
                for at, ids, off in coder.texts(batch.column(1)):
                    for k in range(len(off) - 1):
                        own = np.append(ids[off[k] : off[k + 1]], np.int32(end_id))
                        yield names[at + k], 0, own, len(own)

        held: list[tuple] = []
        for row in _packed(pieces(), task, 0, capacity, windows):
            held.append(row)
            if len(held) >= 20_000:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    made = materialize(docs.mapInArrow(tidy(first), _OPEN), "packed")
    out, level = made.where("not open"), 0
    left = made.where("open")
    most = left.agg(F.max("task")).first()[0]
    while most is not None:
        level, last = level + 1, most < MERGE

        merge = _merger(level, last, capacity, windows)
        made = materialize(left.groupBy(F.floor(F.col("task") / MERGE).alias("group")).applyInArrow(merge, _OPEN), "packed")
        out, left = out.unionByName(made.where("not open")), made.where("open")
        most = None if last else left.agg(F.max("task")).first()[0]
    return out.drop("task", "open", "ids")


def _merger(level: int, last: bool, capacity: int, windows: int):
    """Packs the leftovers of MERGE tasks or groups of the level below."""

    def merge(part: pa.Table) -> pa.Table:
        part = part.sort_by([("task", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        pieces = [(d, s, np.frombuffer(raw, "<u4"), n) for d, s, raw, n in zip(*[part[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")], strict=True)]
        return pa.Table.from_batches([_batch(list(_packed(pieces, part["task"][0].as_py() // MERGE, level, capacity, windows, last)))])

    return merge


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 8 + [pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)
