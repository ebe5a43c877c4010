"""Sum-of-squares online packing of documents into fixed token windows.

Each scan task packs its own documents as they come (no shuffle). Full windows
are cut off the front of a document; the remainder, shorter than a window, is
one item. An item goes where it raises the sum over all fill levels of the
squared number of open windows at that level the least: into a new window, or
on top of an open one. The counts are a level array of one integer per token of
the window, so placing an item costs one pass over that array whatever the
number of windows. Windows that become full are written at once; a task holds
only its open windows.

At a task's end the windows still open are closed: pieces of the emptiest are
cut to fill up the fullest, so at most one window of a task keeps padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import text_or_empty
from marketpulse.llm.tokens import arrow_slices, encoder

WINDOW = 2048
END_ID = 1
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")


class Packer:
    """Level array and open windows of one task. A piece is ``(doc, start, ids, doc_tokens)``."""

    def __init__(self, window: int):
        self.window = window
        self.level = np.zeros(window + 1, np.int64)  # open windows by fill
        self.open: dict[int, list[list]] = {}

    def place(self, piece: tuple) -> list | None:
        """Put a piece of less than a window somewhere; returns the window if that fills it."""
        size = len(piece[2])
        cap = self.window
        # half the change of the sum of squares for fill h -> h + size, h = 0 .. cap - size
        change = self.level[size:cap + 1] - self.level[:cap + 1 - size] + 1.0
        change[0] = self.level[size] + 0.5
        change[-1] = 0.5 - self.level[cap - size]
        change[1:][self.level[1:cap + 1 - size] == 0] = np.inf
        # of equal changes the fullest window
        h = len(change) - 1 - int(np.argmin(change[::-1]))
        pieces = self.open[h].pop() if h else []
        if h:
            self.level[h] -= 1
        pieces.append(piece)
        if h + size == cap:
            return pieces
        self.level[h + size] += 1
        self.open.setdefault(h + size, []).append(pieces)
        return None

    def close(self) -> Iterator[list]:
        """The open windows, topped up by cutting pieces of the emptiest ones."""
        windows = [(h, w) for h in sorted(self.open) for w in self.open[h]]
        left: list = []
        low, high = 0, len(windows) - 1
        while low <= high:
            fill, pieces = windows[high]
            high -= 1
            while fill < self.window:
                if not left:
                    if low > high:
                        break
                    left = windows[low][1]
                    low += 1
                doc, start, ids, total = left.pop()
                room = self.window - fill
                if len(ids) > room:
                    left.append((doc, start + room, ids[room:], total))
                    ids = ids[:room]
                pieces.append((doc, start, ids, total))
                fill += len(ids)
            yield pieces
        while left:  # the rest of the last window taken apart
            part = []
            while left and sum(len(p[2]) for p in part) + len(left[-1][2]) <= self.window:
                part.append(left.pop())
            yield part
        self.open, self.level = {}, np.zeros(self.window + 1, np.int64)


def _pack_task(path: str, window: int, end_id: int):
    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])
        enc = encoder(path, "byte", "<|endoftext|>")
        packer = Packer(window)
        first = TaskContext.get().partitionId() << 40
        made = 0

        def rows(windows):
            nonlocal made
            out = []
            for pieces in windows:
                offset, filled = 0, sum(len(p[2]) for p in pieces)
                for doc, start, ids, total in pieces:
                    out.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, first + made, offset, filled))
                    offset += len(ids)
                made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for part in arrow_slices(batch):
                full = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist())):
                    ids = np.append(ids, np.uint32(end_id))
                    whole = len(ids) // window * window
                    for start in range(0, whole, window):
                        full.append([(doc, start, ids[start:start + window], len(ids))])
                    if whole < len(ids):
                        done = packer.place((doc, whole, ids[whole:].copy(), len(ids)))
                        if done:
                            full.append(done)
                if full:
                    yield rows(full)
        rest = list(packer.close())
        if rest:
            yield rows(rest)

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, sequence_tokens``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers; the
    pieces of a sequence, ordered by ``offset``, are its content. Null or empty
    text is a document of its end id alone. A null ``doc_id`` stays null, equal
    ids are separate documents, extra columns are ignored and an empty table
    gives no rows. A text is packed whole, however long.
    """
    if window < 2:
        raise ValueError("window must be at least 2")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(_pack_task(tokenizer, window, end_id), SCHEMA))
