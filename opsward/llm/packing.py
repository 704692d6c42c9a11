"""Vector bin packing of token sequences by the dot-product heuristic.

A sequence has limits on tokens, on segments (pieces of examples) and on tokens that bear loss. Each task
packs the examples of its own partition, so nothing is shuffled: it keeps a bounded buffer of encoded
examples and fills one sequence after the other. Of the examples that fit what is left of all three
limits, the one whose demand has the largest dot product with what is left is placed; the dimensions are
weighted by their mean demand. If none fits and cutting is allowed, the best one is cut to fit. A sequence
that closes short of its token limit is divided into sequences whose lengths are powers of two, which need
no padding; without cutting it stays as it is.

Defined cases: null text is empty and has the end id alone; equal rows are separate examples; an example
over a limit is cut, or refused with an error where cutting is off; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .tokens import crc, encoder


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss: int = 4096


#: Examples that wait for a place; a full buffer is packed before more are encoded.
BUFFER_EXAMPLES = 1024
BUFFER_TOKENS = 2_000_000
#: Sequence ids: partition number above, running number below.
ID_BITS = 33
SCHEMA = "{id} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


class Packer:
    """Packs pieces (example, start, length, loss per token) into closed sequences."""

    def __init__(self, limits: Limits, cut: bool):
        self.limits, self.cut = np.array([limits.tokens, limits.segments, limits.loss]), cut
        self.items: list[tuple[object, int, int, int]] = []
        self.demand = np.empty((0, 3), np.int64)

    def add(self, example: object, length: int, bears_loss: bool) -> Iterator[list]:
        """Take an example; whole sequences that it fills by itself come back at once."""
        loss, start = int(bears_loss), 0
        full = int(min(self.limits[0], self.limits[2]) if loss else self.limits[0])
        if length > full and not self.cut:
            raise ValueError(f"an example of {length} tokens exceeds the limits; allow cutting")
        while length - start >= full and full == self.limits[0]:
            yield [(example, start, full, loss)]
            start += full
        while start < length:
            n = min(full, length - start)
            self.items.append((example, start, n, loss))
            start += n

    def fill(self, last: bool = False) -> Iterator[list]:
        """Place what waits; unless it is the last call, keep about one sequence's worth of examples back."""
        items = self.items
        demand = np.array([(n, 1, n * loss) for _, _, n, loss in items], np.int64).reshape(-1, 3)
        waits = np.ones(len(items), bool)
        weight = 1.0 / self.limits / np.maximum(demand.mean(axis=0) / self.limits, 1e-9) / self.limits if len(items) else None
        total = int(demand[:, 0].sum())
        while total and (last or total > 4 * self.limits[0]):
            left, pieces = self.limits.copy(), []
            while total and (left > 0)[:2].all():
                fits = waits & (demand <= left).all(axis=1)
                scored = fits if fits.any() else waits
                if not fits.any() and not (self.cut and pieces is not None):
                    break
                best = int(np.where(scored, demand @ (weight * left), -1.0).argmax())
                example, start, n, loss = items[best]
                take = n if fits[best] else int(min(left[0], left[2]) if loss else left[0])
                if take <= 0:
                    break
                pieces.append((example, start, take, loss))
                left -= (take, 1, take * loss)
                total -= take
                if take == n:
                    waits[best] = False
                else:
                    items[best] = (example, start + take, n - take, loss)
                    demand[best] = (n - take, 1, (n - take) * loss)
            yield from self._close(pieces)
        self.items = [x for x, w in zip(items, waits) if w]

    def _close(self, pieces: list) -> Iterator[list]:
        length = sum(p[2] for p in pieces)
        if not self.cut or length == self.limits[0]:
            yield pieces
            return
        while length:
            size, taken = 1 << (length.bit_length() - 1), []
            length -= size
            while size:
                example, start, n, loss = pieces[0]
                take = min(n, size)
                taken.append((example, start, take, loss))
                size -= take
                pieces = pieces[1:] if take == n else [(example, start + take, n - take, loss), *pieces[1:]]
            yield taken


def _pack(tokenizer: str, limits: Limits, cut: bool, id_name: str):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer = encoder(tokenizer).ids, Packer(limits, cut)
        sequence = TaskContext.get().partitionId() << ID_BITS
        rows: list[tuple] = []
        names = [id_name, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]

        def place(sequences: Iterator[list]) -> None:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for (key, ids), start, n, loss in pieces:
                    rows.append((key, start, n, crc(ids[start : start + n]), len(ids), sequence, offset, n * loss))
                    offset += n
                sequence += 1

        def out() -> Iterator[pd.DataFrame]:
            if rows:
                frame = pd.DataFrame(rows, columns=names)
                frame[id_name] = frame[id_name].astype("Int64")
                rows.clear()
                yield frame

        waiting = 0
        for frame in frames:
            for key, text, loss in zip(frame["key"], frame["text"], frame["loss"]):
                ids = encode(text)
                place(packer.add((None if pd.isna(key) else int(key), ids), len(ids), bool(loss)))
                waiting += len(ids)
                if len(packer.items) >= BUFFER_EXAMPLES or waiting >= BUFFER_TOKENS:
                    place(packer.fill())
                    waiting = sum(len(item[0][1]) for item in packer.items)
                    yield from out()
        place(packer.fill(last=True))
        yield from out()

    return pack


def pack(
    rows: DataFrame, tokenizer: str, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
    bears_loss: Column | None = None, cut: bool = True,
) -> DataFrame:
    """One row per piece: its example, place there, place in its sequence, and the crc32 of its ids.

    bears_loss: whether the tokens of an example (say, of an assistant's turn) count against the loss limit.
    """
    given = rows.select(
        F.col(id_col).cast("long").alias("key"), whole_text(text_col).alias("text"),
        F.coalesce(F.lit(True) if bears_loss is None else bears_loss, F.lit(False)).alias("loss"),
    )
    return given.mapInPandas(_pack(tokenizer, limits, cut, id_col), SCHEMA.format(id=id_col))
