"""Packing of tokenised documents into training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col
from phenoloom.llm.tokenizing import encoder


class Bin:
    """A sequence being filled: what is left of each limit, and its pieces."""

    __slots__ = ("left", "pieces")

    def __init__(self, limits: np.ndarray):
        self.left = limits.copy()
        self.pieces = []


class Packer:
    """Vector bin packing with three limits: tokens, segments, loss-bearing tokens.

    Whole sequences are cut off long documents. What remains of a document goes
    to the open sequence whose free room has the largest dot product with its
    demand, both as shares of the limits. If none has room for it whole, it
    opens a sequence; with ``most_open`` open, it is cut so that it fills the
    fullest one exactly. At the end of the task the open sequences are poured
    together and the rest is cut at powers of two. So only sequences that reach
    the limit of segments or of loss can need padding.
    """

    def __init__(self, limits: tuple[int, int, int], most_open: int):
        self.limits = np.array(limits, dtype=np.int64)
        self.most_open = most_open
        self.open: list[Bin] = []
        self.room = np.zeros((most_open, 3), dtype=np.int64)
        self.sequences = 0

    # A piece: (document, start, length, loss), where ``document`` is opaque.

    @staticmethod
    def cut(piece, length):
        """The first ``length`` tokens and the rest; loss-bearing tokens come last
        in a piece that has some without loss in front."""
        doc, start, n, loss = piece
        free = n - loss
        head_loss = max(0, length - free)
        return (doc, start, length, head_loss), (doc, start + length, n - length, loss - head_loss)

    @staticmethod
    def fitting(piece, left) -> int:
        """How many leading tokens of the piece fit in ``left``."""
        _, _, n, loss = piece
        if left[1] < 1:
            return 0
        return int(min(n, left[0], (n - loss) + left[2]))

    def add(self, piece) -> Iterator[list]:
        while piece[2]:
            if piece[2] >= self.limits[0] or piece[3] >= self.limits[2]:
                n = self.fitting(piece, self.limits)
                head, piece = self.cut(piece, n)
                yield [head]
                continue
            k = len(self.open)
            room = self.room[:k]
            # The last segment of a sequence is kept for a piece that fills it.
            last = (room[:, 1] > 1) | (room[:, 0] == piece[2])
            fits = (room[:, 0] >= piece[2]) & (room[:, 1] > 0) & (room[:, 2] >= piece[3]) & last
            if fits.any():
                # Both room and demand as shares of the limits.
                score = room @ (np.array([piece[2], 1, piece[3]]) / (self.limits * self.limits))
                at = int(np.argmax(np.where(fits, score, -1.0)))
                yield from self._put(at, piece)
                return
            if k < self.most_open:
                self.open.append(Bin(self.limits))
                self.room[k] = self.limits
                yield from self._put(k, piece)
                return
            able = np.minimum(np.minimum(room[:, 0], piece[2]), piece[2] - piece[3] + room[:, 2]) * (room[:, 1] > 0)
            # Filled exactly if that can be, else as full as can be.
            at = int(np.argmin((room[:, 0] - able) * (self.limits[0] + 1) + room[:, 0]))
            if able[at]:
                head, piece = self.cut(piece, int(able[at]))
                yield from self._put(at, head)
            if at < len(self.open) and (not able[at] or (self.room[at] <= 0).any()):
                yield self._close(at)

    def _put(self, at, piece) -> Iterator[list]:
        self.open[at].pieces.append(piece)
        self.room[at] -= (piece[2], 1, piece[3])
        if self.room[at, 0] == 0 or self.room[at, 1] == 0:
            yield self._close(at)

    def _close(self, at) -> list:
        done = self.open[at]
        last = len(self.open) - 1
        self.open[at], self.room[at] = self.open[last], self.room[last]
        self.open.pop()
        return done.pieces

    def finish(self) -> Iterator[list]:
        pieces = [p for b in self.open for p in b.pieces][::-1]
        self.open = []
        left, taken = self.limits.copy(), []
        while pieces:
            piece = pieces.pop()
            n = self.fitting(piece, left)
            if n:
                head, rest = self.cut(piece, n)
                taken.append(head)
                left -= (n, 1, head[3])
                piece = rest
            if piece[2]:
                pieces.append(piece)
            if left[0] == 0 or left[1] == 0 or piece[2]:
                yield taken
                left, taken = self.limits.copy(), []
        total = sum(p[2] for p in taken)
        # The rest, cut at powers of two: each part is a sequence without padding.
        taken = taken[::-1]
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part = []
            while size:
                piece = taken.pop()
                head, rest = self.cut(piece, min(size, piece[2]))
                part.append(head)
                size -= head[2]
                if rest[2]:
                    taken.append(rest)
            yield part


class Tokens:
    """A document, or a stretch of its ids from ``start`` on."""

    __slots__ = ("name", "total", "start", "ids")

    def __init__(self, name, total: int, start: int, ids: bytes):
        self.name, self.total, self.start, self.ids = name, total, start, ids

    def part(self, start: int, length: int) -> Tokens:
        at = 4 * (start - self.start)
        return Tokens(self.name, self.total, start, self.ids[at : at + 4 * length])


class TokenPacker(Packer):
    """Open sequences hold the ids of their own pieces, not of whole documents."""

    def _put(self, at, piece) -> Iterator[list]:
        doc, start, n, loss = piece
        yield from super()._put(at, (doc.part(start, n), start, n, loss))


def pack_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = 0,
    max_tokens: int = 1024, max_segments: int = 128, max_loss: int = 1024, prompt_tokens_col: str | None = None,
    most_open: int = 64,
) -> DataFrame:
    """Pieces of all documents, packed: id, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset, loss_tokens.

    A document is the ids of its text and ``end_id``. Its first
    ``prompt_tokens_col`` tokens (default 0) bear no loss. Null and empty texts
    are just the end id, texts of any length are cut into as many pieces as they
    need, repeated rows are packed each by themselves, null ids are carried like
    others, extra columns are ignored and an empty table gives no rows.

    Every task packs its own input in one pass, without a shuffle, and holds at
    most ``most_open`` unfinished sequences, with the ids in them. Sequence ids start with the number
    of the task, so a task that runs again gives the same rows.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    prompt = F.lit(0) if prompt_tokens_col is None else F.coalesce(col(prompt_tokens_col), F.lit(0))
    plain = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"), prompt.cast("long").alias("_prompt"))
    numbers = ["start", "length", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    schema = T.StructType(
        [T.StructField("_id", plain.schema["_id"].dataType), T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in numbers]
    )
    end = int(end_id).to_bytes(4, "little")
    limits = (max_tokens, max_segments, max_loss)
    id_type = docs.select(col(id_col)).limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(vocabulary), TokenPacker(limits, most_open)
        number = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def write(sequence) -> None:
            nonlocal number
            offset = 0
            for doc, start, length, loss in sequence:
                out.append((doc.name, doc.part(start, length).ids, start, length, doc.total, number, offset, loss))
                offset += length
            number += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in schema.fields]
            kinds = [id_type, pa.binary(), *[pa.int64()] * len(numbers)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.fieldNames())

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for name, ids, prompt_n in zip(part["_id"], encode(part["_text"]), part["_prompt"]):
                    ids += end
                    n = len(ids) // 4
                    loss = n - min(n, max(0, prompt_n))
                    for sequence in packer.add((Tokens(name, n, 0, ids), 0, n, loss)):
                        write(sequence)
                if len(out) > 2000:
                    yield batch_of()
        for sequence in packer.finish():
            write(sequence)
        yield batch_of()
        encode.forget()

    return plain.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def op8_packing(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    packed = pack_tokens(documents.select("doc_id", "text"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
