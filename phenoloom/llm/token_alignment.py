"""Tokens of two vocabularies over the same bytes: groups that end together, and
how often two ids end together in the whole corpus."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col, worker_memo
from phenoloom.llm.tokenizing import Encoder, byte_alphabet
from phenoloom.session import stage

#: Blanks and what follows them. No piece has a blank after another character
#: (checked when the vocabulary is read), so no token crosses such a cut.
CHUNK = re.compile(" *[^ ]+| +")
NO_TOKENS = np.zeros(0, dtype=np.int64)
STEP_BYTES = 1 << 18  # texts aligned at a time
ROW_GROUP_BYTES = 1 << 24


class ByteTokens:
    """Vocabulary A: ids of texts, and the bytes of every id."""

    def __init__(self, path: str, most: int):
        self.encode = Encoder(path, most)
        letters = {c: b for b, c in byte_alphabet().items()}
        with open(path, encoding="utf-8") as file:
            built = json.load(file)
        self.spelled = [b""] * self.encode.tokenizer.get_vocab_size()
        for token, i in built["model"]["vocab"].items():
            self.spelled[i] = bytes(letters[c] for c in token)
        for added in built["added_tokens"]:
            self.spelled[added["id"]] = added["content"].encode()
        self.length = np.array([len(s) for s in self.spelled], dtype=np.int64)
        # With a token for every byte and no normalizer, tokens always spell their text.
        self.exact = built["normalizer"] is None and {bytes([b]) for b in range(256)} <= set(self.spelled)

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[bool] | None]:
        """Ids of the texts, and which of them their tokens spell if that is known."""
        return self.encode([" " + t for t in texts]), [True] * len(texts) if self.exact else None


class PieceTokens:
    """Vocabulary B, remembered per chunk; a block's new chunks are encoded in one call."""

    def __init__(self, path: str, most: int):
        from sentencepiece import SentencePieceProcessor

        self.model, self.most = SentencePieceProcessor(model_file=path), most
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.length = np.array([len(s) for s in self.spelled], dtype=np.int64)
        self.blank = self.model.piece_to_id("▁")
        self.cut = not any(re.search("[^▁]▁", p) for p in pieces)
        self.known: dict[str, bytes] = {}
        self.unlike: set[str] = set()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of new chunks. The model puts a blank before a text by itself, but
        none before an empty one; chunks that their tokens do not spell are noted."""
        out = {}
        for chunk, ids in zip(chunks, self._ids([c[1:] for c in chunks])):
            ids = ids if chunk != " " else [self.blank]
            if b"".join(map(self.spelled.__getitem__, ids)) != chunk.encode("utf-8", "surrogatepass"):
                self.unlike.add(chunk)
            out[chunk] = array("I", ids).tobytes()
        return out

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[bool] | None]:
        if not self.cut:
            return [array("I", ids).tobytes() for ids in self._ids(texts)], None
        chunks = [CHUNK.findall(" " + t) for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        self.unlike.clear()
        used = set().union(*chunks)
        made = self._learn(list(used.difference(self.known)))
        self.known.update(made)
        coded = [b"".join(map(self.known.__getitem__, cs)) for cs in chunks]
        unlike = self.unlike
        exact = [unlike.isdisjoint(cs) for cs in chunks] if unlike else [True] * len(chunks)
        for chunk in made:  # odd and long chunks are not remembered
            if len(chunk) > 64 or chunk in unlike:
                del self.known[chunk]
        return coded, exact


def pointer_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and B, numbered from 0 along the bytes.

    Both lists of byte ends rise and end at the same byte; neither is empty. Every token points to
    the farthest-right token that overlaps it: the other side's token over its
    last byte, if that one ends later, or ends with it and belongs to A. Doubling
    the successors ends at each component's terminal token, one of A, which is
    the component's label.
    """
    n = len(ends_a)
    holder = [np.repeat(np.arange(len(e)), np.diff(e, prepend=0)) for e in (ends_a, ends_b)]  # the token over each byte
    over_b, over_a = holder[1][ends_a - 1], holder[0][ends_b - 1]
    later = ends_b[over_b] > ends_a
    successor = np.concatenate([np.where(later, n + over_b, np.arange(n)), over_a])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    terminal = np.flatnonzero(successor[:n] == np.arange(n))
    number = np.zeros(n, dtype=np.int64)
    number[terminal] = np.arange(len(terminal))
    group = number[successor]
    return group[:n], group[n:]


def _starts(sizes: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))])


def _steps(ends: np.ndarray, at: int, to: int, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes, or of one text, between two places."""
    while at < to:
        before = ends[at - 1] if at else 0
        upto = min(to, max(at + 1, int(np.searchsorted(ends, before + most, side="right"))))
        yield at, upto
        at = upto


@dataclass
class Block:
    """The alignment of some texts: counts and digest per text, then all links in order."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    links: np.ndarray  # A's id in the upper half, B's in the lower

    @classmethod
    def joined(cls, parts: Iterable[Block]) -> Block:
        n_a, n_b, n_groups, digests, links = zip(*((p.n_a, p.n_b, p.n_groups, p.digests, p.links) for p in parts))
        return cls(*map(np.concatenate, (n_a, n_b, n_groups)), sum(digests, []), np.concatenate(links))


class Aligner:
    def __init__(self, path_a: str, path_b: str, most: int):
        self.a, self.b = ByteTokens(path_a, most), PieceTokens(path_b, most)
        top = max(len(self.a.spelled), len(self.b.spelled))
        self.printed = [b"%d%s" % (i, mark) for i in range(top) for mark in (b",", b"|", b";")]

    def forget(self) -> None:
        """Drop what was remembered of texts, so an idle worker holds the vocabularies alone."""
        self.a.encode.forget()
        self.b.known.clear()

    def _tokens(self, side, texts: list[str], spelled: list[bytes]):
        """Ids of all texts, their byte lengths, places of the texts, and which texts the tokens spell."""
        coded, same = side(texts)
        ids = np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int64)
        at = _starts([len(c) // 4 for c in coded])
        if same is None:
            pieces = list(map(side.spelled.__getitem__, ids.tolist()))
            same = [b"".join(pieces[i:j]) == s for i, j, s in zip(at[:-1], at[1:], spelled)]
        return ids, side.length[ids], at, np.array(same, dtype=bool)

    def __call__(self, texts: list[str | None]) -> Block:
        out = Block(*(np.zeros(len(texts), dtype=np.int64) for _ in range(3)), [""] * len(texts), NO_TOKENS)
        rows = [i for i, t in enumerate(texts) if t]
        while rows:
            some = [texts[i] for i in rows]
            spelled = [b" " + t.encode("utf-8", "surrogatepass") for t in some]
            ids_a, bytes_a, at_a, same_a = self._tokens(self.a, some, spelled)
            ids_b, bytes_b, at_b, same_b = self._tokens(self.b, some, spelled)
            if (same_a & same_b).all():
                break
            rows = [i for i, ok in zip(rows, same_a & same_b) if ok]
        if not rows:
            return out
        # Texts follow each other on one line of bytes; both sides end at the end of a text.
        group_a, group_b = pointer_groups(np.cumsum(bytes_a), np.cumsum(bytes_b))
        last_a = np.flatnonzero(np.diff(group_a, append=-1))
        last_b = np.flatnonzero(np.diff(group_b, append=-1))
        first_b = np.concatenate([[0], last_b[:-1] + 1])
        # Printed order: the tokens of A in a group, then those of B.
        order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        mark_a, mark_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        order[np.arange(len(ids_a)) + first_b[group_a]] = 3 * ids_a + mark_a
        order[np.arange(len(ids_b)) + last_a[group_b] + 1] = 3 * ids_b + mark_b
        printed = list(map(self.printed.__getitem__, order.tolist()))
        for row, i, j in zip(rows, at_a + at_b, (at_a + at_b)[1:]):
            out.digests[row] = hashlib.sha256(b"".join(printed[i:j])[:-1]).hexdigest()
        out.n_a[rows], out.n_b[rows] = np.diff(at_a), np.diff(at_b)
        out.n_groups[rows] = np.diff(np.searchsorted(last_a, at_a))
        out.links = ids_a[last_a] << 32 | ids_b[last_b]
        return out


def _packed(links: np.ndarray, n_links: np.ndarray, n_pairs: int) -> list[bytes]:
    """The links of every document, as places among the block's pairs in 1, 2 or 4 bytes each."""
    kind = f"<u{np.min_scalar_type(max(n_pairs - 1, 0)).itemsize}"
    coded, at = links.astype(kind), _starts(n_links)
    return [coded[i:j].tobytes() for i, j in zip(at, at[1:])]


def _unpacked(coded: bytes, n_links: int) -> np.ndarray:
    return np.frombuffer(coded, dtype=f"<u{len(coded) // n_links}") if n_links else NO_TOKENS


def _blocks(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str, block_bytes: int, most: int) -> DataFrame:
    """Small records of two kinds, by block of documents.

    One per distinct pair of the block, in order: ``pair`` and its count ``n``.
    One per document, without a pair: its counts, digest and links, which are
    places among the block's pairs.
    """
    plain = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("pair", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("id", plain.schema["_id"].dataType), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("links", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = worker_memo(f"aligner_{path_a}_{path_b}_{most}", lambda: Aligner(path_a, path_b, most))
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column("_id"), batch.column("_text")
            none = [pa.nulls(0, t) for t in (pa.int64(), pa.int64(), ids.type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())]

            def records(block: int, n: int, first: int, *columns, none=none) -> pa.RecordBatch:
                given = {first + i: c for i, c in enumerate(columns)}
                rest = [given[i] if i in given else pa.nulls(n, x.type) for i, x in enumerate(none)]
                return pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), *rest], schema.fieldNames())

            sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(texts):
                _, to = next(_steps(sizes, at, len(texts), block_bytes))
                made = Block.joined([
                    align(texts.slice(i, j - i).to_pylist()) for i, j in _steps(sizes, at, to, min(block_bytes, STEP_BYTES))
                ])
                pairs, links, counts = np.unique(made.links, return_inverse=True, return_counts=True)
                block = part << 32 | number
                yield records(block, len(pairs), 0, pa.array(pairs), pa.array(counts))
                yield records(
                    block, to - at, 2, ids.slice(at, to - at), pa.array(made.n_a), pa.array(made.n_b), pa.array(made.n_groups),
                    pa.array(made.digests, pa.string()), pa.array(_packed(links, made.n_groups, len(pairs)), pa.binary()),
                )
                at, number = to, number + 1
        align.forget()

    return plain.mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
    block_bytes: int = 1 << 18, most: int = 120_000,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: an alignment per document, and the linked id pairs of the corpus.

    Documents: id, ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups_sha256``. Pairs: ``a_id``, ``b_id``,
    ``n`` (links of the pair) and ``is_best`` (no other id of A has more links
    with this id of B; ties are all best).

    Vocabulary A is a byte-level one for ``tokenizers``, over a blank and the
    text; B one for ``sentencepiece`` that puts the blank itself. Groups are the
    connected components of overlapping tokens, so they lie between the bytes
    where tokens of both sides end; the two tokens that end a group are its link.

    Null and empty texts, and texts whose tokens do not spell a blank and the
    text, have no tokens: zeros, and an empty digest. Strings of special tokens
    are plain text. Rows with the same id count each by itself, a null id is
    kept, extra columns are ignored, and an empty table gives empty tables.
    Texts are aligned whole; a text longer than ``block_bytes`` is a block alone.

    Texts are read once, in blocks of about ``block_bytes``, and are not
    shuffled. A block asks for each of its distinct pairs once, so what is
    exchanged is smaller than the links and a frequent pair has at most one
    request per block. The answers meet the block's documents in order, answers
    first; a task's Python holds one block's answers, and no record is larger than the
    links of one document. Broadcast is one row per id of B, which the vocabulary
    bounds.
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    # Small row groups: a task that reads them decodes a group's links at once.
    blocks = stage(_blocks(docs, id_col, text_col, path_a, path_b, block_bytes, most), **{"parquet.block.size": ROW_GROUP_BYTES})
    asked = blocks.filter("pair IS NOT NULL")
    total = stage(asked.groupBy("pair").agg(F.sum("n").alias("n")))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = total.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    rated = (
        total.withColumn("b_id", b_id).join(F.broadcast(highest), "b_id")
        .select("pair", "b_id", "n", (F.col("n") == F.col("most")).alias("is_best"))
    )
    answers = asked.select("block", "pair").join(rated, "pair").select("block", "pair", "n", "is_best")
    found = answers.unionByName(blocks.filter("pair IS NULL").drop("pair", "n"), allowMissingColumns=True)
    # One number to sort by: blocks, and in a block the documents last.
    placed = (
        found.withColumn("place", F.shiftleft("block", 1) + F.col("pair").isNull().cast("int"))
        .repartition("block").drop("block").sortWithinPartitions("place")
    )
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([
        T.StructField(id_col, blocks.schema["id"].dataType), *[T.StructField(n, T.LongType()) for n in names],
        T.StructField("groups_sha256", T.StringType()),
    ])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, some = -1, []  # a block and its answers, which may go on in the next batch
        for batch in batches:
            place = batch.column("place").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(place)) + 1), len(place)]
            for i, j in zip(edges, edges[1:]):
                if i == j:  # an empty batch
                    continue
                part = batch.slice(i, j - i)
                if place[i] >> 1 != block:
                    block, some = place[i] >> 1, []
                if not place[i] & 1:
                    some.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "is_best")])
                    continue
                if len(some) != 1:
                    some = [[np.concatenate(x) for x in zip(*some)] or [NO_TOKENS] * 3]
                order = np.argsort(some[0][0])  # links are places among the block's pairs in order
                n, best = some[0][1][order], some[0][2][order].astype(np.int64)
                n_links = part.column("n_groups")
                links = [_unpacked(*x) for x in zip(part.column("links").to_pylist(), n_links.to_pylist())]
                sums = [pa.array([int(x[at].sum()) for at in links], pa.int64()) for x in (best, n)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "n_a", "n_b")), n_links, n_links, *sums, part.column("digest")], schema.fieldNames()
                )

    pairs = rated.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("b_id").cast("int").alias("b_id"), "n", "is_best")
    return placed.mapInArrow(rate, schema), pairs


def op13_token_alignment(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned, _ = align_tokenizers(documents)
    return aligned.withColumn("doc_id", F.col("doc_id").cast("long"))
