"""Quality by a convolutional network over the bytes of whole texts, in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col
from phenoloom.llm.toxicity import fit_logistic
from phenoloom.session import stage

PAD = 256  # stands after the end of texts shorter than a chunk
CHUNK, WIDTH, EMBED, FILTERS = 512, 6, 8, 16


def chunks_of(text: str | None) -> np.ndarray:
    """Overlapping chunks of the whole text's bytes, one a row.

    Every run of ``WIDTH`` bytes lies whole in a chunk; the last chunk ends with
    the text. A text shorter than a chunk is padded.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.int16)
    if len(data) <= CHUNK:
        return np.pad(data, (0, CHUNK - len(data)), constant_values=PAD)[None, :]
    starts = np.arange(0, len(data) - CHUNK, CHUNK - WIDTH + 1)
    starts = np.append(starts, len(data) - CHUNK)
    return data[starts[:, None] + np.arange(CHUNK)]


@dataclass
class Network:
    """Byte embedding, filters, and weights of the pooled filters' mean and maximum over chunks."""

    embed: np.ndarray  # 257 x EMBED; the padding's row stays zero
    filters: np.ndarray  # WIDTH x EMBED x FILTERS
    bias: np.ndarray  # FILTERS
    top: np.ndarray  # 2 * FILTERS + 1

    @classmethod
    def start(cls, rng: np.random.Generator) -> Network:
        embed = rng.normal(0, 0.5, (257, EMBED))
        embed[PAD] = 0
        filters = rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH, EMBED, FILTERS))
        return cls(embed, filters, np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS + 1))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.top]

    def tables(self) -> np.ndarray:
        """What each byte adds to each filter at each place of the window."""
        return np.ascontiguousarray(np.einsum("be,wef->wbf", self.embed, self.filters), dtype=np.float32)

    def pooled(self, chunks: np.ndarray, tables: np.ndarray, places: bool = False):
        """The largest response of every filter in every chunk, and where it is."""
        span = chunks.shape[1] - WIDTH + 1
        best = np.empty((len(chunks), FILTERS), dtype=np.float32)
        where = np.empty((len(chunks), FILTERS), dtype=np.int64) if places else None
        for at in range(0, len(chunks), 32):  # a few chunks at a time stay in the cache
            some = chunks[at : at + 32]
            sums = tables[0].take(some[:, :span], axis=0)
            for w in range(1, WIDTH):
                sums += tables[w].take(some[:, w : w + span], axis=0)
            if places:
                where[at : at + 32] = sums.argmax(axis=1)
            best[at : at + 32] = sums.max(axis=1)
        best = best + self.bias.astype(np.float32)
        return (np.maximum(best, 0), where) if places else np.maximum(best, 0)

    def logits(self, texts: list[str | None], tables: np.ndarray | None = None) -> np.ndarray:
        tables = self.tables() if tables is None else tables
        made = [chunks_of(t) for t in texts]
        at = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int64)
        if not len(texts):
            return np.zeros(0)
        return self._combine(self.pooled(np.concatenate(made), tables).astype(np.float64), at)[0]

    def _combine(self, pooled: np.ndarray, at: np.ndarray):
        mean = np.add.reduceat(pooled, at[:-1], axis=0) / np.diff(at)[:, None]
        high = np.maximum.reduceat(pooled, at[:-1], axis=0)
        return np.concatenate([mean, high], axis=1) @ self.top[:-1] + self.top[-1], mean, high

    def gradient(self, made: list[np.ndarray], label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean log loss of some texts (as chunks) and its slope in every parameter."""
        at = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int64)
        chunks, size = np.concatenate(made), np.diff(at)
        pooled, where = self.pooled(chunks, self.tables(), places=True)
        pooled = pooled.astype(np.float64)
        logit, mean, high = self._combine(pooled, at)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        loss = -np.mean(np.where(label > 0, np.log(p + 1e-12), np.log(1 - p + 1e-12)))
        d_logit = (p - label) / len(label)
        d_top = np.append(np.concatenate([mean, high], axis=1).T @ d_logit, d_logit.sum())
        text = np.repeat(np.arange(len(size)), size)
        d_pool = (d_logit / size)[text, None] * self.top[:FILTERS]
        # The maximum over a text's chunks passes its slope to the first chunk that has it.
        first = np.full((len(size), FILTERS), len(chunks))
        t, f = np.nonzero(pooled == high[text])
        np.minimum.at(first, (text[t], f), t)
        d_pool[first, np.arange(FILTERS)] += d_logit[:, None] * self.top[FILTERS:-1]
        d_pool *= pooled > 0
        d_tables = np.zeros((WIDTH, 257, FILTERS))
        for w in range(WIDTH):
            seen = np.take_along_axis(chunks, where + w, axis=1)
            np.add.at(d_tables[w], (seen, np.arange(FILTERS)), d_pool)
        d_embed = np.einsum("wbf,wef->be", d_tables, self.filters)
        d_embed[PAD] = 0
        return loss, [d_embed, np.einsum("wbf,be->wef", d_tables, self.embed), d_pool.sum(axis=0), d_top]


def fit_network(texts: list[str], label: np.ndarray, rounds: int = 8, batch: int = 32, rate: float = 0.01, chunks: int = 6, seed: int = 7) -> Network:
    """Adam over the texts; each round sees up to ``chunks`` chunks of a text, drawn from all of it."""
    rng = np.random.default_rng(seed)
    net = Network.start(rng)
    all_chunks = [chunks_of(t) for t in texts]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parts()]
    step = 0
    for turn in range(rounds):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            made = [c if len(c) <= chunks else c[rng.choice(len(c), chunks, replace=False)] for c in (all_chunks[i] for i in some)]
            _, slopes = net.gradient(made, label[some])
            step += 1
            pace = rate * (1 - turn / rounds)
            for part, slope, (m, v) in zip(net.parts(), slopes, moment):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                part -= pace * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + 0.01 * part)
    return net


def sample_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int):
    """Labelled (text, label) pairs, at most ``per_class`` of each class, and the classes' sizes.

    Rows are chosen by a hash of id and text, first by a share that the class's
    size sets, so the ranking sees little more than the sample; equal rows count
    once. Texts are fetched by id and hash, so a repeated id brings no others.
    """
    known = labels.filter(col(label_col).isNotNull()).groupBy(col(id_col).alias("_id")).agg((F.max(col(label_col)) > 0).alias("_one"))
    plain = docs.select(col(id_col).alias("_id"), F.coalesce(col(text_col), F.lit("")).alias("_text"))
    hashed = plain.select("_id", F.xxhash64("_id", "_text").alias("_hash"))
    rows = hashed.join(known, "_id").groupBy("_one", "_hash").agg(F.min("_id").alias("_id"))
    rows = stage(rows)
    size = {r["_one"]: r["n"] for r in rows.groupBy("_one").agg(F.count("*").alias("n")).collect()}  # two rows
    share = F.lit(0.0)
    for one, n in size.items():
        share = F.when(F.col("_one") == one, F.lit(1.2 * per_class / n)).otherwise(share)
    order = Window.partitionBy("_one").orderBy("_hash")
    chosen = (
        rows.filter(F.pmod(F.col("_hash"), F.lit(1 << 30)) / (1 << 30) < share)
        .withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_class).drop("_rank")
    )
    found = (
        plain.withColumn("_hash", F.xxhash64("_id", "_text")).join(F.broadcast(chosen), ["_id", "_hash"])
        .groupBy("_one", "_hash").agg(F.first("_text").alias("_text"))
    )
    return [(r["_text"], r["_one"]) for r in found.orderBy("_one", "_hash").collect()], size  # the bounded sample


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int):
    """(network, slope, constant), or the share of ones if a class has too few texts to learn from."""
    pairs, size = sample_texts(docs, labels, id_col, text_col, label_col, per_class)
    prior = (size.get(True, 0) + 1) / (sum(size.values()) + 2)
    fit, tune = [], []
    for one in (False, True):
        texts = list(dict.fromkeys(t for t, label in pairs if label == one))
        fit += [(t, float(one)) for k, t in enumerate(texts) if k % 4]
        tune += [(t, float(one)) for k, t in enumerate(texts) if not k % 4]
    if any(len({y for _, y in part}) < 2 for part in (fit, tune)):
        return prior
    net = fit_network([t for t, _ in fit], np.array([y for _, y in fit]))
    x, y = net.logits([t for t, _ in tune]), np.array([y for _, y in tune])
    # Weights restore the shares that the classes have among all labelled rows.
    weight = np.where(y > 0, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    slope, constant = fit_logistic(np.stack([x, np.ones(len(x))], axis=1), y, weight, ridge=0.01)
    return net, slope, constant


def score_quality(
    docs: DataFrame, train_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_class: int = 800, output: str = "score",
) -> DataFrame:
    """(id, score) for every row of ``docs``; 1 is good.

    A network over bytes: learned filters slide over overlapping chunks that
    cover the whole text, the largest response of a filter in a chunk is kept,
    and the mean and maximum over chunks are combined into one probability. It
    is trained on the driver on at most ``per_class`` labelled texts of each
    class; a quarter of them is kept aside to calibrate it to the classes' shares.

    A row with several labels is good if one is; null labels and labels without
    a text are left out. Null and empty texts are one chunk of padding. With a
    class missing, every score is the share of good labels, drawn a little to
    one half. Repeated rows are scored each by themselves, texts of any length
    as a whole. Extra columns are ignored; an empty table gives no rows.
    """
    model = train(train_docs, labels, id_col, text_col, label_col, per_class)
    plain = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    schema = T.StructType([plain.schema["_id"], T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model[0].tables() if isinstance(model, tuple) else None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                if tables is None:
                    scores = np.full(part.num_rows, model)
                else:
                    net, slope, constant = model
                    scores = 1 / (1 + np.exp(-np.clip(slope * net.logits(part.column("_text").to_pylist(), tables) + constant, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(scores)], ["_id", "_score"])

    return plain.mapInArrow(run, schema).toDF(id_col, output)


def fold_of_three(id_col: Column) -> Column:
    """Held-out fold of the query: crc32 of the id as text, modulo 3, is 1. A null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op11_quality_cnn(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, held_out, score, predicted."""
    fold = fold_of_three(F.col("doc_id"))
    texts = documents.select("doc_id", "text")
    scored = score_quality(texts, texts.filter(~fold), labels.filter(~fold).select("doc_id", "quality"))
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
