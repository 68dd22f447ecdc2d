"""Toxicity by compression distance: how much shorter a window gets with a
dictionary of toxic text than with one of ordinary text."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col, fetch_sample, held_out, sample_per_class, worker_memo

EDGES = ".,;:!?\"'#*$%&|<>()[]"
LEVEL = 6
#: Long runs of blanks compress to nothing, but keep a short window from being
#: stored as it is, which would hide the difference.
PAD = b" " * 96
THRESHOLDS = np.arange(1, 9)


def windows_of(text: str | None) -> list[str]:
    """Windows of one lower-cased word, without marks at its edges."""
    return [w for w in (x.strip(EDGES) for x in (text or "").lower().split()) if w]


def _heads(word: str) -> list[str]:
    word = " " + word
    return [word[:n] for n in range(4, min(len(word), 13) + 1)]


def dictionaries(toxic: list[str], ordinary: list[str], least_z: float = 3.5, size: int = 8000) -> tuple[bytes, bytes]:
    """Contents of the two dictionaries, trained on texts of the two classes.

    Both hold the frequent words of ordinary text at the same distance from the
    window. In front of it, each has what marks its class: beginnings of words
    that are in clearly more of the class's texts than of the other's.
    """
    heads: dict[str, list[str]] = {}
    found, words = [Counter(), Counter()], Counter()
    for k, texts in enumerate((ordinary, toxic)):
        for text in texts:
            distinct = set(windows_of(text))
            if k == 0:
                words.update(distinct)
            found[k].update({h for w in distinct for h in heads.setdefault(w, _heads(w))})
    n = [len(ordinary) + 1, len(toxic) + 1]

    def marks(k: int) -> list[str]:
        z = {}
        for head, a in found[k].items():
            if a >= 4:
                p, q = (a + 0.5) / (n[k] + 1), (found[1 - k][head] + 0.5) / (n[1 - k] + 1)
                odds = math.log(p / (1 - p)) - math.log(q / (1 - q))
                z[head] = odds / math.sqrt(1 / (a + 0.5) + 1 / (found[1 - k][head] + 0.5))
        chosen = {h for h, value in z.items() if value >= least_z}
        kept = set(chosen)
        for head in sorted(chosen, key=lambda h: (-len(h), h)):
            before = head[:-1]
            if before in chosen:
                if found[k][head] >= 0.8 * found[k][before]:
                    kept.discard(before)  # nearly all its texts have the longer one
                elif z[before] >= z[head]:
                    kept.discard(head)
        return sorted(kept, key=lambda h: (z[h], h))

    def tail(listed: list[str], room: int) -> bytes:
        out = b""
        for text in reversed(listed):  # the clearest last, nearest to the window
            piece = text.encode("utf-8", "surrogatepass")
            if len(piece) + len(out) > room:
                break
            out = piece + out
        return out

    frequent = [" " + w for w, _ in sorted(words.items(), key=lambda x: (x[1], x[0])) if len(w) > 2]
    shared = tail(frequent, size)
    of_toxic, of_ordinary = tail(marks(1), size), tail(marks(0), size)
    room = max(len(of_toxic), len(of_ordinary))
    rest = frequent[: max(0, len(frequent) - 1000)]
    of_ordinary = tail(rest, max(0, room - len(of_ordinary))) + of_ordinary
    return shared + of_toxic.rjust(room), shared + of_ordinary.rjust(room)


class Distance:
    """Differences of compressed length, remembered per window."""

    def __init__(self, contents: tuple[bytes, bytes]):
        self.known: dict[str, int] = {}
        self.compressors = []
        for content in contents:
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, window: str) -> int:
        value = self.known.get(window)
        if value is None:
            data = b" " + window.encode("utf-8", "surrogatepass") + PAD
            toxic, ordinary = (len(c.compress(data)) for c in self.compressors)
            value = ordinary - toxic
            if len(window) <= 64:
                self.known[window] = value
        return value


def features(text: str | None, distance: Distance, most: int = 500_000) -> np.ndarray:
    """How many windows pass each threshold, as logarithms of counts and of shares."""
    if len(distance.known) > most:
        distance.known.clear()
    windows = windows_of(text)
    values = np.clip(np.array([distance(w) for w in windows], dtype=np.int64), 0, 8)
    passing = np.cumsum(np.bincount(values, minlength=9)[::-1])[::-1][THRESHOLDS]
    n = len(windows)
    return np.concatenate([np.log1p(passing), np.log1p(1000 * passing / max(n, 1)), [math.log1p(n), 1.0]])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method; the last column is the constant."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int):
    """Dictionaries and calibration, or None if a class has no text to learn from."""
    known = (
        labels.filter(col(label_col).isNotNull()).groupBy(col(id_col).alias("_id"))
        .agg((F.max(col(label_col)) > 0).alias("_toxic"))
    )
    totals = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    ids = sample_per_class(known, ["_toxic"], "_id", per_class)
    texts = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    # The driver sees the bounded sample alone; equal texts count once.
    rows = {(r["_toxic"], r["_text"] or ""): r["_id"] for r in fetch_sample(texts, ids, "_id", 4 * per_class).toLocalIterator()}
    split: dict = {(t, part): [] for t in (False, True) for part in (False, True)}
    for (toxic, text), _ in sorted(rows.items(), key=lambda x: (x[0][0], str(x[1]))):
        side = split[toxic, True], split[toxic, False]
        side[len(side[0]) > 2 * len(side[1])].append(text)  # two thirds for the dictionaries
    if not all(split.values()):
        return None
    contents = dictionaries(split[True, True], split[False, True])
    distance = Distance(contents)
    x = np.array([features(t, distance) for toxic in (False, True) for t in split[toxic, False]])
    y = np.repeat([0.0, 1.0], [len(split[False, False]), len(split[True, False])])
    # Weights restore the shares that the classes have among all labelled rows.
    share = [totals.get(k, 0) / sum(totals.values()) * len(y) / max(1, (y == k).sum()) for k in (False, True)]
    return contents, fit_logistic(x, y, np.where(y > 0, share[1], share[0]))


def score_toxicity(
    docs: DataFrame, train_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = 1500, output: str = "score",
) -> DataFrame:
    """(id, score) for every row of ``docs``; 1 is toxic.

    Two zstandard dictionaries are trained on at most ``per_class`` labelled
    texts of each class; windows are compressed with both, and the numbers of
    windows whose length differs by at least 1 to 8 bytes are calibrated to a
    probability on labelled texts that the dictionaries have not seen.

    A row with several labels is toxic if one is; null labels and labels
    without a text are left out. Null and empty texts get the score of a text
    without windows. If one class is missing, all scores are 0. Repeated rows
    are scored each by themselves, texts of any length as a whole. Extra
    columns are ignored.
    """
    model = train(train_docs, labels, id_col, text_col, label_col, per_class)
    plain = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    schema = T.StructType([plain.schema["_id"], T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None:
            contents, beta = model
            made = worker_memo("toxic_distance", dict)
            if made.get("contents") != contents:
                made.update(contents=contents, distance=Distance(contents))
        for batch in batches:
            if model is None:
                scores = np.zeros(batch.num_rows)
            else:
                x = [features(t.as_py(), made["distance"]) @ beta for t in batch.column("_text")]
                scores = 1 / (1 + np.exp(-np.clip(np.array(x, dtype=float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores)], ["_id", "_score"])

    return plain.mapInArrow(run, schema).toDF(id_col, output)


def op1_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, held_out, score, predicted."""
    fold = held_out(F.col("doc_id"))
    texts = documents.select("doc_id", "text")
    scored = score_toxicity(texts, texts.filter(~fold), labels.filter(~fold).select("doc_id", "toxic"))
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
