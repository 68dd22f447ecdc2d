"""Secrets in texts: fixed patterns, and a character network over all candidates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col
from phenoloom.scale import number_rows
from phenoloom.session import stage

#: The kinds of base findings in their order, and their patterns.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEARNED = "learned"
#: What the network looks at: long runs of these characters with a digit, or
#: with letters of both cases after the first.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
BEFORE, INSIDE, AFTER = 24, 40, 8
WIDTH = BEFORE + INSIDE + AFTER


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of every kind without overlaps, too short ones dropped."""
    found = []
    lower = text.lower()
    if any(k in lower for k in ("password", "passwd", "secret", "token", "api")):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    # Runs of hex digits do not touch, so asking for 16 at once finds the same.
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]{16,}", text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if any(c.isdigit() for c in run) or (run[1:] != run[1:].lower() and run[1:] != run[1:].upper()):
            out.append((m.start(), m.end()))
    return out


def _class_table() -> np.ndarray:
    """Class of every ASCII code: the character itself; 0 pads, 1 is any other character."""
    return np.array([1 if c < 32 or c > 126 else c - 30 for c in range(128)], dtype=np.int64)


N_CLASSES = 97


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the characters around and in a candidate, one row for each
    field: a long candidate is seen through fields that overlap by half or more."""
    table = _class_table()

    def codes(part: str) -> np.ndarray:
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        return np.where(points < 128, table[np.minimum(points, 127)], 1)

    known = codes(text[max(0, start - BEFORE) : end + AFTER])
    lead = min(start, BEFORE)  # characters of it before the candidate
    last = max(0, end - start - INSIDE)
    fields = [*range(0, last, INSIDE // 2), last]
    out = np.zeros((len(fields), WIDTH), dtype=np.uint8)
    for row, at in zip(out, fields):
        a, b = lead + at, lead + min(at + INSIDE, end - start)
        before, inside, after = known[max(0, a - BEFORE) : a], known[a:b], known[b : b + AFTER]
        row[BEFORE - len(before) : BEFORE] = before
        row[BEFORE : BEFORE + len(inside)] = inside
        row[BEFORE + INSIDE : BEFORE + INSIDE + len(after)] = after
    return out


class Adam:
    """Steps along slopes, scaled by their running moments."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.w, self.rate, self.n = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, slope: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, g in slope.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.999 * self.second[k] + 0.001 * g * g
            self.w[k] -= self.rate * (self.first[k] / (1 - 0.9**self.n)) / (np.sqrt(self.second[k] / (1 - 0.999**self.n)) + 1e-8)


class CharNetwork:
    """Embedding, one convolution, maximum over each zone, one linear layer.

    An example is the fields of a candidate; its score is the largest of theirs."""

    KERNEL, SIZE, FILTERS = 5, 8, 16

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = {
            "embed": rng.normal(0, 0.3, (N_CLASSES, self.SIZE)),
            "conv": rng.normal(0, 0.25, (self.KERNEL * self.SIZE, self.FILTERS)),
            "bias": np.zeros(self.FILTERS),
            "out": rng.normal(0, 0.2, 3 * self.FILTERS),
            "base": np.zeros(1),
        }
        self.threshold = 0.5

    ZONES = [(0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, WIDTH)]

    def _forward(self, x: np.ndarray):
        half = self.KERNEL // 2
        padded = np.pad(x, ((0, 0), (half, half)))
        taps = np.stack([padded[:, k : k + WIDTH] for k in range(self.KERNEL)], axis=2)
        seen = self.w["embed"][taps].reshape(len(x), WIDTH, -1)
        active = np.maximum(seen @ self.w["conv"] + self.w["bias"], 0)
        where = np.stack([active[:, a:b].argmax(axis=1) + a for a, b in self.ZONES], axis=1)
        top = np.take_along_axis(active, where.reshape(len(x), -1, self.FILTERS), axis=1)
        logit = top.reshape(len(x), -1) @ self.w["out"] + self.w["base"][0]
        return taps, seen, where, top, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _scores(self, fields: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(fields[i : i + 1024])[-1] for i in range(0, len(fields), 1024)])

    def predict(self, x: Sequence[np.ndarray]) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        starts = np.cumsum([0] + [len(fields) for fields in x[:-1]])
        return np.maximum.reduceat(self._scores(np.concatenate(list(x))), starts)

    def _best_fields(self, x: Sequence[np.ndarray]) -> np.ndarray:
        """The field of each example that scores highest now."""
        return np.array([fields[self._scores(fields).argmax()] if len(fields) > 1 else fields[0] for fields in x])

    def slopes(self, x: Sequence[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the cross entropy, summed over the weighted examples."""
        taps, seen, where, top, p = self._forward(self._best_fields(x))
        error = (p - y) * weight
        slope = {"out": top.reshape(len(x), -1).T @ error, "base": np.array([error.sum()])}
        back = (error[:, None] * self.w["out"]).reshape(top.shape) * (top > 0)
        slope["bias"] = back.sum(axis=(0, 1))
        rows = np.arange(len(x))[:, None, None]
        patch = seen[rows, where]  # example, zone, filter, tap values
        slope["conv"] = np.einsum("ezfk,ezf->kf", patch, back)
        to_seen = np.einsum("ezf,kf->ezfk", back, self.w["conv"])
        classes, parts = taps[rows, where].ravel(), to_seen.reshape(-1, self.SIZE)
        slope["embed"] = np.stack([np.bincount(classes, part, N_CLASSES) for part in parts.T], axis=1)
        return slope

    def fit(self, x: Sequence[np.ndarray], y: np.ndarray, rounds: int = 30, rate: float = 0.01, batch: int = 64) -> CharNetwork:
        """Adam on the cross entropy of batches; classes weigh the same."""
        rng = np.random.default_rng(11)
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        adam = Adam(self.w, rate)
        for _ in range(rounds):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                adam.step(self.slopes([x[i] for i in some], y[some], weight[some] / len(some)))
        return self

    def calibrate(self, x: Sequence[np.ndarray], y: np.ndarray, least_recall: float) -> CharNetwork:
        """The highest threshold that still finds ``least_recall`` of the labelled secrets."""
        scores = np.sort(self.predict([x[i] for i in np.flatnonzero(y > 0)]))
        missed = int((1 - least_recall) * len(scores))
        self.threshold = float(scores[missed]) if len(scores) else 1.0
        return self


def labelled(text: str) -> list[tuple[np.ndarray, int]]:
    """Candidates of a text with their labels: 1 if a base pattern finds them."""
    found = base_findings(text)
    out = []
    for start, end in candidates(text):
        hit = any(a < end and start < b for _, a, b in found)
        out.append((encode(text, start, end), int(hit)))
        if hit:  # once more without what stands before it, so that the value itself counts
            blind = out[-1][0].copy()
            blind[:, :BEFORE] = 1
            out.append((blind, 1))
    return out


def _fit_part(y: np.ndarray) -> np.ndarray:
    """Which examples to fit on: the first three quarters of each label; the rest calibrates."""
    out = np.zeros(len(y), dtype=bool)
    for label in (0, 1):
        places = np.flatnonzero(y == label)
        out[places[: max(1, len(places) * 3 // 4)]] = True
    return out


#: Passes over all examples, and the length of a step.
STEPS, RATE = 60, 0.05
#: Examples of a file: adaptive execution would merge them into one, and each pass into one task.
PER_FILE = 2048


def _examples(docs: DataFrame, text_col: str) -> DataFrame:
    """(codes, label, aside): the different candidates of all texts, staged; a quarter by hash is set aside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(codes.tobytes(), label) for text in batch.column("_text") for codes, label in labelled(text.as_py())]
            columns = list(zip(*rows)) if rows else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.binary(), pa.int32()])], ["codes", "label"])

    plain = docs.select(col(text_col).alias("_text")).filter(F.col("_text").rlike("[A-Za-z0-9+/_.=-]{12,}"))
    # Copies count once, and are few before the examples are dealt.
    unique = stage(plain.mapInArrow(run, "codes binary, label int").distinct())
    n_files = max(1, -(-unique.count() // PER_FILE))
    # Sorted, so that sums are taken in the same order on every run.
    dealt = unique.repartition(n_files, "codes", "label").sortWithinPartitions("codes", "label")
    return stage(dealt.withColumn("aside", F.pmod(F.xxhash64("codes", F.lit(3)), F.lit(4)) == 0))


def _fields(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(codes, dtype=np.uint8).reshape(-1, WIDTH) for codes in column.to_pylist()]


def _summed_slopes(examples: DataFrame, network: CharNetwork, weights: dict[int, float], at_once: int) -> dict[str, np.ndarray]:
    """Slopes over all examples; a task hands over one sum."""
    names = list(network.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = batch.column("label").to_numpy().astype(float)
            for at in range(0, len(y), at_once):
                part = y[at : at + at_once]
                weight = np.where(part > 0, weights[1], weights[0])
                slope = network.slopes(_fields(batch.column("codes").slice(at, at_once)), part, weight)
                flat = np.concatenate([slope[k].ravel() for k in names])
                total = flat if total is None else total + flat
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["slopes"])

    rows = examples.select("codes", "label").mapInArrow(run, "slopes binary").collect()
    flat = np.sum([np.frombuffer(r["slopes"]) for r in rows], axis=0)
    ends = np.cumsum([network.w[k].size for k in names])
    return {k: part.reshape(network.w[k].shape) for k, part in zip(names, np.split(flat, ends[:-1]))}


def _threshold(secrets: DataFrame, network: CharNetwork, n: int, least_recall: float) -> float:
    """The highest threshold that still finds ``least_recall`` of the ``n`` labelled secrets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(network.predict(_fields(batch.column("codes"))), pa.float64())], ["score"])

    ranked = number_rows(secrets.select("codes").mapInArrow(run, "score double"), [], ["score"], "at")
    return ranked.filter(F.col("at") == int((1 - least_recall) * n) + 1).first()["score"]


def train(
    docs: DataFrame, text_col: str, most_documents: int, least_recall: float, steps: int = STEPS, rate: float = RATE
) -> CharNetwork | None:
    """Fit on the different candidates of all texts but a quarter set aside,
    which gives the threshold; None without candidates of both labels.

    Every step sums the slopes over all examples where they lie; the driver
    holds the weights and one sum per task. ``most_documents`` bounds only how
    many examples a task works on at once.
    """
    examples = _examples(docs, text_col)
    # Four numbers at most.
    n = {(r["aside"], r["label"]): r["count"] for r in examples.groupBy("aside", "label").count().collect()}
    if len({label for _, label in n}) < 2:
        return None
    # A single secret has to serve twice.
    every = not ((False, 0) in n and (False, 1) in n)
    fitted = examples if every else examples.filter("NOT aside")
    n_fitted = [sum(c for (aside, of), c in n.items() if of == label and (every or not aside)) for label in (0, 1)]
    network = CharNetwork()
    adam = Adam(network.w, rate)
    for _ in range(steps):
        adam.step(_summed_slopes(fitted, network, {label: 0.5 / n_fitted[label] for label in (0, 1)}, min(most_documents, 512)))
    aside = examples.filter("aside") if (True, 1) in n else fitted
    network.threshold = _threshold(aside.filter("label = 1"), network, n.get((True, 1), n_fitted[1]), least_recall)
    return network


def findings(text: str | None, network: CharNetwork | None) -> list[tuple[str, int, int]]:
    """Base findings and candidates that the network takes for secrets, by place.

    A candidate that a base finding covers only in part is scored, and reported
    as a whole beside it, as the rest may be a secret too."""
    text = text or ""
    found = base_findings(text)
    if network is not None:
        free = [(a, b) for a, b in candidates(text) if not any(s <= a and b <= e for _, s, e in found)]
        if free:
            scores = network.predict([encode(text, a, b) for a, b in free])
            found += [(LEARNED, a, b) for (a, b), s in zip(free, scores) if s >= network.threshold]
    names = [*KINDS, LEARNED]
    return sorted(found, key=lambda x: (x[1], names.index(x[0]), x[2]))


def scan_secrets(
    docs: DataFrame, train_docs: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    most_documents: int = 2000, least_recall: float = 0.95,
) -> DataFrame:
    """(id, findings) per row: an array of (kind, start, end, value), by place.

    Places are code points, ends exclusive. Kinds ``assign``, ``access`` and
    ``hex`` are fixed patterns; ``learned`` are candidates not wholly in a base
    finding that a character network takes for secrets. The network is trained
    on the candidates of all texts (of ``train_docs``, else of ``docs``),
    labelled by the patterns; its threshold is the highest that keeps
    ``least_recall`` of the labelled secrets set aside. ``most_documents``
    bounds how many examples a task works on at once; none is left out.

    Null and empty texts have no findings; texts are scanned whole; repeated
    rows are scanned each by themselves. Without candidates of both labels
    there is no network and only patterns count. Extra columns are ignored.
    """
    network = train(docs if train_docs is None else train_docs, text_col, most_documents, least_recall)
    plain = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    finding = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("value", T.StringType())])
    schema = T.StructType([plain.schema["_id"], T.StructField("findings", T.ArrayType(finding))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item in batch.column("_text"):
                text = item.as_py() or ""
                out.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in findings(text, network)])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(out, arrow)], ["_id", "findings"])

    return plain.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def op3_secret_scan(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, counts, base_sha256, spans."""
    found = scan_secrets(documents.select("doc_id", "text"))
    listed = lambda keep: F.array_join(
        F.transform(F.filter("findings", keep), lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
    )
    of_kind = lambda kind: F.filter("findings", lambda f: f["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(lambda f: f["kind"] != LEARNED), 256).alias("base_sha256"),
        listed(lambda f: F.lit(True)).alias("spans"),
    )
