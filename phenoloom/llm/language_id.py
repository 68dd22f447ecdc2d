"""Language identification by unigrams over a public vocabulary of pieces.

Every language has a probability for each piece of a fixed vocabulary. A word
is scored by the sum over all its segmentations into pieces, which the forward
algorithm gives in one sweep; the probabilities are fitted by expectation
maximisation over the same segmentations.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col, fetch_sample, held_out, sample_per_class, worker_memo

WORD_START = "▁"
LONGEST = 24  # characters of a word scored at a time; longer words are scored in parts
UNDETERMINED = "und"


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return re.findall(r"[^\W\d_]+", text.lower())


def read_vocabulary(path: str) -> list[str]:
    """All pieces of letters, and the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if p.replace(WORD_START, "", 1).isalpha() or p == WORD_START})


class PieceTable:
    """Finds the pieces inside many words at once, by hashes of substrings."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    BITS = 20

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces))
        keys = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.keys = np.concatenate([[np.uint64(0)], keys])
        self.slots = np.zeros(1 << self.BITS, dtype=np.int32)
        for number, key in enumerate(keys, 1):
            place = int(key >> np.uint64(64 - self.BITS))
            while self.slots[place]:
                place = (place + 1) % len(self.slots)
            self.slots[place] = number
        # Most probes a lookup may need: one more than the longest run of full slots.
        full = np.flatnonzero(np.diff(np.concatenate([[0], self.slots > 0, [0]]).astype(np.int8)))
        self.probes = int((full[1::2] - full[::2]).max()) if len(full) else 1

    @classmethod
    def _hash(cls, piece: str) -> int:
        value, base = 0, int(cls.BASE)
        for c in piece:
            value = ((value ^ (ord(c) + 1)) * base) % (1 << 64)
        return value

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, 0 for none: [start, length - 1, word]."""
        n, width = codes.shape
        found = np.zeros((width, self.longest, n), dtype=np.int32)
        mask = np.int64(len(self.slots) - 1)
        with np.errstate(over="ignore"):
            for start in range(width):
                value = np.zeros(n, dtype=np.uint64)
                for length in range(min(self.longest, width - start)):
                    c = codes[:, start + length]
                    value = (value ^ (c.astype(np.uint64) + np.uint64(1))) * self.BASE
                    place = (value >> np.uint64(64 - self.BITS)).astype(np.int64)
                    number = self.slots[place]
                    hit = self.keys[number] == value
                    result = np.where(hit, number, 0)
                    open_ = ~hit & (number > 0)
                    for _ in range(self.probes - 1):
                        if not open_.any():
                            break
                        place = (place + 1) & mask
                        number = self.slots[place]
                        hit = open_ & (self.keys[number] == value)
                        result = np.where(hit, number, result)
                        open_ &= ~hit & (number > 0)
                    found[start, length] = np.where(c > 0, result, 0)
        return found


def code_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, one row each, zero after the end; and lengths."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.zeros((len(words), int(sizes.max(initial=1))), dtype=np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes[np.arange(codes.shape[1])[None, :] < sizes[:, None]] = flat
    return codes, sizes


def parts(word: str) -> list[str]:
    """The word with its start mark, cut into parts of at most ``LONGEST`` characters."""
    marked = WORD_START + word
    return [marked[i : i + LONGEST] for i in range(0, len(marked), LONGEST)]


class SegmentModel:
    """Piece probabilities per language.

    A letter that is in no piece is spelled by the byte pieces of its UTF-8 form.
    All segmentations of a word share these bytes, so their probabilities are
    factored out of the sums, where such a letter counts as 1."""

    def __init__(self, pieces: list[str], languages: list[str]):
        self.pieces, self.languages = pieces, languages
        self.name = uuid.uuid4().hex  # tells models apart in a worker's memory
        self.table = PieceTable(pieces)
        self.prob = np.zeros((len(pieces) + 1, len(languages)))
        self.byte_log = np.full((256, len(languages)), np.log(1 / 256))

    @staticmethod
    def _bytes(code: int) -> list[int]:
        return list(chr(code).encode("utf-8", "surrogatepass"))

    def _numbers(self, words: list[str]):
        codes, sizes = code_matrix(words)
        found = self.table.find(codes)
        single = (found[:, 0, :] == 0) & (codes.T > 0)  # letters that are no piece themselves
        return found, single, sizes, codes

    def forward(self, found: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of every prefix: [end, word, language]."""
        width, longest, n = found.shape
        alpha = np.zeros((width + 1, n, len(self.languages)))
        alpha[0] = 1.0
        for end in range(1, width + 1):
            total = alpha[end]
            for length in range(1, min(longest, end) + 1):
                number = found[end - length, length - 1]
                on = np.flatnonzero(number)
                if len(on):
                    total[on] += alpha[end - length, on] * self.prob[number[on]]
            on = np.flatnonzero(single[end - 1])
            if len(on):
                total[on] += alpha[end - 1, on]
        return alpha

    def log_prob(self, words: list[str]) -> np.ndarray:
        """Log of the sum over all segmentations, per word and language."""
        if not words:
            return np.zeros((0, len(self.languages)))
        cut = [parts(w) for w in words]
        flat = [p for c in cut for p in c]
        found, single, sizes, codes = self._numbers(flat)
        alpha = self.forward(found, single)
        logs = np.log(np.maximum(alpha[sizes, np.arange(len(flat))], 1e-300))
        place, word = np.nonzero(single)
        if len(word):
            letters, number = np.unique(codes[word, place], return_inverse=True)
            spelled = np.array([self.byte_log[self._bytes(int(c))].sum(axis=0) for c in letters])
            np.add.at(logs, word, spelled[number])
        starts = np.cumsum([0] + [len(c) for c in cut[:-1]])
        return np.add.reduceat(logs, starts, axis=0)

    def fit(self, counts: list[Counter], rounds: int = 5, smooth: float = 0.01) -> SegmentModel:
        """Expectation maximisation, one language at a time."""
        for k, words in enumerate(counts):
            weights: Counter = Counter()
            for word, n in words.items():
                for part in parts(word):
                    weights[part] += n
            listed = sorted(weights)
            found, single, sizes, codes = self._numbers(listed)
            weight = np.array([weights[w] for w in listed], dtype=float)
            place, word = np.nonzero(single)
            letters, number = np.unique(codes[word, place], return_inverse=True)
            uses = np.full(256, smooth)
            for letter, n in zip(letters, np.bincount(number, weight[word], len(letters))):
                np.add.at(uses, self._bytes(int(letter)), n)
            # Start from the counts of all pieces inside the words.
            expected = np.bincount(found.ravel(), np.broadcast_to(weight, found.shape).ravel(), len(self.prob))
            one = SegmentModel.__new__(SegmentModel)
            one.languages = [self.languages[k]]
            for _ in range(rounds):
                expected[0] = 0.0
                share = expected + smooth
                share[0] = 0.0
                total = share.sum() + uses.sum()
                one.prob = (share / total)[:, None]
                expected = one._expect(found, single, sizes, weight)
            self.prob[:, k], self.byte_log[:, k] = one.prob[:, 0], np.log(uses / total)
        return self

    def _expect(self, found, single, sizes, weight) -> np.ndarray:
        """Expected uses of every piece over all segmentations."""
        width, longest, n = found.shape
        alpha = self.forward(found, single)[:, :, 0]
        beta = np.zeros((width + 1, n))
        beta[sizes, np.arange(n)] = 1.0
        prob = self.prob[:, 0]
        for start in range(width - 1, -1, -1):
            for length in range(1, min(longest, width - start) + 1):
                number = found[start, length - 1]
                beta[start] += np.where(number > 0, prob[number] * beta[start + length], 0.0)
            beta[start] += np.where(single[start], beta[start + 1], 0.0)
        scale = weight / np.maximum(alpha[sizes, np.arange(n)], 1e-300)
        expected = np.zeros(len(prob))
        for start in range(width):
            for length in range(1, min(longest, width - start) + 1):
                number = found[start, length - 1]
                uses = alpha[start] * prob[number] * beta[start + length] * scale
                expected += np.bincount(number, uses, len(prob))
        return expected


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, vocabulary: str, per_language: int) -> SegmentModel:
    """Fit on at most ``per_language`` documents of each language; folds are the caller's."""
    known = docs.filter(col(lang_col).isNotNull() & col(text_col).isNotNull())
    ids = sample_per_class(known.select(col(id_col).alias("_id"), col(lang_col).alias("_lang")), ["_lang"], "_id", per_language)
    texts = known.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    counts: dict[str, Counter] = {}
    # The driver sees the bounded sample alone.
    for row in fetch_sample(texts, ids, "_id", 100 * per_language).toLocalIterator():
        counts.setdefault(row["_lang"], Counter()).update(words_of(row["_text"]))
    counts = {k: v for k, v in counts.items() if v}
    languages = sorted(counts)
    return SegmentModel(read_vocabulary(vocabulary), languages).fit([counts[k] for k in languages])


def scorer(model: SegmentModel, memo_words: int = 300_000):
    """Task function: (lang_pred, score) for batches of texts."""
    n_languages = len(model.languages)

    def predict(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        memo = worker_memo("language_words", dict)
        if memo.get("model") != model.name or len(memo["row"]) > memo_words:
            memo.update(model=model.name, row={}, logs=np.zeros((0, n_languages)))
        row = memo["row"]
        listed = [words_of(t) if t else [] for t in texts]
        fresh = list({w for words in listed for w in words if w not in row})
        if fresh and n_languages:
            logs = [model.log_prob(fresh[i : i + 4096]) for i in range(0, len(fresh), 4096)]
            row.update(zip(fresh, range(len(row), len(row) + len(fresh))))
            memo["logs"] = np.concatenate([memo["logs"], *logs])
        names, scores = [], np.zeros(len(texts))
        for i, words in enumerate(listed):
            if not n_languages or not any(c.isalpha() for w in words for c in w):
                names.append(UNDETERMINED)
                continue
            total = memo["logs"][[row[w] for w in words]].sum(axis=0)
            # Words of a text are far from independent: the evidence of n words
            # counts as that of sqrt(n).
            total = total / np.sqrt(len(words))
            share = np.exp(total - total.max())
            best = int(np.argmax(share))
            names.append(model.languages[best])
            scores[i] = share[best] / share.sum()
        return names, scores

    return predict


def identify_language(
    docs: DataFrame,
    train_docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    vocabulary: str | None = None,
    per_language: int = 300,
    output: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """All rows and columns of ``docs`` with a predicted language and its score.

    ``train_docs`` gives texts and known languages; at most ``per_language``
    documents of each are used. Texts that are null, empty or without a letter
    get ``und`` and score 0, as does everything if there is nothing to learn
    from. Texts of any length are scored whole, repeated rows each by
    themselves, ties go to the first language by name. Columns of ``docs`` that
    are named as an output are replaced.
    """
    vocabulary = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    model = train(train_docs, id_col, text_col, lang_col, vocabulary, per_language)
    predict = scorer(model)
    kept = [c for c in docs.columns if c not in output]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(output[0], T.StringType()), T.StructField(output[1], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names, scores = predict(part.column("_text").to_pylist())
                columns = [part.column(f"_c{i}") for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores)], [*[f"_c{i}" for i in range(len(kept))], "_l", "_s"])
        worker_memo("language_words", dict).clear()  # a task's words fill it; an idle worker need not hold them

    plain = docs.select(*[col(c).alias(f"_c{i}") for i, c in enumerate(kept)], col(text_col).alias("_text"))
    inner = T.StructType([T.StructField(f"_c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)] + [T.StructField("_l", T.StringType()), T.StructField("_s", T.DoubleType())])
    return plain.mapInArrow(run, inner).toDF(*schema.fieldNames())


def op9_language_id(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, held_out, lang_pred, score."""
    known = documents.filter(~held_out(F.col("doc_id")))
    scored = identify_language(documents.select("doc_id", "text"), known.select("doc_id", "text", "lang"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
