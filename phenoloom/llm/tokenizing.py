"""Token ids of whole texts by the tokenizers library, remembered per piece."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

from phenoloom.llm.common import worker_memo

ODD_ASCII = "\x0b\x0c\x1c\x1d\x1e\x1f"
#: Texts of other characters than ASCII and these are not cut into pieces finer than words.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ɏ]")
#: White space beyond the plain kind; texts with any of it are encoded in one go.
ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: A word with the white space before it, or white space at the end.
CHUNK = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: The splitting patterns of the two vocabularies, for usual characters.
LETTER = "A-Za-zÀ-ɏ"
BYTE_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+")
WORD_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")


def byte_alphabet() -> dict[int, str]:
    """The visible character that byte-level vocabularies write for every byte:
    itself if it is visible in Latin-1, else the next one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Memory(dict):
    """Values made on first use, in two generations: when the new one has more
    than ``most``, the old one goes and long keys are forgotten."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def age(self, too_long: int = 64) -> None:
        if len(self) > self.most:
            self.old = {k: v for k, v in self.items() if len(k) <= too_long}
            self.clear()


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    A text's ids are those of the pieces that the vocabulary's own pattern cuts
    it into. Pieces repeat, so a worker encodes each once and remembers about
    ``most``. Texts of other characters than the pattern here is exact for are
    cut into words, since the vocabularies known here never form a token across
    the border between a visible character and the white space after it. Texts
    with unusual white space and vocabularies of another build are encoded
    whole. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, most: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The parts tell their make; the file itself, merges and all, is not read twice.
        made = [json.loads(p.__getstate__()) if p else {} for p in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        normal, before = [n["type"] for n in made[0].get("normalizers", [])], made[1]
        self.words = normal == ["NFC", "Replace", "Lowercase"] and before.get("type") == "Sequence"
        self.bytes = not made[0] and before.get("type") == "ByteLevel" and before["use_regex"]
        self.piece = WORD_PIECE if self.words else BYTE_PIECE
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.pieces = Memory(self._encode_piece, most)
        self.chunks = Memory(self._encode, most // 4)

    def forget(self) -> None:
        """Drop what was remembered of texts, so an idle worker holds the vocabulary alone."""
        for memory in (self.pieces, self.chunks):
            memory.old = {}
            memory.clear()

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        """A piece that the pattern has cut needs the merges alone."""
        if piece.isascii() and piece.isprintable():
            spelled = piece.replace(" ", self.alphabet[0x20])
        else:
            spelled = piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _usual(self, text: str) -> bool:
        if text.isascii():
            return not any(c in text for c in ODD_ASCII)
        return not UNUSUAL.search(text)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for text in texts:
            text = text or ""
            if not (self.words or self.bytes):
                out.append(self._encode(text))
            elif self._usual(text):
                if self.words:  # this vocabulary is of lower case and drops white space
                    text = text.lower()
                out.append(b"".join(map(self.pieces.__getitem__, self.piece.findall(text))))
            elif ODD_SPACE.search(text):
                out.append(self._encode(text))
            else:
                out.append(b"".join(map(self.chunks.__getitem__, CHUNK.findall(text))))
            self.pieces.age()
            self.chunks.age()
        return out


def encoder(path: str, most: int = 200_000) -> Encoder:
    """The worker's encoder for the vocabulary in ``path``."""
    return worker_memo(f"encoder_{path}_{most}", lambda: Encoder(path, most))
