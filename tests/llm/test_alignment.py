"""Token alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from phenoloom.llm import token_alignment as ta
from phenoloom.llm.tokenizing import byte_alphabet

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain_tokens(text):
    """(id, bytes) of both vocabularies by the plain calls."""
    byte_bpe = Tokenizer.from_file(A)
    byte_bpe.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: b for b, c in byte_alphabet().items()}
    ids = byte_bpe.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(letters[c] for c in byte_bpe.id_to_token(i))) for i in ids]
    b = [
        (i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
        for i, p in zip(pieces.encode(text), pieces.encode(text, out_type=str))
    ]
    return a, b


def walk(text):
    """(n_a, n_b, links, groups text), or None without tokens."""
    if not text:
        return None
    a, b = plain_tokens(text)
    if any(b"".join(s for _, s in x) != (" " + text).encode() for x in (a, b)):
        return None
    ends = [np.cumsum([len(s) for _, s in x]).tolist() for x in (a, b)]
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        to_i, to_j = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(str(x) for x, _ in a[i:to_i]) + "|" + ",".join(str(x) for x, _ in b[j:to_j]))
        links.append((a[to_i - 1][0], b[to_j - 1][0]))
        i, j = to_i, to_j
    return len(a), len(b), links, ";".join(groups)


def expected(rows):
    walked = {i: walk(t) for i, t in rows}
    n = Counter(link for w in walked.values() if w for link in w[2])
    most = {}
    for (_, b), count in n.items():
        most[b] = max(most.get(b, 0), count)
    out = {}
    for i, w in walked.items():
        out[i] = (0,) * 6 + ("",) if w is None else (
            w[0], w[1], len(w[2]), len(w[2]), sum(n[x] == most[x[1]] for x in w[2]), sum(n[x] for x in w[2]),
            hashlib.sha256(w[3].encode()).hexdigest(),
        )
    return out, n, most


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "  two  blanks  "), (6, "tab\tand\nline\r\n"), (7, "naïve café"),
    (8, "中文の字 𐍈 ﬁ"), (9, "<s> </s> <unk> <|endoftext|> <0x0A>"), (10, "a▁b"), (11, "\x00"), (12, "nbsp\xa0x　y"),
    (13, "unbelievably tokenization"), (14, "x" * 5000), (15, "unbelievably tokenization"),
]


def test_documents_against_the_walk(spark, documents, texts):
    rows = [(i, t) for i, t in texts.items() if not t or len(t) < 3000]
    found = ta.op13_token_alignment(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == expected(rows)[0]


@pytest.mark.parametrize("block_bytes", [1, 40, 1 << 20])
def test_odd_rows_and_pairs(make, block_bytes):
    docs, pairs = ta.align_tokenizers(make(ODD), block_bytes=block_bytes)
    want, n, most = expected(ODD)
    assert {r["doc_id"]: tuple(r)[1:] for r in docs.collect()} == want
    assert want[10][0] == 0 and want[9][0] > 0  # U+2581 reads as a blank; special strings are text
    got = {(r["a_id"], r["b_id"]): (r["n"], r["is_best"]) for r in pairs.collect()}
    assert got == {k: (v, v == most[k[1]]) for k, v in n.items()}


def test_repeated_ids_null_ids_and_nothing(make):
    docs = ta.op13_token_alignment(make([(None, "one"), (3, "one two"), (3, "one two"), (3, None)]))
    rows = docs.collect()
    assert len(rows) == 4 and [r["n_a"] for r in rows if r["doc_id"] is None] == [1]
    assert sorted(r["n_best"] for r in rows if r["doc_id"] == 3) == [0, 2, 2]
    assert ta.op13_token_alignment(make([])).count() == 0


def test_pieces_as_the_plain_call():
    random.seed(4)
    parts = ["▁", "a", "th", "ing", " ", "  ", "\n", "é", "é", "中", "ﬁ", "<s>", "<0x0A>", " ", "\x00", "1", "!", "𐍈"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 15))) for _ in range(3000)]
    side = ta.PieceTokens(B, 100)
    plain = sentencepiece.SentencePieceProcessor(model_file=B).encode(texts)
    coded, exact = side(texts)
    for text, ids, want in zip(texts, coded, plain):  # U+2581 never spells its text
        assert "▁" in text or np.frombuffer(ids, dtype="<u4").tolist() == want
    assert exact == [b"".join(side.spelled[i] for i in ids) == (" " + t).encode() for ids, t in zip(plain, texts)]


def test_pointer_groups_against_common_ends():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        ends = [np.append(np.flatnonzero(rng.random(n - 1) < p) + 1, n) for p in rng.random(2)]
        groups = ta.pointer_groups(*ends)
        common = np.intersect1d(*ends)
        for got, own in zip(groups, ends):
            assert got.tolist() == np.searchsorted(common, own).tolist()


def test_no_text_is_shuffled(documents):
    docs, _ = ta.align_tokenizers(documents)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.split("Join")[0]


def test_records_are_of_one_document_or_one_pair(make):
    rows = [(i, f"word{i} and some more words") for i in range(40)]
    table = make(rows).coalesce(1)
    want, n, _ = expected(rows)
    found = ta._blocks(table, "doc_id", "text", A, B, 1 << 18, 100).collect()
    assert len(found) == len(rows) + len(n)  # one block holds all
    assert {(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF): r["n"] for r in found if r["pair"] is not None} == n
    assert max(len(r["links"]) for r in found if r["links"] is not None) == max(w[3] for w in want.values())
    docs, _ = ta.align_tokenizers(table)
    assert "collect_list" not in docs._jdf.queryExecution().toString()


@pytest.mark.parametrize("n_pairs, size", [(1, 1), (256, 1), (257, 2), (1 << 16, 2), ((1 << 16) + 1, 4)])
def test_links_take_the_bytes_they_need(n_pairs, size):
    links, n_links = np.array([0, n_pairs - 1, n_pairs // 2]), np.array([2, 0, 1])
    coded = ta._packed(links, n_links, n_pairs)
    assert [len(c) for c in coded] == [2 * size, 0, size]
    assert [ta._unpacked(c, n).tolist() for c, n in zip(coded, n_links)] == [links[:2].tolist(), [], links[2:].tolist()]
