"""Token counts and token alignment against the tokenizers themselves, on table texts and on odd texts."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eddyline.llm import lookup, token_alignment, token_counts
from eddyline.llm.packing import byte_letters
from eddyline.llm.ragged import words_of
from test_llm import CLASHES, frame, nothing, odd_texts, repeated_rows  # noqa: F401

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def token_texts():
    rnd = random.Random(3)
    blanks = [" ", "  ", "\n", "\t", " ", "　", " ", "\u0085", "\x1c", "​", " ", " \n"]
    parts = [*blanks, "a", "it's", "I'LL", "12", "½", "é", "é", "你好", "\U0001f642", "“x”", "...", "<|endoftext|>", "</s>", "▁", "\x00", "«", "ﬁ", "࢏", "\U0003fc3f", "_", "--"]
    mixed = ["".join(rnd.choice(parts) + rnd.choice(blanks[:3] + [""]) for _ in range(rnd.randrange(1, 60))) for _ in range(150)]
    fixed = [" ", "  ", "\n", " x", "x ", "a  b", "a b", "a \nb", "<|endoftext|>", " <|endoftext|> ", "a <|endoftext|><|endoftext|> b", "q" * 3000, "ab " * 20_000, "࢏࢏ x࢏"]
    return [(5000 + i, t) for i, t in enumerate(fixed + mixed)]


@pytest.fixture(scope="module")
def texts(sf):
    table = [(r["doc_id"] + 1000, r["text"]) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    return table + odd_texts() + token_texts()


def test_words_are_the_text(texts):
    got = []
    for _, n, words in words_of(pa.array([t for _, t in texts], pa.string()), 5000):
        for i in range(n):
            codes = words.codes[words.first[i] : words.first[i + 1]]
            got.append(b"".join(words.distinct.take(pa.array(codes)).to_pylist()))
    assert got == [(t or "").encode() for _, t in texts]


@pytest.mark.parametrize("head", [lookup.HEAD, 20, 0])
def test_token_counts(spark, texts, head):
    """The same with all, some and none of the pre-tokens handed to the tasks."""
    tokenizer = Tokenizer.from_file(BYTES)
    got = token_counts.token_counts(frame(spark, texts), BYTES, head=head).collect()
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in texts]
    assert sorted(map(tuple, got)) == sorted(want)


def test_token_counts_of_odd_tables(spark, repeated_rows, nothing):  # noqa: F811
    tokenizer = Tokenizer.from_file(BYTES)
    got = token_counts.token_counts(repeated_rows, BYTES).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "").ids)) for r in repeated_rows.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(nothing, BYTES).count() == 0 and CLASHES


def test_long_pre_tokens_have_digests_as_keys():
    assert token_counts.key_of("x" * 64) == b"x" * 64 and len(token_counts.key_of("x" * 65)) == 33


def alignment(texts):
    """Whole texts by the libraries, token by token."""
    a_model, b_model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_model.encode_special_tokens = True
    letters = {c: bytes([b]) for b, c in enumerate(byte_letters())}
    rows, held, memo = [], Counter(), {}
    for i, t in texts:
        if t not in memo:
            memo[t] = plain_alignment(t, a_model, b_model, letters)
        rows.append((i, *memo[t]))
        held.update(set(memo[t][-1]))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return [(i, n_a, n_b, n_g, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), sha) for i, n_a, n_b, n_g, sha, links in rows]


def plain_alignment(t, a_model, b_model, letters):
    if not t:
        return 0, 0, 0, "", []
    a, b = a_model.encode(" " + t, add_special_tokens=False).ids, b_model.encode(t)
    spelt_a = [b"".join(letters[c] for c in a_model.id_to_token(x)) for x in a]
    spelt_b = [bytes([int(b_model.id_to_piece(x)[3:5], 16)]) if b_model.is_byte(x) else b_model.id_to_piece(x).replace("▁", " ").encode() for x in b]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + t).encode():
        return 0, 0, 0, "", []
    ends_a, ends_b = list(accumulate(map(len, spelt_a))), list(accumulate(map(len, spelt_b)))
    cuts = sorted({*ends_a} & {*ends_b})
    groups, links, low = [], [], 0
    for c in cuts:
        mine = [x for x, e in zip(a, ends_a) if low < e <= c] if len(cuts) < 500 else a[bisect_right(ends_a, low) : bisect_right(ends_a, c)]
        theirs = b[bisect_right(ends_b, low) : bisect_right(ends_b, c)]
        groups.append(f"{','.join(map(str, mine))}|{','.join(map(str, theirs))}")
        low = c
    j = 0
    for x, size, end in zip(a, map(len, spelt_a), ends_a):
        while ends_b[j] <= end - size:
            j += 1
        k = j
        while k < len(b) and ends_b[k] - len(spelt_b[k]) < end:
            links.append((x, b[k]))
            k += 1
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


@pytest.mark.parametrize("head", [lookup.HEAD, 30, 0])
def test_alignment(spark, texts, head, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 1 << 16 if head else 1 << 20)
    got = token_alignment.align_tokens(frame(spark, texts), BYTES, PIECES, head=head).collect()
    assert sorted(map(tuple, got)) == sorted(alignment(texts))


def test_alignment_of_odd_tables(spark, repeated_rows, nothing):  # noqa: F811
    got = token_alignment.align_tokens(repeated_rows, BYTES, PIECES).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(alignment([(r.doc_id, r.text) for r in repeated_rows.collect()]), key=repr)
    assert token_alignment.align_tokens(nothing, BYTES, PIECES).count() == 0


def test_windows_that_cannot_be_packed(texts, monkeypatch):
    """Windows compared as tuples and a memory of words that starts anew give the same alignments."""
    aligner = token_alignment.Aligner(token_alignment.byte_level(BYTES), token_alignment.sentence_pieces(PIECES))
    parts = [words for _, _, words in words_of(pa.array([" " + t for _, t in texts if t], pa.string()), 20_000)]
    want = [aligner.align(w) for w in parts]
    monkeypatch.setattr(token_alignment, "REMEMBERED", 10)
    aligner.packable = False
    for w, x in zip(parts, want):
        got = aligner.align(w)
        assert got["groups_sha256"] == x["groups_sha256"] and got["pairs"].equals(x["pairs"]) and got["times"].equals(x["times"])
