"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
import random
from collections import Counter

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sunledger.llm import alignment as A
from tests.llm.fixtures import corpus, documents

PLAIN = Tokenizer.from_file(A.BYTE_FILE)
PLAIN.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=A.PIECE_FILE)
SHOWN = {v: k for k, v in A._byte_alphabet().items()}


def bytes_a(token):
    back = {c: b for b, c in SHOWN.items()}
    return bytes(back[c] for c in token)


def bytes_b(i):
    piece = PIECES.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """(ids of A, ids of B, groups as text, links) of a whole text, or None."""
    if not text:
        return None
    a, b = PLAIN.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    raw_a, raw_b = [bytes_a(PLAIN.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return None
    groups, links, i, j, x, y = [], [], 0, 0, 0, 0
    left, right = [], []
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            left.append(a[i])
            x += len(raw_a[i])
            i += 1
        else:
            right.append(b[j])
            y += len(raw_b[j])
            j += 1
        if x == y and left and right:
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            links.append((left[-1], right[-1]))
            left, right = [], []
    return a, b, ";".join(groups), links


def expected(rows):
    found = [(i, plain(t)) for i, t in rows]
    counts = Counter(link for _, f in found if f for link in f[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        n_best = sum(counts[k] == best[k[1]] for k in links)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        out.append((i, len(a), len(b), len(links), len(links), n_best, sum(counts[k] for k in links), digest))
    return sorted(out, key=str)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def odd_rows():
    special = "<|endoftext|> in <s>text</s> <unk> <0x41> ▁word tab\there"
    signs = "  lead and trail  \n\n  two\r\n;\rx)\r\n y's can't I'LL ''s 12 345,6 \xa0nb　sp \x1c \x85z"
    mixed = "caf\xe9 é 日本語 テキスト 🙂🙂 \U0001f468‍\U0001f469 \x00 Ω ﬁ №½"
    base = [(200, special), (201, signs), (202, mixed), (203, " "), (204, "  "), (205, "\n"), (206, "a" * 5000), (None, "the end"), (207, None)]
    return base + [(208, signs), (208, signs), (209, "x▁y"), (210, "▁"), (211, "word \n  word \t word")]


def test_against_whole_texts(spark):
    rows = [(i, t) for i, t in corpus(n=30) if not t or len(t) < 4000] + odd_rows()
    got = collected(A.align(documents(spark, rows).selectExpr("*", "1 as pair", "2 as copies", "3 as digest")))
    assert got == expected(rows)
    assert sum(r[1] > 0 for r in got) > 30


def test_pairs_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(A, "BROADCAST_PAIRS", 0)
    monkeypatch.setattr(A, "FREQUENT", 40)
    rows = [(i, t) for i, t in corpus(seed=9, n=12) if not t or len(t) < 4000] + odd_rows()
    assert collected(A.align(documents(spark, rows))) == expected(rows)
    assert A.align(documents(spark, [])).count() == 0
    assert collected(A.align(documents(spark, [(1, None), (2, "")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def loaded():
    with open(A.BYTE_FILE, "rb") as one, open(A.PIECE_FILE, "rb") as two:
        return A._tokenizers(one.read(), two.read())


ALPHABET = st.sampled_from(list("aeTs '.,;)\n\r\t  1日é🙂▁\xa0\x1c\x85　́<>\x00"))


@settings(max_examples=400, deadline=None)
@given(st.text(ALPHABET, min_size=1, max_size=40))
def test_stretches_against_whole_texts(text):
    """The stretches of any text give the ids of the whole."""
    both = loaded()
    assert both.divisible and both.fast is not None
    parts = both.stretches(" " + text)
    assert "".join(parts) == " " + text and all(p[0] == " " for p in parts)
    (got,), want = list(both.aligned([text])), plain(text)
    assert (got is None) == (want is None)
    if got:
        assert got == (len(want[0]), len(want[1]), want[2], [(a << 32) | b for a, b in want[3]])


def test_random_words_against_whole_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(["the ", "Ab", "s'", "\n", "  ", "\r", "e", "ion", "…", "9"]) for _ in range(200)) for _ in range(50)]
    for text, got in zip(texts, loaded().aligned(texts)):
        a, b, groups, links = plain(text)
        assert got == (len(a), len(b), groups, [(x << 32) | y for x, y in links])
