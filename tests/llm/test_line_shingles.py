"""Fuzzy lines against all pairs under shingles at every position: short, unspaced and very long lines."""

import random

from sunledger.llm import lines as L
from tests.llm.fixtures import documents, words


def shingles(line, k=5):
    return frozenset(line[i : i + k] for i in range(max(1, len(line) - k + 1)))


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def swapped(rng, line):
    """``line`` with one letter changed."""
    at = rng.choice([i for i, c in enumerate(line) if c != " "])
    return line[:at] + "z" + line[at + 1 :]


def pairs():
    """Pairs of lines that share nothing with other pairs: one letter changed in 8 to 25 words, and one sign put into unspaced text."""
    rng = random.Random(11)
    made = []
    for i in range(40):
        line = " ".join(words(rng, 8 + i % 18, "abcdefghijklmnopqrstuvwxy"))
        made.append((line, swapped(rng, line)))
    for alphabet in ("abcdefghijklmnopqrstuvwxy/.-", [chr(0x4E00 + i) for i in range(900)]):
        for at in (0, 1, 7):
            line = "".join(rng.choice(alphabet) for _ in range(200))
            made.append((line, line[:at] + "#" + line[at:]))
    long = "".join(rng.choice("abcdefghij") for _ in range(4096 * 2 + 4))
    made += [(long, "#" + long), ("abcd", "abce"), ("abcdefgh", "abcdefghi"), (long[:36], long[:30] + "#")]
    return made


def test_edits_against_all_shingles(spark):
    made = pairs()
    rows = [(2 * i + k, line) for i, pair in enumerate(made) for k, line in enumerate(pair)]
    got = {r.doc_id for r in L.removed_lines(documents(spark, rows)).collect()}
    alike = {2 * i + 1: jaccard(a, b) for i, (a, b) in enumerate(made)}
    assert got <= {i for i, j in alike.items() if j >= 0.8}
    # Pairs near the threshold meet with the probability of the bands.
    assert {i for i, j in alike.items() if j >= 0.9} <= got
    assert len({i for i, j in alike.items() if j >= 0.8} - got) <= 2 and len(got) >= 35


def test_shingle_values():
    """Equal shingles have equal values wherever they stand; lines meet where one begins."""
    rng = random.Random(2)
    lines = ["".join(rng.choice("abé日") for _ in range(n)) for n in (1, 4, 5, 6, 35, 36, 37, 68, 1, 9000)]
    values, starts = L.shingle_values(lines)
    known = {}
    for line, at in zip(lines, starts.tolist()):
        for i in range(max(1, len(line) - 4)):
            assert known.setdefault(line[i : i + 5], values[at + i]) == values[at + i]
    assert len(values) == starts[-1] + 8996 and len(set(known.values())) == len(known)


def test_bands_follow_the_number_of_lines():
    assert L.banding(0) == L.banding(200_000) == (14, 5) and L.banding(4_000_000) == (18, 6)
    for lines in (10**8, 10**11):
        bands, rows = L.banding(lines)
        assert rows > 5 and 1 - (1 - 0.8**rows) ** bands >= 0.995 and 0.05**rows * bands * lines < 50
