"""Repeated passages against a table of all windows."""

import hashlib
import re

from sunledger.llm.substrings import repeated_passages
from tests.llm.fixtures import corpus, documents


def expected(rows, size):
    texts = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - size + 1):
            first.setdefault(tuple(texts[i][p : p + size]), i)
    out = {}
    for i, words in texts.items():
        gone = set()
        for p in range(len(words) - size + 1):
            if first[tuple(words[p : p + size])] < i:
                gone.update(range(p, p + size))
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def got(frame):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()}


def test_against_all_windows(spark):
    rows = corpus(n=90)
    want = expected(rows, 50)
    assert got(repeated_passages(documents(spark, rows))) == want and sum(v[1] for v in want.values()) > 500


def test_short_windows_and_multibyte_words(spark):
    rows = [(3, "é ü a é ü a é ü"), (1, "x é ü a y"), (2, "ü\xa0a é ü\ta é"), (9, "x  é\nü a y z"), (4, None), (6, "")]
    assert got(repeated_passages(documents(spark, rows), window=3, seed=2)) == expected(rows, 3)


def test_passages_are_maximal(spark):
    rows = [(1, "a b c d e f g h"), (2, "x b c d e f y g h a b c d z")]
    found = {r.doc_id: r.repeats for r in repeated_passages(documents(spark, rows), window=3, seed=2).collect()}
    assert found == {1: [], 2: [1, 6, 9, 13]}


def test_odd_tables(spark):
    assert repeated_passages(documents(spark, [])).count() == 0
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d")]
    frame = documents(spark, rows).selectExpr("*", "1 as anchor", "2 as n_words", "3 as least")
    assert got(repeated_passages(frame, window=3, seed=2)) == expected([(1, "a b c d"), (2, "a b c d")], 3)
