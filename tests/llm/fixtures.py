"""Small tables for the operators: made-up words, copies, edits, nulls, blanks and very long texts."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, alphabet="abcdefghij"):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def corpus(seed=3, n=60):
    """(doc_id, text): originals, exact and near copies, shared passages, and the odd cases."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    texts = []
    for i in range(n):
        body = words(rng, rng.randint(0, 160))
        if i % 7 == 1:
            at = rng.randint(0, len(body))
            body = body[:at] + passage[rng.randint(0, 8) : rng.randint(55, 70)] + body[at:]
        if i % 5 == 2 and texts:
            body = (rng.choice(texts) or "").split()
        if i % 5 == 3 and texts:
            body = (rng.choice(texts) or "").split()
            for _ in range(2):
                if body:
                    body[rng.randrange(len(body))] = "edited"
        gap = rng.choice([" ", "  ", "\n", "\t", " \r\n"])
        texts.append(gap.join(body))
    texts += [None, "", " \n\t ", "one", "same same " * 90, " ".join(words(rng, 6000)), texts[4], texts[4].upper()]
    return list(enumerate(texts))


def documents(spark, rows=None):
    rows = corpus() if rows is None else rows
    full = [(i, t, ("aa", "bb")[i % 2] if i is not None else None, f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, DOCS)
