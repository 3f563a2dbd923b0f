"""Benchmark items in documents: verbatim, with other values, and what is left alone."""

import random
import time
from collections import Counter

import pyarrow as pa

from sunledger.llm import decontam as D
from tests.llm.fixtures import documents

ITEM = (
    "A gardener named Tomas buys 12 bags of soil and each bag weighs 25 kg so what does Tomas carry home"
    " if he leaves 3 bags with his neighbour Ines before noon"
)


def found(spark, texts, items, **options):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.contaminated(documents(spark, texts).selectExpr("*", "1 as item_id", "2 as similarity"), benchmark, **options)
    return sorted((r.doc_id, r.item_id) for r in got.collect())


def test_templates():
    t = D.Template(pa.array(["The price is 3.50 kg for Anna. Later Anna paid", "  ", None, "Ölaf said: Olaf ÉCOLE"]))
    assert t.kind.tolist() == [0, 0, 0, 1, 3, 0, 2, 0, 2, 0] + [0, 0, 0, 2]
    assert t.first.tolist() == [0, 10, 10, 10, 14]


def test_verbatim_and_new_values(spark):
    other = ITEM.replace("Tomas", "Rahel").replace("Ines", "Jorge").replace("12", "7").replace("25", "40").replace("3", "2")
    rows = [
        (1, "before it all. " + ITEM + " and after"),
        (2, "some words, then " + other.upper().lower().replace("rahel", "Rahel").replace("jorge", "Jorge") + "!"),
        (3, "|".join(f" {w}, " for w in ITEM.split())),
        (4, " ".join(ITEM.split()[:12])),
        (6, None),
        (7, ""),
        (8, "nothing of the kind stands in this text at all " * 200),
        (9, "x y z " * 3000 + ITEM),
    ]
    assert found(spark, rows, [(50, ITEM), (51, "too short item"), (52, None), (53, "")]) == [(1, 50), (2, 50), (3, 50), (9, 50)]


def test_values_must_be_renamed_alike(spark):
    item = "In the morning Lena had 4 pens and at noon Lena had 4 pens and at night Lena had 4 pens and so on till dawn"
    alike = item.replace("Lena", "Bo").replace("4", "9")
    apart = item.replace("Lena", "Bo", 1).replace("Lena", "Cy", 1).replace("4", "5", 1).replace("4", "6", 1)
    assert found(spark, [(1, alike), (2, apart), (3, item)], [(7, item)]) == [(1, 7), (3, 7)]


def test_slots():
    assert D.slots_agree([(1, 10, 20), (1, 10, 20), (2, 5, 6)], 0.8)
    assert not D.slots_agree([(1, 10, 20), (1, 10, 21), (1, 11, 22), (1, 11, 20)], 0.8)
    assert D.slots_agree([(1, 10, 20), (2, 10, 20)], 1.0) and D.slots_agree([], 1.0)


def test_a_benchmark_in_blocks(spark):
    items = [(i, f"{ITEM} number {chr(97 + i)}{chr(98 + i)} of the whole long list of puzzles") for i in range(5)] + [(4, "a b c d e f")]
    rows = [(i, "so " + t) for i, t in items] + [(None, ITEM)]
    whole = found(spark, rows, items)
    assert found(spark, rows, items, block=30) == whole and {(i, i) for i in range(5)} <= set(whole)


def test_odd_tables(spark):
    assert found(spark, [], [(1, ITEM)]) == [] and found(spark, [(1, ITEM)], []) == []
    assert found(spark, [(1, ITEM), (1, ITEM)], [(1, ITEM), (1, ITEM)]) == [(1, 1)]


def test_names_that_open_sentences(spark):
    item = "Alice has 5 apples. Bob gives her 3 more apples. Alice eats 2 of them. How many apples does Alice have now?"
    other = item.replace("Alice", "Carol").replace("Bob", "David").replace("5", "8")
    rows = [(1, other), (2, "as told " + other), (3, "Carol has 5 pears. Bob saw them.")]
    assert found(spark, rows, [(9, item)]) == [(1, 9), (2, 9)]
    song = " ".join(f"Lena {verb} near the old mill." for verb in ("sat", "ate", "sang", "slept", "woke", "read"))
    alike, apart = song.replace("Lena", "Bo"), song
    for name in ("Bo", "Cy", "Di", "Ed", "Flo", "Gus"):
        apart = apart.replace("Lena", name, 1)
    assert found(spark, [(1, alike), (2, apart)], [(9, song)]) == [(1, 9)]


def test_copies_in_other_case_and_punctuation(spark):
    short = "Where did Émile hide the Öl lamp?"
    items = [(1, ITEM), (2, short), (3, "The sun sets. Mia sleeps. The cat of Mia wakes, then Tom sings.")]
    rows, want = [], []
    for i, text in items:
        bare = "".join(c for c in text if c.isalnum() or c == " ")
        for k, copy in enumerate([text, text.upper(), text.lower(), text.title(), bare, bare.upper(), f"and so {bare} as they say"]):
            rows.append((10 * i + k, copy))
            want.append((10 * i + k, i))
    assert found(spark, rows, items) == want


def test_items_do_not_depend_on_their_neighbours(spark):
    item = "Rose has 5 apples. Tom gives her 3 more apples. Rose eats 2 of them. How many apples does Rose have now?"
    copy = item.replace("Rose", "Ada").replace("Tom", "Max").replace("5", "9")
    other = "A rose is a flower, a rose has thorns, and many a rose is red while the tom cat sleeps near the old garden wall"
    assert found(spark, [(1, copy)], [(1, item)]) == [(1, 1)]
    assert found(spark, [(1, copy)], [(1, item), (2, other)]) == [(1, 1)]


def test_tables_of_numbers(spark):
    rng = random.Random(1)
    numbers = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    items = [(i, f"Sort these: {numbers(20)}") for i in range(60)]
    texts = [numbers(20_000), "0 " * 20_000, "x y " + items[3][1] + " z"]
    search = D._found(items, D.WINDOW_WORDS, D.MIN_SIMILARITY)
    started = time.monotonic()
    assert [(d, i) for d, i, _ in search(pa.array(texts))] == [(2, 3)]
    assert time.monotonic() - started < 1


def plain(text, item, window=5, least=0.8):
    """The best share over all readings, by lists of words and every stretch."""
    a, b = D.Template(pa.array([text])), D.Template(pa.array([item]))
    best = 0.0
    for (kinds, words), (_, doc) in zip(b.views(), a.views()):
        words, doc, kinds = words.tolist(), doc.tolist(), kinds.tolist()
        spans = lambda x: [tuple(x[i : i + window]) for i in range(len(x) - window + 1)]
        strong, bare = {}, []
        for i, span in enumerate(spans(words)):
            if sum(k == 0 for k in kinds[i : i + window]) >= 2:
                strong.setdefault(span, i)
            else:
                bare.append(i)
        size = len(strong) + len(bare)
        hits = [(p, strong[span]) for p, span in enumerate(spans(doc)) if span in strong]
        for p0, _ in hits:
            near = [(p, q) for p, q in hits if p0 <= p < p0 + size + size // 4]
            shifts = sorted(p - q for p, q in near)
            n = len(shifts)
            shift = int(shifts[n // 2] if n % 2 else (shifts[n // 2 - 1] + shifts[n // 2]) / 2)
            place = {}
            for p, q in sorted(near, key=lambda x: abs(x[0] - x[1] - shift)):
                place.setdefault(q, p)
            for q in bare:
                if q + shift >= 0 and doc[q + shift : q + shift + window] == words[q : q + window]:
                    place[q] = q + shift
            slots = {(kinds[q + d], int(b.value[q + d]), int(a.value[p + d]), q + d) for q, p in place.items() for d in range(window) if kinds[q + d]}
            votes, there, back = Counter(s[:3] for s in slots), {}, set()
            for (kind, x, y), n in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
                if (kind, x) not in there and (kind, y) not in back:
                    there[kind, x] = n
                    back.add((kind, y))
            if sum(there.values()) >= least * len(slots) and size:
                best = max(best, len(place) / size)
    return best


def puzzles(n=12):
    rng = random.Random(7)
    names, things = ["Ada", "Bo", "Cy", "Rose", "Max", "Émile"], ["apples", "maps", "km", "old coins", "roses"]
    made = []
    for i in range(n):
        parts = [
            f"{rng.choice(names)} has {rng.randrange(99)} {rng.choice(things)} and {rng.randrange(99)} {rng.choice(things)}"
            for _ in range(rng.randint(1, 5))
        ]
        made.append((i, ". ".join(parts) + rng.choice([" What is left?", "", " 1 2 3 4 5 6 7 8 9 so how many " + things[i % 5]])))
    return made


def changed(rng, text):
    words = text.split()
    for k, w in enumerate(words):
        if w.isdigit() and rng.random() < 0.5:
            words[k] = str(rng.randrange(99))
        elif w == "Rose" and rng.random() < 0.7:
            words[k] = "Flo"
        elif rng.random() < 0.03:
            words[k] = "odd"
    return " ".join(words)


def test_against_every_stretch_in_two_block_sizes(spark):
    rng, items = random.Random(3), puzzles()
    rows = [(i, " ".join(["so then", changed(rng, rng.choice(items)[1]), "and on", changed(rng, rng.choice(items)[1])])) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(d, i): s for d, t in rows for i, x in items if (s := plain(t, x)) >= 0.8}
    for block in (20, 10**6):
        got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(documents(spark, rows), benchmark, block=block).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert 40 < len(want) < 300


def test_rows_without_items(spark):
    rows = [(1, "so " + ITEM), (None, ITEM), (2, "clean"), (2, ITEM), (None, "also clean"), (3, None), (4, "")]
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    out = D.without_items(documents(spark, rows).selectExpr("*", "1 as item_id", "2 as similarity"), benchmark)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(2, "clean"), (None, "also clean"), (3, None), (4, "")], key=str)
    assert len(out.columns) == 7 and D.without_items(documents(spark, []), benchmark).count() == 0
