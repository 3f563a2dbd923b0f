"""The three trained operators on small made-up languages: gradients, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from sunledger.llm import language as L
from sunledger.llm import textquality as Q
from sunledger.llm import toxicity as T
from tests.llm.fixtures import documents, words


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    h, t, b = L.HIDDEN, 7, 3
    net = L.Network(["a", "b"], rng.normal(0, 0.2, (2, 256, 3 * h)), rng.normal(0, 0.2, (2, h, 3 * h)), np.zeros((2 * h, 2)), np.zeros(2))
    net.inputs[:, :, : 2 * h] += 0.5
    x = rng.integers(0, 256, (t, b))
    weight = rng.normal(size=(t, b, h)).astype(np.float32)

    def loss():
        single = L.Network(net.labels, net.inputs.astype(np.float32), net.state.astype(np.float32), net.out, net.bias)
        return float((single.forward(x, 0) * weight).sum())

    keep = []
    single = L.Network(net.labels, net.inputs.astype(np.float32), net.state.astype(np.float32), net.out, net.bias)
    single.forward(x, 0, keep)
    d_in, d_state = L._backward(single, 0, x, keep, weight)
    for place in [(0, 0), (1, h), (2, 2 * h), (3, 2 * h + 1)]:
        net.state[0][place] += 1e-3
        up = loss()
        net.state[0][place] -= 2e-3
        slope = (up - loss()) / 2e-3
        net.state[0][place] += 1e-3
        assert slope == pytest.approx(d_state[place], abs=2e-2)
    place = (int(x[2, 1]), 2 * h + 2)
    net.inputs[0][place] += 1e-3
    up = loss()
    net.inputs[0][place] -= 2e-3
    assert (up - loss()) / 2e-3 == pytest.approx(d_in[place], abs=2e-2)


def plain_shares(net, raw):
    """Mean label probabilities of a text, byte by byte and unit by unit."""
    h = net.state.shape[1]
    total = [0.0] * len(net.labels)
    for begin in range(0, len(raw), L.STRETCH):
        part = list(raw[begin : begin + L.STRETCH].ljust(L.STRETCH, b"\0"))
        read = []
        for side, order in ((0, part), (1, part[::-1])):
            now, states = [0.0] * h, []
            for byte in order:
                gates = [
                    min(1.0, max(0.0, float(net.inputs[side][byte][k]) + sum(now[i] * float(net.state[side][i][k]) for i in range(h))))
                    for k in range(2 * h)
                ]
                reset = [gates[h + i] * now[i] for i in range(h)]
                new = [
                    min(1.0, max(-1.0, float(net.inputs[side][byte][2 * h + k]) + sum(reset[i] * float(net.state[side][i][2 * h + k]) for i in range(h))))
                    for k in range(h)
                ]
                now = [gates[k] * now[k] + (1 - gates[k]) * new[k] for k in range(h)]
                states.append(now)
            read.append(states if side == 0 else states[::-1])
        for t in range(min(L.STRETCH, len(raw) - begin)):
            both = read[0][t] + read[1][t]
            scores = [float(net.bias[c]) + sum(both[i] * float(net.out[i][c]) for i in range(2 * h)) for c in range(len(total))]
            top = max(scores)
            odds = [np.exp(s - top) for s in scores]
            total = [a + o / sum(odds) for a, o in zip(total, odds)]
    return [x / max(len(raw), 1) for x in total]


def test_shares_against_a_plain_network():
    rng, h = np.random.default_rng(4), L.HIDDEN
    net = L.Network(
        ["a", "b", "c"],
        rng.normal(0, 0.5, (2, 256, 3 * h)).astype(np.float32),
        rng.normal(0, 0.5, (2, h, 3 * h)).astype(np.float32),
        rng.normal(0, 1, (2 * h, 3)).astype(np.float32),
        rng.normal(0, 1, 3).astype(np.float32),
    )
    texts = [b"", b"a", "Größe über alles".encode(), bytes(range(200)), b"x" * (L.STRETCH + 1)]
    at = np.cumsum([0] + [len(t) for t in texts])
    got = L.pooled(net, np.frombuffer(b"".join(texts), np.uint8), at)
    for row, text in zip(got, texts):
        assert row == pytest.approx(plain_shares(net, text), abs=1e-4)


def test_every_language_is_learned(spark):
    """More labels than a small corpus of one alphabet could hide; the floor follows their number."""
    rng = random.Random(9)
    rows = [(i, "".join(chr(0x4E00 + 40 * (i % 70) + rng.randrange(3)) for _ in range(30)), f"l{i % 70:02d}") for i in range(210)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = L.fit(frame)
    assert net.labels == sorted({r[2] for r in rows})
    assert L.least_score(4) == pytest.approx(0.3, abs=1e-5) and L.least_score(1) < 1 and L.least_score(100) < 0.08
    assert all(L.least_score(n) > 1 / n for n in range(2, 200))


def test_stretches_cover_every_byte():
    texts = [b"", b"abc", bytes(range(256)) * 2, b"x" * L.STRETCH]
    at = np.cumsum([0] + [len(t) for t in texts])
    x, row, length = L.stretch(np.frombuffer(b"".join(texts), np.uint8), at)
    back = {i: b"" for i in range(len(texts))}
    for stretch, r, n in zip(x, row.tolist(), length.tolist()):
        back[r] += stretch[:n].tobytes()
    assert list(back.values()) == texts


def test_languages(spark):
    rng = random.Random(5)
    alphabets = {"aa": "abcdeo", "bb": "uvwxyzé"}
    rows = [(i, " ".join(words(rng, rng.randint(3, 120), alphabets[("aa", "bb")[i % 2]]))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "123 !?"), (203, "abc " * 4000)]
    frame = documents(spark, rows).selectExpr("*", "1 as score", "'q' as lang_pred")
    got = {r.doc_id: r for r in L.languages(frame).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    held = [i for i, _ in rows[:120] if got[i].held_out]
    assert sum(got[i].lang_pred == ("aa", "bb")[i % 2] for i in held) >= 0.9 * len(held)
    assert [(got[i].lang_pred, got[i].score) for i in (200, 201, 202)] == [("und", 0.0)] * 3
    assert got[203].lang_pred == "aa" and 0 < got[203].score <= 1
    assert L.languages(documents(spark, [])).count() == 0
    kept = L.in_some_language(frame, L.fit(frame))
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {200, 201, 202}


def test_features_of_plain_texts():
    texts = ["Two words.", "", "a a a b", "X1 #$ ÜBER\n\nx\nx"]
    raw = [t.encode() for t in texts]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    found = {n: c for n, c in zip(Q.FEATURES, Q.features(data, at).T.round(4).tolist())}
    assert found["words"] == np.log1p([2, 0, 4, 5]).round(4).tolist()
    assert found["distinct_words"] == [1.0, 0.0, 0.5, 0.8] and found["commonest_word"] == [0.5, 0.0, 0.75, 0.4]
    assert found["repeated_next"] == [0.0, 0.0, 0.5, 0.2] and found["repeated_lines"] == [0.0, 0.0, 0.0, 0.3333]
    assert found["lines"] == np.log1p([1, 0, 1, 3]).round(4).tolist() and found["bare_symbols"] == [0.0, 0.0, 0.0, 0.2]


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.boost(x, y)
    assert (1, 0) in model.pairs and ((model.score(x) >= 0.5) == y).mean() > 0.95


def labelled(spark, marks):
    return spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int, text string")


def test_quality(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(w + ("###" if i % 3 == 0 else "") for w in words(rng, rng.randint(5, 80)))) for i in range(240)]
    rows += [(500, None), (501, ""), (502, "Plain words here. " * 900)]
    marks = [(i, int(i % 3 != 0), 0, "x") for i, _ in rows[:240]] + [(None, 1, 1, ""), (3, None, 1, ""), (900, 1, 0, "")]
    got = {r.doc_id: r for r in Q.quality(documents(spark, rows), labelled(spark, marks)).collect()}
    held = [i for i, _ in rows[:240] if got[i].held_out]
    assert held == [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].predicted == (i % 3 != 0) for i in held) >= 0.95 * len(held)
    assert len(got) == 243 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert Q.quality(documents(spark, rows[:3]), labelled(spark, [])).first().score == 0.5
    assert Q.quality(documents(spark, []), labelled(spark, marks)).count() == 0


def test_toxicity(spark):
    rng = random.Random(7)
    bad = ["vilethug", "grimoaf", "rottenswine"]
    rows, marks = [], []
    for i in range(400):
        body = words(rng, rng.randint(5, 60))
        if i % 4 == 0:
            word = rng.choice(bad)
            if i % 16 == 0:
                word = word.replace("i", "1").replace("o", "0")
            elif i % 16 == 4:
                word = word.replace("e", "eeee")
            elif i % 16 == 8:
                word = " ".join(word)
            body.insert(rng.randint(0, len(body)), word)
        rows.append((i, " ".join(body)))
        marks.append((i, 1, int(i % 4 == 0), "x"))
    rows += [(900, None), (901, ""), (902, "calm " * 5000), (903, "! @ $ 1 2 3 " * 9)]
    got = {r.doc_id: r for r in T.toxicity(documents(spark, rows), labelled(spark, marks)).collect()}
    held = [i for i, _ in rows[:400] if got[i].held_out]
    assert held == [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert [got[i].predicted for i in (900, 901, 902)] == [0, 0, 0] and len(got) == 404
    assert T.toxicity(documents(spark, []), labelled(spark, marks)).count() == 0
    assert {r.predicted for r in T.toxicity(documents(spark, rows[:2]), labelled(spark, [])).collect()} <= {0, 1}


def test_decoding(spark):
    text = "the villain was stupid and the vile thug was grim but idle "
    model = T.language_model(documents(spark, [(1, text * 50)])).tolist()
    readings = {w: T.restore(w, model, {}) for w in ("v1le", "stuuuupid", "s.t.u.p.i.d", "gr!m", "stup1d")}
    assert readings == {"v1le": "vile", "stuuuupid": "stupid", "s.t.u.p.i.d": "stupid", "gr!m": "grim", "stup1d": "stupid"}
    assert np.exp(np.array(model)).sum(1) == pytest.approx(1)


def decoded(spark, plain, texts):
    """The plain and restored words of each text under a language model of ``plain``."""
    model = T.language_model(documents(spark, [(1, plain * 50)])).tolist()
    found = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        words_of = [data[a:b].tobytes().decode() for data, s, e, _ in T.tokens(raw, np.array([0, len(raw)]), model, {}) for a, b in zip(s, e)]
        found.append(" ".join(words_of))
    return found


PLAIN = "the villain was a stupid moron and i hate the vile thug so you are a grim idiot but an été is a café and i am idle "


def test_spaced_words_beside_single_letters(spark):
    texts = ["you are a m o r o n", "I h a t e", "the s t u p i d m o r o n", "was c a f é", "a é t é"]
    want = ["you are a moron", "i hate", "the stupid moron", "was café", "a été"]
    assert decoded(spark, PLAIN, texts) == want


def test_signs_at_the_edges_of_words(spark):
    plain = PLAIN + "what an ass you pass the class and the word "
    texts = ["a$$", "idio+", "!diot", "|diot", "@$$", "word!!!", "(word)", "*stupid*", 'the "stupid!",', "@moron", "!", "idiot."]
    want = ["ass", "idiot", "idiot", "idiot", "ass", "word", "word", "stupid", "the stupid", "moron", "!", "idiot"]
    assert decoded(spark, plain, texts) == want
