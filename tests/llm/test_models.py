"""Trained models against their definitions: the folded kernel machine, EM and the choice of languages, long sequences."""

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import language, recurrent, toxicity


def test_folded_weights_are_a_kernel_machine():
    """``decide`` lies in the span of the kernel against the landmarks, plus the bias, for units of any length and with gaps."""
    bad = ["worthless", "wretched", "stupidity", "nonsense"]
    good = ["garden", "window", "morning", "river", "letters", "bridge", "kitchen", "winter"]
    units, toxic, clean = bad + good, np.array([9.0] * 4 + [0.0] * 8), np.array([1.0] * 4 + [9.0] * 8)
    machine = toxicity.train(units, toxic, clean)
    asked = [*units, "wxorthless", "wooorthless", "gardenwindow", "abc", "stup", "nonsens", "rivers", "letter", "bridges", "zzz", "mornings", "wretchedly", "kitchens", "winters", "windowsill", "gardener", "worth", "less"]
    k = toxicity.kernel(asked, units)
    want = machine.decide(asked) - machine.bias
    beta, *_ = np.linalg.lstsq(k, want, rcond=None)
    assert len(asked) > len(units) and np.abs(k @ beta - want).max() < 1e-8
    found = dict(zip(asked, machine.decide(asked), strict=True))
    assert min(found[u] for u in bad) > max(found[u] for u in good)
    assert found["wxorthless"] > 0 > found["mornings"]


def loss(likelihood, share):
    return float(np.log(np.exp(likelihood) @ share).sum())


def test_proportions_against_a_grid():
    rng = np.random.default_rng(4)
    for n in (3, 40):
        x = rng.normal(-6, 2, (n, 2))
        share, value = language.proportions(x, steps=4000)
        best = max(loss(x, np.array([s, 1 - s])) for s in np.linspace(0, 1, 2001))
        assert abs(value - loss(x, share)) < 1e-6 and best - value < 0.01 and abs(share.sum() - 1) < 1e-9


def test_languages_against_all_sets():
    """The set chosen step by step is the best of all sets by penalised likelihood where languages are told apart."""
    for parts in ((60,), (40, 30), (30, 30, 30), (60, 1)):
        x = np.full((sum(parts), 4), -12.0)
        at = 0
        for k, n in enumerate(parts):
            x[at : at + n, k] = -6.0
            at += n
        price = language.PENALTY * (1 + np.log(len(x)))
        sets = [s for r in range(1, 5) for s in itertools.combinations(range(4), r)]
        best = max(sets, key=lambda s: language.proportions(x[:, s], 500)[1] - price * len(s))
        chosen, share = language.languages_of(x)
        assert tuple(sorted(chosen)) == best
        assert [*np.round(share * len(x))] == [n for n in parts[: len(chosen)]] or parts == (60, 1)


def test_ties_go_to_the_first_language():
    chosen, share = language.languages_of(np.full((5, 3), -4.0))
    assert chosen == [0] and share.tolist() == [1.0]


def test_scores_do_not_depend_on_the_batch():
    """Sequences beside others, longer than a window or empty, score as they do alone; slices of the output layer change nothing."""
    rng = np.random.default_rng(8)
    model = recurrent.Model([b"%d" % i for i in range(200)], np.arange(200, 0, -1).astype(float), 25_000, 900)
    trainer = recurrent.Trainer(model.flat, model.shape, 0.02)
    trainer.learn(rng.integers(0, 201, 20_000))
    model.flat = trainer.flat
    docs = [rng.integers(0, 201, n) for n in (0, 1, 31, 32, 33, 700, 64, 1, 0)]
    whole = model.scores(docs)
    alone = [model.scores([d])[0] for d in docs]
    assert np.abs(whole - alone).max() < 0.01 and whole[0] == 0 == whole[-1]
    p, states, targets = model.shape.view(model.flat), rng.uniform(-1, 1, (5000, recurrent.HIDDEN)).astype(np.float32), rng.integers(0, 201, 5000)
    got = recurrent._log_probabilities(p, model.shape, states, targets)
    for k in range(0, 5000, 617):
        cls = min(targets[k] // recurrent.CLASS, model.shape.classes) if targets[k] < 200 else model.shape.classes
        logits = states[k].astype(float) @ p["wc"] + p["bc"]
        want = logits[cls] - np.log(np.exp(logits).sum())
        if cls < model.shape.classes:
            own = slice(cls * recurrent.CLASS, (cls + 1) * recurrent.CLASS)
            inner = p["wo"][own].astype(float) @ states[k] + p["bo"][own]
            want += inner[targets[k] - cls * recurrent.CLASS] - np.log(np.exp(inner).sum())
        assert abs(got[k] - want) < 1e-3


def test_a_machine_travels_small():
    """F op4: 17 MB went to every disk with each job."""
    from pyspark import cloudpickle

    units = ["moron", "worthless", "日本語", "window", "garden", "paper", "morning", "ladder"]
    machine = toxicity.train(units, np.array([9.0] * 3 + [0.0] * 5), np.array([1.0] * 3 + [9.0] * 5), toxicity.alphabet(units))
    machine.calibration = np.arange(toxicity.N_FEATURES + 1.0)
    sent = cloudpickle.dumps(toxicity._Reader(machine))
    assert len(sent) < 1 << 18
    got = cloudpickle.loads(sent).machine
    assert (got.weights == machine.weights).all() and (got.letters == machine.letters).all() and (got.calibration == machine.calibration).all()
    assert got.bias == machine.bias and (got.decide(units) == machine.decide(units)).all()


def test_witnesses_are_the_units_that_speak_for_a_text(spark):
    bad, good = ["moron", "worthless"], ["window", "garden", "paper", "morning", "worth", "ladder"]
    machine = toxicity.train(bad + good, np.array([9.0] * 2 + [0.0] * 6), np.array([1.0] * 2 + [9.0] * 6))
    texts = ["a moron in the garden, worthless", "garden paper morning", "", None, "w.o.r.t.h.l.e.s.s window", "ladder paper"]
    flags = [1, 0, 1, 0, 1, 1]
    listed = [sorted({u for t in toxicity.tokens_of(x or "") for u in toxicity.units_of(t)}) for x in texts]
    got = toxicity._Reader(machine).witnesses(listed, flags)
    for all_units, toxic, units in zip(listed, flags, got, strict=True):
        value = dict(zip(all_units, machine.decide(all_units))) if all_units else {}
        above = [u for u in all_units if value[u] > 0]
        assert units == (above if toxic and above else [max(all_units, key=value.get)] if all_units else [])
    rows = spark.createDataFrame([(u, f) for u, f in zip(listed, flags, strict=True)] * 2, "units array<string>, toxic long")
    spoken = {r.unit: r.toxic for r in toxicity._witnesses(rows, machine).collect()}
    assert spoken["moron"] == 2 and spoken["worthless"] == 4 and spoken["morning"] == 0


def test_long_joined_tokens_and_alphabets():
    assert any("worthless" in u for u in toxicity.units_of("what.a.w-o-r-t-h-l-e-s-s.person"))
    for first, last in (("а", "я"), ("α", "ω"), ("ß", "ÿ")):
        letters = [chr(c) for c in range(ord(first), ord(last) + 1)]
        assert len(set(toxicity._codes(letters, 1, toxicity.alphabet(letters))[:, 0])) == len(letters)
    own = toxicity.alphabet(["日本" * 3, "語", "abc"])
    assert len({int(own[ord(c)]) for c in "日本語abcxyz"}) == 9 and toxicity.units_of("日本") == ["日本"]


def test_score_of_a_text_by_definition(spark):
    """Units, their highest value for a token, counts and shares, the logistic function: one step after the other."""
    bad, good = ["moron", "worthless", "zq"], ["window", "garden", "paper", "morning", "of", "ladder"]
    machine = toxicity.train(bad + good, np.array([9.0] * 3 + [0.0] * 6), np.array([1.0] * 3 + [9.0] * 6))
    machine.calibration = np.random.default_rng(2).normal(size=toxicity.N_FEATURES + 1)
    texts = ["a moron in the garden, moron", "garden of paper", "", None, "w.o.r.t.h.l.e.s.s window 12 !!", "m o r o n", "zq", "of " * 5_000]
    got = {r.doc_id: r.x_score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string"), machine).collect()}
    for k, text in enumerate(texts):
        values = []
        for token in toxicity.tokens_of(text or ""):
            units = toxicity.units_of(token)
            values.append(max((float(machine.decide([u])[0]) for u in units), default=-2.0))
        if not values:
            values = [-2.0]
            distinct = values
        else:
            distinct = list(dict(zip(toxicity.tokens_of(text), values)).values())
        above = sum(v > 0 for v in values)
        reach = [sum(v > c for v in distinct) for c in toxicity.CUTS]
        x = [max(-2.0, min(2.0, max(values))), math.log1p(above), above / len(values), *map(math.log1p, reach), math.log1p(len(distinct)), *(reach[i] / len(distinct) for i in (1, 3, 5)), 1.0]
        assert abs(got[k] - 1 / (1 + math.exp(-min(30, max(-30, sum(a * b for a, b in zip(x, machine.calibration))))))) < 1e-9


def _held_out_errors(spark, rows, labels):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    machine = toxicity.fit(docs, spark.createDataFrame([(i, 0, t) for i, t in enumerate(labels)], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.x_score >= toxicity.THRESHOLD for r in toxicity.score(docs, machine).collect()}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 3 == 1]
    return sum(got[i] != bool(labels[i]) for i in held) / len(held)


def test_insults_of_two_letters_beyond_ascii(spark):
    rng = np.random.default_rng(8)
    plain = ["".join(rng.choice(list("日本語中文字体学校先生時間"), 3)) for _ in range(150)]
    labels = [int(i % 3 == 0) for i in range(600)]
    rows = [" ".join([*rng.choice(plain, 25), *(["獄卒"] if t else [])]) for t in labels]
    assert _held_out_errors(spark, rows, labels) <= 0.01


def test_words_that_each_tell_a_little(spark):
    """A stem that clean texts have once now and then, and toxic ones in several forms."""
    rng = np.random.default_rng(9)
    plain = ["".join(rng.choice(list("日本語中文字体学校先生時間"), 3)) for _ in range(150)]
    forms = ["魔鬼" + x for x in "日本語中文字"]
    labels = [int(i % 3 == 0) for i in range(600)]
    rows = [" ".join([*rng.choice(plain, 25), *(rng.choice(forms, 5) if t else rng.choice(forms, 1) if i % 4 == 0 else [])]) for i, t in enumerate(labels)]
    assert _held_out_errors(spark, rows, labels) <= 0.02


def test_long_sequences_share_the_output_layer(monkeypatch):
    """F op2: each window of a few long sequences went through the output layer, all classes, by itself."""
    rng = np.random.default_rng(3)
    model = recurrent.Model([b"%d" % i for i in range(200)], np.arange(200, 0, -1).astype(float), 25_000, 900)
    docs, calls, own = [rng.integers(0, 201, n) for n in (3000, 5, 2000, 0)], [], recurrent._log_probabilities
    monkeypatch.setattr(recurrent, "_log_probabilities", lambda *a: calls.append(len(a[3])) or own(*a))
    together = model.scores(docs)
    assert calls == [5005]
    monkeypatch.setattr(recurrent, "SCORED_ROWS", 1)
    assert np.abs(model.scores(docs) - together).max() < 0.01 and len(calls) == 1 + 94


def test_words_of_many_texts_equal_those_of_each():
    texts = ["A b\tÄc  a\n", None, "", " \r\n ", "x\x0by\x0cz\x1cq\x85w\xa0e r\x00", "  lead", "KK É"] * 3
    for part in (pa.array(texts), pa.array(texts).slice(2, 9), pa.array(["a"] * 3), pa.array([None, " "], pa.string()), pa.array([], pa.string())):
        each = [recurrent.tokens_of(t) for t in part.to_pylist()]
        words, sizes = recurrent.words_of(part)
        assert words.to_pylist() == [w for t in each for w in t[:-1]] and sizes.tolist() == [len(t) - 1 for t in each]
        known = pa.array([b"a", b"\n", b"lead"], pa.binary())
        at = {w: i for i, w in enumerate(known.to_pylist())}
        got, sizes = recurrent.places_of(part, known, 3, 4)
        assert got.tolist() == [x for t in each for x in [4, *(at.get(w, 3) for w in t)]] and sizes.tolist() == [len(t) + 1 for t in each]
    assert recurrent.places_of(pa.array(["a", "", "lead a"]), known)[0].tolist() == [0, 1, 1, 2, 0, 1]
    with pytest.raises(KeyError):
        recurrent.places_of(pa.array(["b"]), known)


def test_sums_of_runs_of_rows():
    rng = np.random.default_rng(5)
    for sizes in ([1], [40], [1, 17, 16, 3, 200, 1, 2], rng.integers(1, 30, 60)):
        rows, starts = rng.standard_normal((3, int(np.sum(sizes)), 4)), np.cumsum(sizes) - sizes
        assert np.allclose(recurrent._sums(rows, starts), np.add.reduceat(rows, starts, axis=1))
