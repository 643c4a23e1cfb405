"""Whole scores against a step-by-step loop, gradients, counts against brute force, and that the model is a distribution."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lamina.llm import gru_lm, recurrent
from lamina.llm.recurrent import HIDDEN, Network
from tests.llm.conftest import ROWS


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def small_network(symbols=12, seed=0):
    """Classes of three and two own words, and two without any."""
    low, high = np.array([0, 3, 5, 5]), np.array([3, 5, 5, 5])
    net = Network(symbols, low, high, np.log([0.5, 0.3, 0.2, 0.6, 0.4]))
    rng = np.random.default_rng(seed)
    net.p = {k: (v + rng.normal(0, 0.4, v.shape)).astype(np.float32) for k, v in net.p.items()}
    return net


def sequence(n, symbols, seed):
    rng = np.random.default_rng(seed)
    classes = rng.integers(0, 4, n)
    places = np.where(classes == 0, rng.integers(0, 3, n), np.where(classes == 1, rng.integers(3, 5, n), -1))
    return rng.integers(0, symbols, n), classes, places


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def loop(net, reads, classes, places, h):
    """log P of what follows, word for word."""
    p, k, out = {n: v.astype(float) for n, v in net.p.items()}, HIDDEN, 0.0
    for x, c, at in zip(reads, classes, places, strict=True):
        z = sigmoid(p["p"][x, :k] + h @ p["u"])
        h = (1 - z) * h + z * np.tanh(p["p"][x, k:] + (z * h) @ p["g"])
        out += np.log(softmax(h @ p["w"] + p["b"])[c])
        if at >= 0:
            low, high = net.low[c], net.high[c]
            out += np.log(softmax(p["e"][low:high] @ h + net.share[low:high])[at - low])
    return out, h


def test_scores_equal_the_loop(monkeypatch):
    monkeypatch.setattr(recurrent, "STATES", 64)
    net = small_network()
    docs = [sequence(n, 12, n) for n in (1, 700, 3, 40, 41, 900, 5, 2000)]
    state = np.random.default_rng(9).normal(0, 0.5, HIDDEN).astype(np.float32)
    sums, last = net.score(docs, state)
    expected = [loop(net, *d, state if i == 0 else np.zeros(HIDDEN)) for i, d in enumerate(docs)]
    assert sums == pytest.approx([x for x, _ in expected], rel=1e-4) and last == pytest.approx(expected[-1][1], abs=1e-4)
    first, middle = net.score([tuple(a[:777] for a in docs[-1])])
    second, _ = net.score([tuple(a[777:] for a in docs[-1]), docs[0]], middle)
    assert first[0] + second[0] == pytest.approx(expected[-1][0], rel=1e-4)


def test_gradients(monkeypatch):
    """Backpropagation against differences, and that training lowers the loss."""
    net, found = small_network(), {}
    monkeypatch.setattr(net, "_update", lambda moments, grads, rate: found.update(grads))

    def whole(rows, sums):
        out = np.zeros_like(net.p["p"])
        out[rows] = sums
        return out

    reads, classes, places = sequence(24, 12, 3)
    starts = np.zeros((8, 3, 1), np.float32)
    starts[3, 1] = 1
    net._window(reads.reshape(8, 3), classes, places, 1 - starts, np.zeros((3, HIDDEN), np.float32), {}, 0.0, True)
    found["p"] = whole(*found["p"])

    def loss():
        total = 0.0
        for k in range(3):
            cut = [0, 3, 8] if k == 1 else [0, 8]
            for a, b in zip(cut, cut[1:], strict=False):
                total -= loop(net, reads.reshape(8, 3)[a:b, k], classes.reshape(8, 3)[a:b, k], places.reshape(8, 3)[a:b, k], np.zeros(HIDDEN))[0]
        return total / 24

    rng = np.random.default_rng(4)
    for name, value in net.p.items():
        for _ in range(5):
            at, old = tuple(rng.integers(0, n) for n in value.shape), None
            old = value[at]
            value[at] = old + np.float32(1e-2)
            up, value[at] = loss(), old - np.float32(1e-2)
            down, value[at] = loss(), old
            assert found[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-4)
    net = small_network()
    follows = (reads % 2, np.where(reads % 2 == 0, reads % 3, 3 + reads % 2))
    before = net.score([(reads, *follows)])[0][0]
    net.train(np.tile(reads, 20), np.tile(follows[0], 20), np.tile(follows[1], 20), np.zeros(480), epochs=20, streams=4, steps=16)
    assert net.score([(reads, *follows)])[0][0] > before + 5


def check(rows, got):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i is None, i or 0, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected


def test_counts_and_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = gru_lm.score_documents(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    fit = gru_lm.fit

    def without(*names):
        def blind(*args):
            net = fit(*args)
            for k in names:
                net.p[k] = net.p[k] * 0
            return net

        gru_lm.fit = blind
        try:
            return gru_lm.score_documents(docs).collect()
        finally:
            gru_lm.fit = fit

    mean = lambda rows, what: sum(r[what] for r in rows if r.held_out) / sum(r.n_tokens for r in rows if r.held_out)
    base, own = mean(got, "base_score"), mean(got, "score")
    shares, stateless = mean(without("e"), "score"), mean(without("w", "e"), "score")
    print(f"held out, log10 a token: {own:.3f}, fixed shares in classes {shares:.3f}, without the state {stateless:.3f}, base {base:.3f}")
    assert own > -3.94 and own > base + 0.15 and own > stateless + 0.2
    assert own > shares + 0.01  # what the state says of words within their class


def test_files_do_not_matter(spark):
    """One file or twenty-four: shards, and so scores, are about the same."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, many = (gru_lm.score_documents(docs.repartition(n)).where("held_out").selectExpr("sum(score) / sum(n_tokens) as s").first().s for n in (1, 24))
    assert abs(one - many) < 0.005


def test_few_shared_words(spark, monkeypatch):
    """Most words rare: their counts come from the join."""
    monkeypatch.setattr(gru_lm, "SHARED", 50)
    monkeypatch.setattr(gru_lm, "shared_words", lambda c: SHARED_WORDS(c, 50))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], gru_lm.score_documents(docs).collect())


SHARED_WORDS = gru_lm.shared_words


def test_the_model_is_a_distribution(monkeypatch):
    """In any state: words with a vector, shared words without, rare words and the unknown, and the end."""
    monkeypatch.setattr(gru_lm, "SYMBOLS", 40)
    shared = [(f"w{i}".encode(), 100 - i) for i in range(90)]
    v = gru_lm.Vocabulary(shared, [b"w1 w2 w3 w4", b"w50 w51 w52"], ends=3)
    mass = np.bincount(v.class_of[: v.rare], 10 ** v.share[: v.rare], v.classes)
    assert mass[mass > 0] == pytest.approx(1.0)
    assert len(set(v.class_of[v.rare :])) == gru_lm.CLUSTERS + 1
    net, rng = v.network(), np.random.default_rng(0)
    net.p = {k: (x + rng.normal(0, 0.5, x.shape)).astype(np.float32) for k, x in net.p.items()}
    # rare words of a cluster with counts 2 and 1 share 3 + 2 + 1 parts, the last one being the unknown's
    every = np.arange(v.end + 1)
    h = np.repeat(rng.normal(0, 1, (1, HIDDEN)).astype(np.float32), len(every), axis=0)
    p = np.exp(net.log_probs(h, v.class_of[every], v.place[every])) * np.where(every < v.top, 1.0, 10 ** v.share[every])
    rare = slice(v.rare, v.end)
    whole = p[: v.rare].sum() + sum((p[rare] * parts / 6).sum() for parts in (3, 2, 1)) + p[v.end]
    used = np.isin(np.arange(v.classes), v.class_of)
    unused = recurrent.Network._classes(net, h[:1], np.zeros(1, int))
    assert whole + (unused[1][0] / unused[2][0])[~used].sum() == pytest.approx(1.0, abs=1e-4)


@pytest.mark.parametrize("buffer", [1 << 21, 100])
def test_scores_against_brute_force(spark, monkeypatch, buffer):
    """The query's scores, summed word for word: shared and rare words, unknown ones, texts that take several buffers."""
    monkeypatch.setattr(gru_lm, "BUFFER", buffer)
    monkeypatch.setattr(gru_lm, "shared_words", lambda c: SHARED_WORDS(c, 60))
    model, fit = [], gru_lm.fit
    monkeypatch.setattr(gru_lm, "fit", lambda coded, v, tokens: (model.append((v, fit(coded, v, tokens))), model[-1][1])[1])
    rows = [(i, " ".join(f"w{(i * j * j) % 97}" for j in range(1, 4 + 9 * (i % 40)))) for i in range(120)] + [(500, None), (501, "never seen words")]
    rows += [(502, " ".join(f"w{(7 * j) % 80}" for j in range(3000)))]
    got = {r.doc_id: r.score for r in gru_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    (v, net), counts = model[0], Counter(w for i, t in rows if not held(i) for w in tokens(t) if w)
    masses = Counter()
    for w, n in counts.items():
        if w not in v.words:
            masses[v.cluster_of(w)] += n + 1
    for i, t in rows:
        ids, expected = [v.end], 0.0
        for w in tokens(t)[:-1]:
            ids.append(v.words[w] if w in v.words else v.rare + v.cluster_of(w))
            if w not in v.words:
                expected += math.log10((counts[w] + 1) / (masses[v.cluster_of(w)] + 1))
            elif v.words[w] >= v.top:
                expected += v.share[v.words[w]]
        ids = np.array([*ids, v.end])
        expected += loop(net, v.symbol[ids[:-1]], v.class_of[ids[1:]], v.place[ids[1:]], np.zeros(HIDDEN))[0] / math.log(10)
        assert got[i] == pytest.approx(expected, rel=1e-4)


def test_odd_and_empty(odd, nothing):
    got = gru_lm.score_documents(odd).collect()
    check(ROWS, got)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)
    assert gru_lm.score_documents(nothing).count() == 0


def test_nothing_to_learn_from(spark):
    i = next(i for i in range(100) if held(i))
    got = gru_lm.score_documents(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).first()
    assert (got.train_tokens, got.n_known, got.base_score, got.score) == (0, 0, 0.0, 0.0)


def test_fitted_on_all_training_words(spark, monkeypatch):
    """Clusters, letters and weights see every word, copies too, however many there are."""
    monkeypatch.setattr(gru_lm, "SAMPLE_WORDS", 100, raising=False)
    seen, learn = [], gru_lm.fit
    monkeypatch.setattr(gru_lm, "fit", lambda first, *rest: (seen.append(first.collect() if hasattr(first, "collect") else first), learn(first, *rest))[1])
    rows = [(i, "copy of one text " * 5 if i % 3 else " ".join(f"w{(i * j) % 900}" for j in range(30 + 40 * (i % 60)))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, "")], "doc_id long, text string").repartition(3)
    got = gru_lm.score_documents(docs).collect()
    training = [r for r in rows if not held(r[0])]
    words = sum(len(t.split()) for _, t in training)
    assert sum(len(r.symbols) // 2 if hasattr(r, "symbols") else len(r.split()) for r in seen[0]) == words
    assert sum(r.first for r in seen[0]) == len(training) + 1
    shared = [(w.encode(), n) for w, n in Counter(w for _, t in training for w in t.split()).items()]
    coded = gru_lm._coded(spark.createDataFrame(training, "doc_id long, text string"), shared, words)
    clusters = gru_lm.find_clusters(coded, shared)
    assert len(clusters.top_cluster) == len(shared) and len(clusters.keys) > 0
    assert all(math.isfinite(r.score) for r in got)
    copies = [r for r in got if r.doc_id is not None and r.doc_id % 3]
    assert sum(r.score for r in copies) > sum(r.base_score for r in copies)


def test_every_word_is_learned():
    """Streams that don't divide the words leave none out."""
    net = small_network()
    before = net.p["p"].copy()
    net.learn(np.arange(11), np.arange(11) % 4, np.full(11, -1), np.zeros(11), net.moments(), 0.01, streams=4, steps=32)
    assert (net.p["p"] != before).any(1)[:11].all()


def test_words_of_classes_are_learned_in_every_window():
    """What only one window has, whichever it is, moves its words' vectors."""
    reads, classes, places = sequence(32, 12, 3)
    for window in range(8):
        net = small_network()
        before, own = net.p["e"].copy(), np.where(np.arange(32) // 4 == window, places, -1)
        net.learn(reads, classes, own, np.zeros(32), net.moments(), 0.01, streams=1, steps=4)
        assert (net.p["e"] != before).any()


def test_words_are_looked_up_once():
    """Numbers of many words are those of each, and only different ones are asked for."""

    class Asked(gru_lm.Numbers):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    asked, words = [], [f"w{(i * i) % 37}".encode() for i in range(2000)]
    numbers = Asked({b"w0": 7, b"w1": 8}, 100, lambda new: np.array([int(w[1:]) for w in new]))
    assert numbers.settle(numbers.of_all(words)).tolist() == [{b"w0": 7, b"w1": 8}.get(w, int(w[1:])) for w in words]
    assert len(asked) == len(set(words))
    assert len(numbers.of_all([])) == 0


def test_only_classes_that_need_it_are_moved(monkeypatch):
    """Logits beyond what 32 bits hold, in one class: right scores, and other classes aren't moved by their greatest logit."""
    net, moved, powers = small_network(), [], recurrent._powers
    net.p["e"][:3] = 0
    net.p["e"][:3, 0] = 400, -300, 200
    doc = sequence(300, 12, 5)
    assert net.score([doc])[0][0] == pytest.approx(loop(net, *doc, np.zeros(HIDDEN))[0], rel=1e-3)
    monkeypatch.setattr(recurrent, "_powers", lambda logits, safe: (moved.append((logits.shape[1], safe)), powers(logits, safe))[1])
    net.learn(*doc, np.zeros(300), net.moments(), 0.01, streams=4, steps=75)
    assert (3, False) in moved and (2, True) in moved and all(np.isfinite(x).all() for x in net.p.values())


def test_a_window_groups_only_what_was_read(monkeypatch):
    """Errors are taken off where a word followed, so classes and words that followed aren't grouped."""
    net, grouped, sums = small_network(), [], recurrent._sums
    monkeypatch.setattr(recurrent, "_sums", lambda rows, at: (grouped.append(len(at)), sums(rows, at))[1])
    net.learn(*sequence(300, 12, 5), np.zeros(300), net.moments(), 0.01, streams=4, steps=75)
    assert grouped == [300]


def test_many_texts_are_cut_at_once():
    """As text by text: white space of every kind, bytes that aren't UTF-8, nothing at all."""
    rng = np.random.default_rng(2)
    few = np.array([9, 10, 11, 12, 13, 28, 31, 32, 32, 0, 14, 65, 90, 91, 97, 127, 133, 160, 194, 255], np.uint8)
    texts = [b"", b" ", b"\tA b\n", *(few[rng.integers(0, len(few), n)].tobytes() for n in range(200))]
    words, sizes = gru_lm.split_words(texts)
    assert words.to_pylist() == [w for t in texts for w in gru_lm._words(t)] and sizes.tolist() == [len(gru_lm._words(t)) for t in texts]
    assert [len(x) for x in gru_lm.split_words([])] == [0, 0]
    found = [b"", b"a", b"ab", b"abc", b"abcd", b"z" * 70, *words.to_pylist()]
    assert gru_lm.edges_of(found).tolist() == [gru_lm._edges(w) for w in found]


@pytest.mark.parametrize("most", [1 << 20, 20])
def test_a_task_adds_up_its_counts(spark, monkeypatch, most):
    """Texts in many parts: counts are right, also where they go out before the end, and else a word goes out once."""
    monkeypatch.setattr(gru_lm, "AT_ONCE", 200)
    monkeypatch.setattr(gru_lm, "COUNTS", most)
    rows = [(" ".join(f"w{(i * j) % 41}" for j in range(30)),) for i in range(60)] + [(None,), ("",)]
    docs = spark.createDataFrame(rows, "text string").coalesce(1)
    sent, frame = [], type(docs)
    monkeypatch.setattr(frame, "mapInArrow", lambda self, run, schema, plain=frame.mapInArrow: (sent.append(plain(self, run, schema)), sent[-1])[1])
    got = {bytes(r.word): r.n for r in gru_lm._count_words(docs).collect()}
    assert got == Counter(w for (t,) in rows for w in tokens(t) if w)
    if most > 1000:
        assert sent[0].count() == len(got)
