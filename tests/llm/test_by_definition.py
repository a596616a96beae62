"""The trained operators against loops that follow their definitions."""

import math

import numpy as np
import pytest

from lakeops.llm import language_id, quality_pu, toxicity


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def state_after(net, table, words, layer):
    """The state after reading words one by one, gate by gate."""
    h = [0.0] * toxicity.HIDDEN
    size = toxicity.HIDDEN
    for w in words:
        x, u = table[w, layer], [sum(h[i] * net.w["u"][layer][i][k] for i in range(size)) for k in range(3 * size)]
        keep = [sigmoid(x[k] + u[k]) for k in range(size)]
        reset = [sigmoid(x[size + k] + u[size + k]) for k in range(size)]
        new = [math.tanh(x[2 * size + k] + reset[k] * u[2 * size + k]) for k in range(size)]
        h = [keep[k] * h[k] + (1 - keep[k]) * new[k] for k in range(size)]
    return np.array(h)


def test_windows_by_loops_over_gates():
    rng, words, net = np.random.default_rng(2), toxicity.Words(), toxicity.Network.new()
    words.add([f"w{i}".encode() for i in range(25)])
    net.w["x"] *= 6
    table = net.table(words)
    lengths = [7, toxicity.SEGMENT + 70, 40]
    texts = [rng.integers(1, 26, n).astype(np.int32) for n in lengths]
    scores, _, count = net.windows(table, toxicity.Texts(texts))
    got = np.split(scores, np.cumsum(count)[:-1])
    for text, found in zip(texts, got):
        attend, value = [], []
        for t in range(len(text)):
            first = t // toxicity.SEGMENT * toxicity.SEGMENT
            end = min(len(text), first + toxicity.SEGMENT)
            ahead = state_after(net, table, text[max(0, first - toxicity.RUN_IN) : t + 1], 0)
            back = state_after(net, table, text[t : end + toxicity.RUN_IN][::-1], 1)
            attend.append(net.w["attend"][0] @ ahead + net.w["attend"][1] @ back)
            value.append(net.w["out"][0] @ ahead + net.w["out"][1] @ back)
        for i, score in enumerate(found):
            a, v = attend[i : i + 40], value[i : i + 40]
            weigh = [math.exp(x) for x in a]
            assert score == pytest.approx(sum(p * q for p, q in zip(weigh, v)) / sum(weigh) + net.w["b"][0], abs=2e-4)


def texts_of(rng, plain, bad, n, toxic):
    out = []
    for _ in range(n):
        words = [plain[i] for i in rng.integers(0, len(plain), 90)]
        if toxic:
            at = int(rng.integers(0, 70))
            words[at : at + 12] = [bad[i] for i in rng.integers(0, len(bad), 12)]
        out.append(" ".join(words))
    return out


def test_a_passage_is_found_wherever_it_stands():
    rng = np.random.default_rng(8)
    plain, bad = (["".join(map(chr, rng.integers(a, b, 7))) for _ in range(60)] for a, b in ((97, 110), (110, 123)))
    score = toxicity.Scorer(toxicity.fit(texts_of(rng, plain, bad, 150, False) + texts_of(rng, plain, bad, 150, True), np.repeat([0, 1], 150)))
    clean = [plain[i] for i in rng.integers(0, 60, 700)]
    passage = [bad[i] for i in rng.integers(0, 60, 12)]
    assert score([" ".join(clean)])[0] < 0.5
    slid = score([" ".join(clean[:at] + passage + clean[at:]) for at in range(0, 700, 9)])
    assert (slid >= 0.5).all() and slid.max() - slid.min() < 0.2


def test_long_labelled_texts_teach():
    rng = np.random.default_rng(9)
    plain, bad = (["".join(map(chr, rng.integers(a, b, 7))) for _ in range(60)] for a, b in ((97, 110), (110, 123)))
    long = [" ".join(texts_of(rng, plain, bad, 40, False) + t) for t in ([], texts_of(rng, plain, bad, 1, True))]
    # Both kinds are known from texts of over 25,000 characters only.
    texts = [long[0]] * 15 + [long[1]] * 15
    assert min(map(len, texts)) > 12_000
    score = toxicity.Scorer(toxicity.fit(texts, np.repeat([0, 1], 15)))
    low, high = score(long)
    assert low < 0.5 < high


def by_hand(text):
    """The features of a text: hashed byte trigrams by plain integers, and measures of style by counting."""
    raw = text.encode()
    grams = [0.0] * quality_pu.HASHED
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
        h ^= h >> 15
        grams[(h * 0x2C1B3C6D % 2**32) >> (32 - 11)] += 1
    grams = [math.log1p(g) for g in grams]
    norm = math.sqrt(sum(g * g for g in grams))
    grams = [g / (norm + 1e-9) for g in grams]
    words = raw.split()
    if not words:
        return grams + [0.0] * quality_pu.STATS

    def kind(b):
        c = chr(b)
        if b >= 128 or "a" <= c <= "z":
            return 4
        if c in " \t\n\x0b\x0c\r":
            return 1
        if b < 32 or b == 127:
            return 0
        return 2 if c.isdigit() else 3 if "A" <= c <= "Z" else 5 if c in ".,;:?'\"-" else 6

    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    style = [sum(kind(b) == k for b in raw) / len(raw) for k in range(1, 7)]
    style += [math.log1p(n) / 10, min(1.0, len(set(words)) / n**0.9), sum(x == y for x, y in zip(words, words[1:])) / n, 1 - len(set(zip(words, words[1:]))) / max(1, n - 1)]
    style += [1 - len(set(lines)) / len(lines), min(40, len(raw) / n) / 10, raw.count(b"|") / n, sum(w.isupper() for w in words) / n]
    return grams + style + [math.sqrt(s) for s in style]


GOOD = ["The river runs past the mill, and the miller's dog sleeps.", "Rain fell on the hills; later the sun came out.", "She wrote three letters before noon and posted none of them."]
BAD = ["BUY NOW!!! $$$ | | | click click click", "aaa aaa aaa aaa aaa aaa", "|||| 123 123 123 ####"]


def sample(rng, texts, n):
    return [" ".join(texts[i] for i in rng.integers(0, 3, rng.integers(1, 6))) for _ in range(n)]


def test_quality_scores_by_hand():
    rng = np.random.default_rng(4)
    trusted, web = sample(rng, GOOD, 120), sample(rng, GOOD, 160) + sample(rng, BAD, 80)
    model = quality_pu.fit(quality_pu.features(trusted + web), 120)
    texts = [*GOOD, *BAD, "", "é", "One\n\nline\nline\t\x07"]
    for text, score in zip(texts, model.score(quality_pu.features(texts))):
        z = model.bias
        for value, mean, scale, weight in zip(by_hand(text), model.mean.tolist(), model.scale.tolist(), model.weights.tolist()):
            z += min(6, max(-6, (value - mean) / scale)) * weight
        assert score == pytest.approx(sigmoid(max(-30, min(30, z))), abs=2e-3)
    assert (model.score(quality_pu.features(GOOD)) >= 0.7).all() and (model.score(quality_pu.features(BAD)) < 0.7).all()


def test_unseen_unlabelled_texts_are_accepted_at_the_prior():
    rng = np.random.default_rng(5)
    x = quality_pu.features(sample(rng, GOOD, 400) + sample(rng, GOOD, 700) + sample(rng, BAD, 300))
    order = np.concatenate([np.arange(400), 400 + rng.permutation(1000)])
    model = quality_pu.fit(x[order].copy(), 400)
    unseen = x[order][400:][::4]
    assert (model.score(unseen) >= quality_pu.THRESHOLD).mean() == pytest.approx(model.prior, abs=0.02)


def test_risk_steps_by_definition():
    """One step of a fit without momentum's memory is along the sign of the risk's slope."""
    rng = np.random.default_rng(6)
    p, u, prior = rng.normal(1, 1, (40, 3)).astype(np.float32), rng.normal(0, 1, (60, 3)).astype(np.float32), 0.4

    def risk(w, b):
        s = lambda x: 1 / (1 + np.exp(-(x @ w + b)))
        negative = -np.log(1 - s(u)).mean() + prior * np.log(1 - s(p)).mean()
        return -prior * np.log(s(p)).mean() + max(0.0, negative)

    w, b = quality_pu._fit(p, u, prior, epochs=1, batch=512, decay=0.0)
    b0, zero = math.log(prior / (1 - prior)), np.zeros(3)
    for k in range(3):
        e = np.eye(3)[k] * 1e-4
        slope = (risk(zero + e, b0) - risk(zero - e, b0)) / 2e-4
        assert w[k] == pytest.approx(-0.03 * np.sign(slope), rel=1e-3)
    # The bias starts at the prior's odds, where the risk is level.
    assert abs(risk(zero, b0 + 1e-4) - risk(zero, b0 - 1e-4)) / 2e-4 < 1e-6


@pytest.mark.parametrize("n", [2, 4, 9, 14])
def test_decoding_by_a_loop_over_codewords(n):
    rng = np.random.default_rng(n)
    names = [f"l{k:02d}" for k in range(n)]
    target = np.repeat(np.arange(n), 30)
    texts = ["".join(map(chr, 97 + (rng.integers(0, 5, 60) + 2 * k) % 26)) for k in target]
    x = language_id.features(texts)
    model = language_id.fit(x, names, target)
    place, share = language_id.decode(model, x[::7])
    for row, got, part in zip(x[::7], place, share):
        odds = []
        for k in range(n):
            loss = 0.0
            for bit in range(model.code.shape[1]):
                margin = float(row @ model.weights[:-1, bit] + model.weights[-1, bit])
                loss += math.log1p(math.exp(-margin * model.code[k, bit])) * float(model.trust[k, bit])
            odds.append(-loss * model.code.shape[1])
        assert got == max(range(n), key=lambda k: (odds[k], -k)) or sorted(odds)[-1] - sorted(odds)[-2] < 1e-3
        assert part == pytest.approx(1 / sum(math.exp(o - max(odds)) for o in odds), abs=5e-3)
    assert (language_id.decode(model, x)[0] == target).mean() > 0.9


def test_ties_go_to_the_first_language():
    x = np.zeros((40, language_id.HASHED), np.float32)
    model = language_id.fit(x, ["aa", "bb"], np.repeat([0, 1], 20))
    assert language_id.decode(model, x[:1])[0][0] == 0
