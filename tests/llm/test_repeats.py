"""Parts of operator 10 against brute force: anchors and the interval tree."""

import random

import numpy as np
import pytest

from millstone.llm import repeats as R

ALPHABETS = [b"a", b"ab", b"\x00\xff", bytes(range(256))]


def _text(rnd, alphabet, n):
    return bytes(rnd.choice(alphabet) for _ in range(n))


def _covered(contents, doc):
    """By brute force: bytes of each stretch in a window that a smaller doc holds."""
    least = {}
    for c, d in zip(contents, doc):
        for i in range(len(c) - R.LENGTH + 1):
            w = c[i: i + R.LENGTH]
            least[w] = min(least.get(w, d), d)
    out = []
    for c, d in zip(contents, doc):
        gone = np.zeros(len(c), bool)
        for i in range(len(c) - R.LENGTH + 1):
            if least[c[i: i + R.LENGTH]] < d:
                gone[i: i + R.LENGTH] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_interval_tree_finds_what_brute_force_finds(alphabet):
    rnd = random.Random(7)
    for _ in range(40):
        base = [_text(rnd, alphabet, 84) for _ in range(3)]
        made = set()
        for _ in range(rnd.randint(2, 25)):
            a = rnd.randint(0, 34)
            c = bytearray(rnd.choice(base)[a: rnd.randint(a + R.LENGTH, 84)])
            if rnd.random() < 0.5:
                c[rnd.randrange(len(c))] = rnd.choice(alphabet)
            made.add(bytes(c))
        contents = sorted(made, key=lambda _: rnd.random())
        doc = np.array([rnd.randint(0, 6) for _ in contents], np.int64)
        got = R.covered_stretches(contents, doc)
        for k, expected in enumerate(_covered(contents, doc)):
            gone = np.zeros(len(contents[k]), bool)
            for a, z in got.get(k, ()):
                gone[a:z] = True
            assert (gone == expected).all()


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("piece", [7, 64, R.SLICE])
def test_every_window_has_one_anchor_and_equal_windows_equal_ones(monkeypatch, alphabet, piece):
    monkeypatch.setattr(R, "SLICE", piece)
    rnd = random.Random(3)
    by_window = {}
    for _ in range(15):
        texts = [_text(rnd, alphabet, rnd.randint(0, 300)) for _ in range(5)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        edges = np.cumsum([0, *map(len, texts)])
        own = set(edges.tolist())
        seen = []
        for h, first, last in zip(*(x.tolist() for x in R.anchors(data, edges))):
            for s in range(first, last + 1):
                seen.append(s)
                assert by_window.setdefault(data[s: s + R.LENGTH].tobytes(), h) == h
                assert not own & set(range(s + 1, s + R.LENGTH))
        assert len(seen) == len(set(seen)) == sum(max(len(t) - R.LENGTH + 1, 0) for t in texts)


def test_no_texts():
    for texts in ([], [b""], [b"short"]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        assert all(len(x) == 0 for x in R.anchors(data, np.cumsum([0, *map(len, texts)])))
