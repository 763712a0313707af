"""Operator 2's lookups: brute force on small alphabets, large benchmarks, an
item's window that stands very often."""

import re
import time

import numpy as np
import pyarrow as pa

from millstone.llm import decontam
from millstone.llm.tokens import cut_words, slices


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))


def found(texts, p):
    """Per text (flags of hit words, names of items)."""
    out = []
    for a, b, data, off in slices(pa.array(texts, pa.large_string())):
        w = cut_words(data, off)
        hit, doc, win = decontam.find(w, p)
        lists = [x for *_, items in decontam._items(p, doc, win, b - a) for x in items.to_pylist()]
        out += [(hit[w.doc == d].tolist(), lists[d]) for d in range(b - a)]
    return out


def brute(text, items, window=10):
    w, hit, names = words(text), set(), set()
    for name, x in items:
        iw = words(x)
        for k in range(max(1, len(iw) - window + 1) if iw else 0):
            win = iw[k: k + window]
            for q in range(len(w) - len(win) + 1):
                if w[q: q + len(win)] == win:
                    names.add(name)
                    hit.update(range(q, q + len(win)))
    return [k in hit for k in range(len(w))], sorted(names)


def test_lookups_equal_brute_force():
    rng = np.random.default_rng(3)
    some = ["a", "b", "Ab", "ba", "é", "x1"]
    text = lambda n, k: " ".join(rng.choice(some[:k], n))
    for k in (1, 2, 3, 6):
        for _ in range(12):
            items = [(f"i{j}", text(int(rng.integers(0, 14)), k)) for j in range(int(rng.integers(0, 7)))]
            texts = [text(int(rng.integers(0, 40)), 6) for _ in range(6)] + ["", "..", "q q q"]
            texts += [f"{text(3, 6)} q {x} {text(2, 6)}" for _, x in items]
            assert found(texts, decontam.phrases(items)) == [brute(t, items) for t in texts]


def test_one_window_of_many_items_that_stands_very_often():
    """20,000 items of one word, a text of 20,000 such words: pairs of text and
    window come before items."""
    p = decontam.phrases([(f"{i:05}", "hot") for i in range(20_000)])
    (hit, names), (none, few) = found(["hot " * 20_000, "cold"], p)
    assert sum(hit) == 20_000 and len(names) == 20_000 and none == [False] and few == []


def test_batches_name_a_bounded_number_of_items(monkeypatch):
    monkeypatch.setattr(decontam, "NAMED", 5)
    items = [(f"{i:02}", "hot word") for i in range(4)]
    texts = ["hot word"] * 7 + ["no"] + ["a hot word, hot word"] * 2
    assert found(texts, decontam.phrases(items)) == [brute(t, items) for t in texts]


def test_cost_follows_the_text_not_the_benchmark():
    """A megabyte of text whose words all are the benchmark's: a benchmark of
    fifty times the windows may not cost a multiple."""
    rng = np.random.default_rng(5)
    vocab = np.array([f"w{i}" for i in range(20_000)])
    text = " ".join(rng.choice(vocab, 150_000))
    took = []
    for n in (20, 1000):
        items = [(f"i{j}", " ".join(rng.choice(vocab, 1010))) for j in range(n)]
        passage = " ".join(items[3][1].split()[5:30])
        p = decontam.phrases(items)
        best = 1e9
        for _ in range(3):
            start = time.process_time()
            (hit, names), = found([f"{text} {passage} {text[:100]}"], p)
            best = min(best, time.process_time() - start)
        assert names == ["i3"] and 25 <= sum(hit) < 60
        took.append(best)
    print(took)
    assert took[1] < 4 * took[0] + 0.5
