"""Operator 12 against counting in Python."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

from millstone.llm import phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, p), a in cand.items():
        if len(p) == 3:
            for q in (p[:2], p[1:]):
                longer[lang, q] = max(longer[lang, q], a)
    out = {}
    for (lang, p), a in cand.items():
        if len(p) == 2 and 100 * longer[lang, p] >= 50 * a:
            continue
        cut = min(((10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))))
        out.setdefault(lang, []).append((-cut[0], -a, " ".join(p).encode(), f[lang, p[:cut[1]]], f[lang, p[cut[1]:]]))
    return sorted((lang, k, p.decode(), -a, x, y, n[lang], -s)
                  for lang, v in out.items() for k, (s, a, p, x, y) in enumerate(sorted(v)[:top], 1))


def corpus(seed=5, docs=120):
    rnd = random.Random(seed)
    w = ["Alpha", "beta", "GAMMA", "é", "日本", "x" * 400, "a'b", "%", "_", "\\t", " ", "c\x00d"]
    sep = [" ", "  ", "\t", ". ", ", ", "\n", " \x0b ", "? "]
    text = lambda n: "".join(rnd.choices(w, range(len(w), 0, -1))[0] + rnd.choices(sep, [20, 2, 2, 1, 1, 1, 1, 1])[0] for _ in range(n))
    rows = [(rnd.choice(["en", "fr", None, ""]), text(rnd.randint(0, 60))) for _ in range(docs)]
    return rows + [("en", None), (None, ""), ("de", "once only")] + [("hot", "the the the the cat")] * 40 + [("one", "the cat " * 4000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", "l", 1, "b") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, prefix string, line string, cell int, block string")


def test_phrases_equal_counting(spark, monkeypatch):
    rows = corpus()
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows)).collect())) == brute(rows)
    # a few rows per block, few results, one segment a cell: the same rule
    monkeypatch.setattr(phrases, "CELLS_PER_SEGMENT", 1)
    got = phrases.collocations(frame(spark, rows).repartition(7), min_count=4, top=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 5)


def test_phrases_sql_agrees(spark):
    rows = [(lang, t) for lang, t in corpus(6) if "\x00" not in (t or "")]
    documents = pd.DataFrame(rows, columns=["lang", "text"])  # noqa: F841
    assert sorted(map(tuple, duckdb.sql(phrases.OP12_SQL).fetchall())) == brute(rows)


def test_phrases_without_candidates_or_languages(spark):
    d = frame(spark, [("en", "a b c")])
    assert phrases.collocations(d).count() == 0
    assert phrases.collocations(d.limit(0)).count() == 0
    got = phrases.collocations(frame(spark, [("en", "a b")] * 6 + [("fr", "a b")] * 6), lang_col=None).collect()
    assert [(r.lang, r.phrase, r.a, r.n, r.score) for r in got] == [("und", "a b", 12, 24, 1000000)]


def test_scores_beyond_64_bits(spark):
    a, x, y = 9 * 10 ** 12 + 7, 10 ** 13 + 9, 9 * 10 ** 12 + 11
    d = spark.createDataFrame([(a, x, y)], "a long, l long, r long")
    assert d.select(phrases._score("a", "l", "r")).first()[0] == 10 ** 6 * a * a // (x * y)


def test_a_hash_shared_by_phrases_only_lets_more_through(spark, monkeypatch):
    rows = corpus(7, 40)
    monkeypatch.setattr(phrases, "_SHORT", np.uint64(58))            # nearly every entry shares its hash
    monkeypatch.setattr(phrases, "_cell_ends", lambda keys, cells: [0] + [len(keys)] * cells)
    langs, texts = zip(*[("und" if x is None else x, (t or "").encode()) for x, t in rows])
    p = phrases.Phrases(list(langs), list(texts))
    keys, n = p.counted()
    often = keys[n >= 10]
    part = phrases._stripes(p, often, 8, 8)[0]
    count = Counter()
    for r in part.to_pylist():
        lines = phrases.zstandard.ZstdDecompressor().decompress(r["lines"]).decode().split("\n")
        for line, f in zip(lines, phrases._unpack(r["n"], np.uint32).tolist()):
            count[r["lang"], line] += f
    true = Counter()
    for lang, t in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    true["und" if lang is None else lang, " ".join(w[i:i + k - 1]) + "\t" + w[i + k - 1]] += 1
    assert all(count[x] == f for x, f in true.items() if f >= 10)
    assert all(true[x] == f for x, f in count.items() if x[1] != "\t")
