"""Operator 11 against whole texts encoded directly by both libraries."""

import hashlib
import json
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

import pytest

from millstone.llm import align

ODD = ["", None, "a", " a", "  a", "foo \n  bar", "foo\n\n  bar  ", "x  y　 z", "日本語テスト 😀😀 é", "a▁b c", "▁", " ", "   ",
       "\n", "<|endoftext|> <s> </s> <unk>", "e" * 3000, "\U0001F9FF\U0001FAE0 ͸ q", "it's we're  'll", "\t\ttab  tab \t x",
       "\x00 \x01a b", "ab​ cd  ", "x     y", "\r\n \r\nfoo", "̀ à b", "ﬁ ² Å ½ ㎏", "one two three", "one two three"]


def direct(path_a, path_b):
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path_a)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
    token = {i: x for x, i in json.load(open(path_a))["model"]["vocab"].items()}
    of = align.byte_level()

    def ends(ids, spell):
        parts = [spell(i) for i in ids]
        return list(accumulate(map(len, parts))), b"".join(parts)

    def encode(text):
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        end_a, raw_a = ends(a, lambda i: bytes(of[c] for c in token[i]))
        end_b, raw_b = ends(b, lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                            else sp.id_to_piece(i).replace("▁", " ").encode())
        if not text or {raw_a, raw_b} != {(" " + text).encode()}:
            return None
        groups, x, y = [], 0, 0
        for cut in sorted(set(end_a) & set(end_b)):
            p, q = bisect_right(end_a, cut), bisect_right(end_b, cut)
            groups.append((a[x:p], b[y:q]))
            x, y = p, q
        return len(a), len(b), groups
    return encode


def brute(rows, encode):
    seen = {t: encode(t or "") for _, t in rows}
    links = {t: Counter((p, q) for ga, gb in v[2] for p in ga for q in gb) for t, v in seen.items() if v}
    count = Counter(x for _, t in rows if seen[t] for x in links[t])
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for i, t in rows:
        if not seen[t]:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups = seen[t]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, a, b, len(groups), sum(links[t].values()), sum(m for x, m in links[t].items() if count[x] == best[x[0]]),
                    sum(m * count[x] for x, m in links[t].items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def files():
    return align.vocabularies()


def test_alignment_equals_direct_encoding(spark, files):
    sample = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = sample[:60] + [(10 ** 6 + i, t) for i, t in enumerate(ODD)] + [(None, "x y"), (None, "x y"), (1, " ".join(t or "" for _, t in sample[:12]))]
    d = spark.createDataFrame([(*r, "b", "p", 1) for r in rows], "doc_id long, text string, block string, pairs string, cell int")
    got = align.align_documents(d.repartition(3), *files)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, direct(*files)), key=str)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_text_ids_and_empty_tables(spark, files):
    d = spark.createDataFrame([("x", "one two"), (None, None)], "id string, body string")
    got = {r.id: r.n_a for r in align.align_documents(d, *files, id_col="id", text_col="body").collect()}
    assert got["x"] > 0 and got[None] == 0
    assert align.align_documents(d.limit(0), *files, id_col="id", text_col="body").count() == 0
    groups = {r.id: r.groups for r in align.alignments(d, *files, id_col="id", text_col="body").collect()}
    assert groups[None] == [] and groups["x"][0].start == 0 and groups["x"][-1].end == 8
    assert 4 in [g.end for g in groups["x"]] and sum(len(g.a) for g in groups["x"]) == got["x"]


def test_units_do_not_depend_on_what_was_met_before(files, monkeypatch):
    monkeypatch.setattr(align, "KNOWN", 4)
    al = align.Aligner(*files)
    fresh = align.Aligner(*files)
    for text in ["alpha beta gamma", "beta gamma delta epsilon", "alpha beta zeta eta", "alpha 日本 beta"]:
        u, inv, _ = al.texts([text.encode()])
        v, jnv, _ = fresh.texts([text.encode()])
        fresh.known = align.Known()
        assert [u.text[i] for i in inv] == [v.text[i] for i in jnv]
        assert [u.n_links[i] for i in inv] == [v.n_links[i] for i in jnv]


def test_byte_ends_refine_characters(files):
    for kind, path in zip("AB", files):
        tok = align.tokenizer(kind, path)
        for t in ODD:
            raw = (" " + (t or "")).encode()
            got = align.byte_ends(tok, raw.decode(), raw) if t else None
            if got:
                assert got[1].tolist()[-1] == len(raw) and (got[1] == tok.size[got[0]].cumsum()).all()


def test_a_blank_that_ends_a_text_is_encoded_with_it(spark, files):
    texts = ["foo ", "a b c ", "é ", "日本 ", "x\n y ", ". ", "a  ", "a \n", "a\u3000 ", "foo", " foo", None, "\u2581 "]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = sorted(map(tuple, align.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), *files).collect()))
    assert got == brute(rows, direct(*files))
    assert all(r[1] > 0 and r[2] > 0 for r in got[:11])
