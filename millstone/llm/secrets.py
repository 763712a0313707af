"""Operator 3: secret scan with character Markov models (columns only).

Three base rules find spans by pattern.  On top, two first-order character
models - one of random strings, one of ordinary identifiers - are counted from
labelled tokens, and a token is reported as ``markov`` where the sum of its
log-likelihood ratios reaches ``MIN_LLR``.  The training tokens come from two
bounded samples of ``TRAIN_DOCS`` documents (by hash of id and text): of those
that hold a base span, however rare they are, and of all.  Their labels are the
base rules: values of base spans are random strings, all other tokens are
ordinary.  Every document is scanned whole.

Defined cases: NULL text is empty and has no span; a NULL id is kept; repeated
rows are scanned each on their own; an empty table gives no rows (and a model
without evidence, which is the zero ratio and reports nothing); other columns
are ignored.  Positions are code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.llm.common import table

#: kind -> (pattern, group holding the value, least length of the value)
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: cheap test that a text can hold a span of the kind at all
HINT = {
    "assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
#: a text that these match holds a base span
HOLDS = "|".join([BASE["assign"][0].removesuffix("+)") + "{6,})", HINT["access"], HINT["hex"]])
KINDS = [*BASE, "markov"]
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
TRAIN_TOKEN = r"[A-Za-z0-9+/_=-]{6,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
TRAIN_DOCS = 4000
MIN_LLR = 12.0
#: weight of the back-off, in observations
BACKOFF = 4.0

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, group: int, least: int, hint: str | None) -> Column:
    """Leftmost non-overlapping matches whose value is long enough, as
    (start, kind, end): starts are running sums of the lengths of the pieces
    between the matches and of the matches."""
    pat = F.lit(pattern)
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, pat, F.lit(0))
    value = F.regexp_extract_all(text, pat, F.lit(group)) if group else whole
    steps = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("gap"),
                         F.transform(whole, F.length).alias("len"),
                         F.transform(value, F.length).alias("val"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["len"]).alias("end"))
        return F.struct((start + x["len"]).alias("at"),
                        F.when(x["val"] >= least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    found = F.aggregate(steps, zero, step, lambda acc: acc["out"])
    if hint:
        found = F.when(text.rlike(hint), found).otherwise(F.array().cast(_SPAN))
    return found


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind as listed."""
    parts = [_spans(text, BASE[k][0], i, BASE[k][1], BASE[k][2], HINT[k]) for i, k in enumerate(BASE)]
    return F.array_sort(F.concat(*parts))


def _outside(spans: Column, base: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def _cut(text: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.substr(text, s["start"] + 1, s["end"] - s["start"]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample: int = TRAIN_DOCS) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of character pairs, as a
    flat table over ``ALPHABET``: of the second character given the first,
    backed off to how often the class has the second at all (a character that
    a class never uses is unlikely after any).  At most 2 x len(ALPHABET)^2
    counts reach the driver."""
    d = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = d.withColumn("h", F.xxhash64("i", "t"))
    picked = (d.select("h").distinct().orderBy("h").limit(sample)
              .union(d.where(F.col("t").rlike(HOLDS)).select("h").distinct().orderBy("h").limit(sample)).distinct())
    d = d.join(F.broadcast(picked), "h").withColumn("b", base_spans(F.col("t")))
    values = F.concat(
        F.filter(F.regexp_extract_all("t", F.lit(BASE["assign"][0]), F.lit(2)), lambda v: F.length(v) >= 16),
        _cut(F.col("t"), F.filter("b", lambda s: s["kind"] > 0)))
    plain = _cut(F.col("t"), _outside(_spans(F.col("t"), TRAIN_TOKEN, 3, 0, 6, None), F.col("b")))
    tokens = (d.select(F.explode(F.concat(
        F.transform(values, lambda v: F.struct(F.lit(1).alias("y"), v.alias("v"))),
        F.transform(plain, lambda v: F.struct(F.lit(0).alias("y"), v.alias("v"))))).alias("x"))
        .groupBy("x.y", "x.v").agg(F.count("*").alias("n")).where("length(v) > 1"))
    pairs = (tokens.select("y", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("v") - 1), lambda i: F.substr(F.col("v"), i, F.lit(2)))).alias("p"))
        .groupBy("y", "p").agg(F.sum("n").alias("n")).collect())
    k, at = len(ALPHABET), {c: i for i, c in enumerate(ALPHABET)}
    if not any(r[0] for r in pairs) or all(r[0] for r in pairs):
        return [0.0] * (k * k)
    counts = [[[0.0] * k for _ in range(k)] for _ in range(2)]
    for y, p, n in pairs:
        if p[0] in at and p[1] in at:
            counts[y][at[p[0]]][at[p[1]]] += n
    logs = []
    for c in counts:
        seen = [sum(row[b] for row in c) for b in range(k)]
        alone = [(n + 0.5) / (sum(seen) + 0.5 * k) for n in seen]
        logs.append([[math.log((n + BACKOFF * p) / (sum(row) + BACKOFF)) for n, p in zip(row, alone)] for row in c])
    return [logs[1][a][b] - logs[0][a][b] for a in range(k) for b in range(k)]


def _llr(token: Column, model: list[float]) -> Column:
    k = len(ALPHABET)
    cls = [max(ALPHABET.find(chr(c)), 0) for c in range(128)]
    code = F.transform(F.sequence(F.lit(1), F.length(token)),
                       lambda i: F.get(F.lit(cls), F.ascii(F.substr(token, i, F.lit(1)))))
    return F.aggregate(
        code, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda a, c: F.struct(c.alias("last"), (a["sum"] + F.when(a["last"] < 0, F.lit(0.0)).otherwise(
            F.get(F.lit(model), a["last"] * k + c))).alias("sum")),
        lambda a: a["sum"])


def _of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _joined(spans: Column) -> Column:
    names = F.lit(KINDS)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text",
         min_llr: float = MIN_LLR) -> DataFrame:
    """(id, base, spans): base rule spans, and all spans with the model's."""
    d = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    d = d.withColumn("base", base_spans(F.col("_t")))
    likely = F.filter(_outside(_spans(F.col("_t"), TOKEN, 3, 0, 16, TOKEN), F.col("base")),
                      lambda s: _llr(F.substr(F.col("_t"), s["start"] + 1, s["end"] - s["start"]), model) >= min_llr)
    return d.select(id_col, "base", F.array_sort(F.concat("base", likely)).alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    per_kind = [F.size(_of_kind("base", i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *per_kind, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))
