"""Operator 13: sharding by balanced label propagation (columns only).

Documents are linked by what they share (by default the text).  Documents with
the same links are interchangeable, so the graph is kept as counts: a row (class,
label, n) says how many documents of a class of like links are in a shard.  A hot
text is one class of at most as many rows as there are shards, however many
documents hold it; documents without a link take no part and fill up at the end.

Start: linked documents are dealt round robin over the shards.  Every round

1. joins classes to their links and links to the counts of their labels: a
   class's pull towards each shard is the number of linked documents there;
2. lets the members of a class move to the open shard with the strongest pull,
   larger gains first;
3. admits, per pair of shards, no more documents than keep every shard within its
   capacity (an iteration over the matrix of wanted moves, as large as the square
   of the number of shards); a class that fits only in part moves in part.

A round without moves, or ``ROUNDS`` rounds, end the propagation.  Documents
without links then fill every shard to its capacity, so the law ``rows`` holds
exactly: counts differ by one at most.

Positions (of a class's members, of fillers, of slots) are running sums over
buckets that grow in number with the table, never over one task's rows.  What
the rounds read is written once to the shared checkpoint folder.

Defined cases: NULL and empty texts are equal, of size 1 and checksum 0; a NULL
link value (other than a text) links nothing; repeated rows are documents of
their own, with equal texts and thus linked; NULL ids are as good as others; an
empty table gives no rows; other columns pass through ``shard_documents`` if they
are listed in ``carry``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millstone.llm.common import staged, table

SHARDS = 8
ROUNDS = 12
#: buckets of a running sum: so many and one more per so many rows
BUCKETS = 256
BUCKET_ROWS = 1 << 17
#: salts by which a class's members are dealt at least
SALTS = 64


def running_sum(df: DataFrame, part: list[str], bucket: list[str], order: list[str], weight: str, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows before in ``part``, in
    the order of (bucket, order): a sum per bucket first, so that no task sorts
    more than a bucket."""
    by = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    start = (df.groupBy(*part, *bucket).agg(F.sum(weight).alias("_sum"))
             .withColumn("_start", F.sum("_sum").over(by.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)))
             .drop("_sum"))
    inner = Window.partitionBy(*part, *bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(start, [*part, *bucket])
            .withColumn(name, (F.coalesce("_start", F.lit(0)) + F.coalesce(F.sum(weight).over(inner), F.lit(0))).cast("long"))
            .drop("_start"))


def capacities(rows: int, shards: int) -> list[int]:
    """Documents of each shard under the law ``rows``."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def admitted(wanted: list[list[int]], load: list[int], capacity: list[int]) -> list[list[int]]:
    """The most of ``wanted`` moves (from, to) that leaves no shard above its
    capacity, found by cutting the moves into overfull shards until none is:
    moves only shrink, and without moves every shard fits."""
    k = len(load)
    flow = [row[:] for row in wanted]
    while True:
        over = {}
        for j in range(k):
            into = sum(flow[i][j] for i in range(k))
            excess = load[j] + into - sum(flow[j]) - capacity[j]
            if excess > 0 and into:
                over[j] = (into, max(into - excess, 0))
        if not over:
            return flow
        for j, (into, room) in over.items():
            left = room
            for i in range(k):
                share = min(flow[i][j], -(-flow[i][j] * room // into), left)
                left -= share
                flow[i][j] = share


def _tie(label) -> str:
    return f"pmod(xxhash64(class, {label}), 1000003L)"


def _numbers(values) -> str:
    return "array(" + ", ".join(f"{v}L" for v in values) + ")"


def _step(values: list[int], position: str) -> str:
    """SQL: the index of the interval of these lengths that holds a position."""
    ends, at = [], 0
    for v in values[:-1]:
        at += v
        ends.append(at)
    return " + ".join(f"cast({position} >= {e}L as int)" for e in ends) or "0"


def linked_classes(base: DataFrame, links: list[str], shards: int) -> tuple[DataFrame, DataFrame]:
    """``base`` has one row per document: ``class``, a salt and the link
    columns.  Returns (class, salt, n, before) of the classes whose documents
    are linked to others, and (class, link) of their links."""
    parts = base.groupBy("class", "salt", *links).agg(F.count("*").alias("n"))
    owned = parts.select("class", "salt", "n", F.explode(F.array_compact(F.array(*links))).alias("link"))
    # a link joins documents where it is held by two rows at least
    live = owned.groupBy("link").agg(F.sum("n").alias("n")).where("n > 1").select("link")
    ties = staged(owned.select("class", "link").distinct().join(live, "link"), "shards-ties")
    mine = parts.drop(*links).join(ties.select("class").distinct(), "class", "left_semi")
    w = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    return staged(mine.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))), "shards-members"), ties


def propagate(members: DataFrame, ties: DataFrame, rows: int, linked: int, shards: int,
              rounds: int = ROUNDS) -> tuple[DataFrame, list[dict]]:
    """Balanced label propagation: (class, label, n), and per round the moved
    documents and the linked pairs within shards."""
    capacity = capacities(rows, shards)
    buckets = BUCKETS + linked // BUCKET_ROWS
    sizes = members.groupBy("class").agg(F.sum("n").alias("n")).withColumn("bucket", F.pmod(F.xxhash64("class"), F.lit(buckets)))
    dealt = running_sum(sizes, [], ["bucket"], ["class"], "n", "at")
    state = dealt.select("class", "n", "at", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("label"))
    # of the positions at .. at + n - 1, those that are ``label`` modulo the shards
    state = state.select("class", "label", F.expr(
        f"cast((at + n + {shards - 1} - label) div {shards} - (at + {shards - 1} - label) div {shards} as long)").alias("n")).where("n > 0")
    state = staged(state, "shards-state")
    log: list[dict] = []
    load, open_to = capacities(linked, shards), [True] * shards
    for k in range(rounds):
        pull = (state.join(ties, "class").groupBy("link").agg(
            *[F.sum(F.when(F.col("label") == s, F.col("n")).otherwise(0)).alias(f"p{s}") for s in range(shards)]))
        pull = ties.join(pull, "link").groupBy("class").agg(*[F.sum(f"p{s}").alias(f"p{s}") for s in range(shards)])
        # the strongest open shard; ties go by the class, so that no shard is favoured
        best = F.expr("array_max(array(" + ", ".join(
            f"named_struct('p', p{s}, 't', {_tie(s)}, 's', {s})" for s in range(shards) if open_to[s]) + "))")
        here = F.expr("element_at(array(" + ", ".join(f"p{s}" for s in range(shards)) + "), label + 1)")
        # of two equal pulls that of a full shard is the weaker one
        closed = "array_contains(array(" + ", ".join(str(s) for s in [-1, *range(shards)] if s < 0 or not open_to[s]) + "), label)"
        moves = (state.join(pull, "class").withColumn("best", best).withColumn("here", here)
                 .where(f"best.s <> label and (best.p > here or best.p = here and best.t > if({closed}, -1L, {_tie('label')}))")
                 .select("class", "label", F.col("best.s").alias("to"), "n",
                         F.expr("-cast(floor(log2(best.p + 1)) as int)").alias("gain"),
                         F.pmod(F.xxhash64("class"), F.lit(buckets)).alias("bucket")))
        moves = staged(moves, "shards-moves")
        # as many numbers as pairs of shards
        wanted = [[0] * shards for _ in range(shards)]
        for r in moves.groupBy("label", "to").agg(F.sum("n").alias("n")).collect():
            wanted[r.label][r.to] = r.n
        flow = admitted(wanted, load, capacity)
        log.append({"round": k, "wanted": sum(map(sum, wanted)), "moved": sum(map(sum, flow)), "load": list(load)})
        if not log[-1]["moved"]:
            break
        room = "element_at(" + _numbers(x for row in flow for x in row) + f", label * {shards} + to + 1)"
        go = (running_sum(moves, ["label", "to"], ["gain", "bucket"], ["class"], "n", "at")
              .withColumn("m", F.expr(f"greatest(0L, least(n, {room} - at))")).where("m > 0"))
        change = go.select("class", F.explode(F.expr(
            "array(struct(label, -m as n), struct(to as label, m as n))")).alias("c")).select("class", "c.label", "c.n")
        state = staged(state.unionByName(change).groupBy("class", "label").agg(F.sum("n").alias("n")).where("n > 0"), "shards-state")
        came = [sum(flow[i][j] for i in range(shards)) for j in range(shards)]
        load = [load[s] + came[s] - sum(flow[s]) for s in range(shards)]
        # shards with room are open; if all are full, those that swapped
        open_to = [capacity[s] - load[s] > capacity[s] // 16 for s in range(shards)]
        if not any(open_to):
            open_to = [c > 0 for c in came]
    return state, log


def cut_pairs(state: DataFrame) -> DataFrame:
    """One row: linked pairs of classes' own members, and how many lie in
    different shards (of links that are the classes themselves)."""
    c = state.groupBy("class").agg(F.sum("n").alias("n"), F.sum(F.expr("cast(n as decimal(19,0)) * (n - 1)")).alias("within"))
    c = c.select((F.expr("cast(n as decimal(19,0)) * (n - 1)") / 2).alias("pairs"), (F.col("within") / 2).alias("within"))
    return c.agg(F.sum("pairs").alias("pairs"), F.sum(F.col("pairs") - F.col("within")).alias("cut"))


def placed(docs: DataFrame, shards: int, links: list[str] | None, id_col: str | None, text_col: str,
           carry: list[str] | None, rounds: int = ROUNDS) -> DataFrame:
    """(id, size, crc, shard, slot, carried) of every row of ``docs``;
    ``carried`` is a struct of the ``carry`` columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    values = [text if c == text_col else F.col(f"`{c}`").cast("string") for c in links or [text_col]]
    names = [f"l{k}" for k in range(len(values))]
    hashes = [F.when(v.isNotNull(), F.concat_ws(":", F.hex(F.xxhash64(F.lit(k), v)), F.hex(F.xxhash64(v, F.lit(~k)))))
              .alias(n) for k, (n, v) in enumerate(zip(names, values))]
    kept = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried") if carry else F.lit(None).cast("int").alias("carried")
    base = staged(docs.select(
        F.col(f"`{id_col}`").alias("id") if id_col else F.lit(None).cast("int").alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("crc"),
        *hashes, F.monotonically_increasing_id().alias("row"), kept), "shards-rows")
    rows = base.count()
    salts = SALTS + rows // BUCKET_ROWS
    buckets = BUCKETS + rows // BUCKET_ROWS
    # the class of rows with the same links; a row without links has no class
    base = base.withColumn("class", F.concat_ws("|", *names)).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    members, ties = linked_classes(base.select("class", "salt", *names), names, shards)
    linked = members.agg(F.sum("n")).first()[0] or 0
    if linked:
        state, _ = propagate(members, ties, rows, linked, shards, rounds)
        ends = state.groupBy("class").agg(
            *[F.sum(F.when(F.col("label") == s, F.col("n")).otherwise(0)).alias(f"c{s}") for s in range(shards)])
        load = dict(state.groupBy("label").agg(F.sum("n")).collect())      # as many rows as shards
    else:
        ends = members.select("class", *[F.lit(0).cast("long").alias(f"c{s}") for s in range(shards)]).limit(0)
        load = {}
    room = [c - load.get(s, 0) for s, c in enumerate(capacities(rows, shards))]
    # members of a class take its counts in order: the salt's start, then the row
    at = members.drop("n").join(ends, "class")
    inner = Window.partitionBy("class", "salt").orderBy("row")
    mine = (base.join(at, ["class", "salt"]).withColumn("at", F.col("before") + F.row_number().over(inner) - 1)
            .withColumn("shard", F.expr(" + ".join(
                f"cast(at >= {' + '.join(f'c{j}' for j in range(s + 1))} as int)" for s in range(shards - 1)) or "0")))
    free = base.join(members.select("class", "salt"), ["class", "salt"], "left_anti")
    free = (free.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))).withColumn("one", F.lit(1)))
    free = running_sum(free, [], ["bucket"], ["row"], "one", "at").withColumn("shard", F.expr(_step(room, "at")))
    cols = ["id", "size", "crc", "row", "shard", "carried"]
    both = (mine.select(*cols).unionByName(free.select(*cols))
            .withColumn("bucket", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(buckets))).withColumn("one", F.lit(1)))
    return running_sum(staged(both, "shards-placed"), ["shard"], ["bucket"], ["row"], "one", "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, links: list[str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", carry: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(id, size, text_crc32, shard, slot, carried columns): every row of
    ``docs`` in one of ``shards`` shards, rows with equal values in one of the
    ``links`` columns (default: the text) together where capacity allows."""
    out = placed(docs, shards, links, id_col, text_col, carry, rounds)
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("shard").cast("int").alias("shard"),
                      "slot", *[F.col(f"carried.`{c}`").alias(c) for c in carry or []])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, links: list[str] | None = None, text_col: str = "text") -> None:
    """The shards as Parquet folders ``shard=k`` with slot and document (all
    columns of ``docs``), in order of slot; many tasks write a shard, a range of
    slots each."""
    d = placed(docs, shards, links, None, text_col, docs.columns).select("shard", "slot", F.col("carried").alias("document"))
    d.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shard_documents(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))
