"""Mixing sources to target weights by pivotal dependent rounding in a reduction tree of DataFrame operations.

A source's target divided by its size is the expected number of copies of each of its documents. The whole part is taken for
certain; the fraction is a probability. Two fractional documents i, j of a source meet: mass moves between them, weighted by
their sizes so that the sum of size times probability stays, at random in one of two directions with the odds that keep both
expectations, until one of them is 0 or 1. The other, if still fractional, meets the next. Blocks of about `block` documents
are folded this way in parallel, each leaves at most one fractional document, and the residues are folded again in blocks, in
rounds that grow with the logarithm of the number of documents. The last residue of a source is rounded by chance. So a
source's taken size differs from its target by less than one document, whatever its share of the rows.

Only DataFrame functions run here. All chances are hashes of the document and the round, so reruns agree.

Defined results: null text and text without words have size 0 and take 0; a null source is a source of its own, last in order;
rows that repeat (also by doc_id) are mixed as documents of their own; sources without words get target 0; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import WORD
from waymark.session import cut

#: A document is a whole number (0 or 1) once its probability is this near to one.
SNAP = 1e-9


def word_count(text: str) -> Column:
    """Number of maximal runs outside the six whitespace characters; 0 for null."""
    squeezed = F.regexp_replace(F.col(text), r"[\x20\x09-\x0D]+", " ")
    trimmed = F.trim(squeezed)
    spaces = F.length(trimmed) - F.length(F.translate(trimmed, " ", ""))
    return F.coalesce(F.when(trimmed != "", spaces + 1).otherwise(0), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): sources by code point, null last, weigh `weights` in turn and
    share the sum of all sizes; a target stops at `most` times its source's size and the excess is shared again by weight."""
    spark = sizes.sparkSession
    ordered = sizes.orderBy(F.col("source").asc_nulls_last())
    # Row numbers without one task holding all sources: sorted partitions, their counts, then offsets.
    placed = cut(ordered.select("source", "source_size", F.monotonically_increasing_id().alias("mid")))
    placed = placed.select("source", "source_size", F.shiftright("mid", 33).alias("part"), F.col("mid").bitwiseAND((1 << 33) - 1).alias("nth"))
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for part, n in counts:
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "part long, before long")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = cut(placed.join(F.broadcast(offsets), "part").select(
        "source", F.col("source_size").cast("double").alias("size"), "source_size",
        F.element_at(cycle, ((F.col("nth") + F.col("before")) % len(weights) + 1).cast("int")).alias("weight")))
    level, cap = 0.0, F.col("size") * most
    while True:  # each turn caps at least one more source, or ends
        over = (F.col("weight") * level >= cap) if level else F.lit(False)
        got = ranked.agg(F.sum("size").alias("all"), F.sum(F.when(over, cap)).alias("held"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if not got["all"] or not got["open"]:
            break
        new = (got["all"] - (got["held"] or 0.0)) / got["open"]
        if new <= level * (1 + 1e-12):
            break
        level = new
    return ranked.select("source", "source_size", F.least(F.col("weight") * level, cap).alias("target"))


def _fold_block(items: Column) -> Column:
    """Folds (id, size, p, toss) items in order; returns the finished (id, copies) and the fractional rest (id null if none)."""
    settled = "array<struct<id:string,copies:int>>"
    item = "struct<id:string,size:double,p:double>"

    def step(state: Column, x: Column) -> Column:
        a, b, wa, wb = state["open"]["p"], x["p"], state["open"]["size"], x["size"]
        # Up: the open one gains and x loses as much mass as either allows; down: the other way round.
        up, down = F.least((1 - a) * wa, b * wb), F.least(a * wa, (1 - b) * wb)
        shift = F.when(x["toss"] * (up + down) < down, up).otherwise(-down)
        pa, pb = a + shift / wa, b - shift / wb

        def whole(p: Column) -> Column:
            return (p < SNAP) | (p > 1 - SNAP)

        def entry(i: Column, p: Column) -> Column:
            return F.struct(i.alias("id"), F.when(p > 0.5, 1).otherwise(0).alias("copies"))

        def pending(i: Column, w: Column, p: Column) -> Column:
            return F.struct(i.alias("id"), w.alias("size"), p.alias("p"))

        nothing = F.lit(None).cast(item)
        ia, ib = state["open"]["id"], x["id"]
        met = F.struct(F.struct(pending(ia, wa, pa).alias("a"), pending(ib, wb, pb).alias("b")).alias("pair"))

        def after(m: Column) -> Column:
            qa, qb = m["pair"]["a"], m["pair"]["b"]
            wha, whb = whole(qa["p"]), whole(qb["p"])
            new = F.filter(F.array(F.when(wha, entry(qa["id"], qa["p"])), F.when(whb, entry(qb["id"], qb["p"]))), lambda e: e.isNotNull())
            rest = F.when(wha & whb, nothing).when(wha, qb).otherwise(qa)
            return F.struct(rest.cast(item).alias("open"), F.concat(state["done"], new).cast(settled).alias("done"))

        started = F.struct(pending(ib, wb, b).cast(item).alias("open"), state["done"].alias("done"))
        return F.when(state["open"].isNull(), started).otherwise(F.transform(F.array(met), after)[0])

    empty = F.struct(F.lit(None).cast(item).alias("open"), F.array().cast(settled).alias("done"))
    return F.aggregate(items, empty, step)


def pivotal_round(items: DataFrame, group: str, block: int = 64) -> DataFrame:
    """(id, copies) for items (id string, unique; `group`; size > 0; p in (0, 1)): copies is 0 or 1."""
    spark = items.sparkSession
    left = cut(items.select(group, "id", F.col("size").cast("double").alias("size"), "p"))
    done, turn = [], 0
    while True:
        counts = left.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
        top = counts.agg(F.max("n")).first()[0] or 0
        if top <= 1:
            break
        counts = cut(counts)
        blocks = F.ceil(F.col("n") / block)
        dealt = left.join(counts, left[group].eqNullSafe(counts[group])).select(
            left[group], (F.pmod(F.xxhash64("id", F.lit(turn)), blocks)).alias("block"),
            F.struct(F.xxhash64("id", F.lit(turn), F.lit("order")).alias("rank"), "id", "size", "p",
                     (F.pmod(F.xxhash64("id", F.lit(turn), F.lit("toss")), F.lit(1 << 30)) / float(1 << 30)).alias("toss")).alias("item"))
        folded = cut(dealt.groupBy(group, "block").agg(F.array_sort(F.collect_list("item")).alias("items")).select(
            group, _fold_block(F.col("items")).alias("r")))
        done.append(folded.select(F.explode("r.done").alias("d")).select("d.id", "d.copies"))
        left = folded.filter("r.open is not null").select(group, "r.open.id", "r.open.size", "r.open.p")
        turn += 1
    chance = F.pmod(F.xxhash64("id", F.lit("last")), F.lit(1 << 30)) / float(1 << 30)
    done.append(left.select("id", (chance < F.col("p")).cast("int").alias("copies")))
    return reduce(DataFrame.unionByName, done)


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken), one row per row of `docs`."""
    sized = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size")))
    # Rows that repeat are told apart by their number among their equals, counted rather than ranked.
    same = cut(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times")))
    rows = same.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times").withColumn(
        "id", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size").cast("string"), F.col("nth").cast("string"),
                          F.hex(F.coalesce(F.col("source"), F.lit("\u0000null")))))
    goal = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    share = cut(rows.join(goal, rows["source"].eqNullSafe(goal["source"])).select(
        "id", "doc_id", rows["source"], "size", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")))
    whole = F.floor(F.col("rate") + SNAP)
    part = F.greatest(F.col("rate") - whole, F.lit(0.0))
    open_rows = share.filter((F.col("size") > 0) & (part > SNAP)).select("source", "id", "size", part.alias("p"))
    chosen = pivotal_round(open_rows, "source")
    out = share.join(chosen, "id", "left").withColumn("copies", (whole + F.coalesce(F.col("copies"), F.lit(0))).cast("int"))
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")
