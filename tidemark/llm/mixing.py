"""Mixing sources to target weights by entropy balancing: how often each document enters a training mix.

A document of ``size`` words enters at a rate between 0 and ``most``. Among all rates that give each source its target
of words, entropy balancing takes those with the least relative entropy to taking every document at ``most / 2``. The
dual of that problem is convex, with one multiplier for each token constraint, and its optimum is an exponential tilt:

    rate / (most - rate) = exp(theta[source] * size / mean size of the source).

Newton iterations find theta. A rate depends on source and size alone, so documents are first counted by (source, size),
an exact summary with at most sqrt(2 * words of the source) rows for each source; each iteration is one aggregate over
that table, in which gradient and curvature of all sources are summed at once. Sums are decimal, so the order in which
tasks finish changes nothing and reruns agree to the last bit. Steps stay inside a bracket that shrinks; where Newton
leaves it, it is halved.

Rates are rounded to whole copies by diffusing the rounding error, in words, from the longest documents of a source to
its shortest: each (source, size) gets the number of copies nearest to what its rate asks for plus what is still owed,
so a source ends within half of its shortest documents' size of its target where its documents allow that at all. The
copies of a (source, size) are dealt evenly; which documents get one more is decided by a hash of the key. No task sees
all documents of a source or size: places in hash order come from ``ranks.ranked``.

Targets: sources in order of code point, null last, have ``weights`` in turn and share ``share`` times all words; a
target ends at ``most`` times its source's size, and the excess goes to the others by weight until none is above.

Defined results. A null text has size 0; documents of size 0 have copies by their rate, too, and take no words. Null
sources are one source. Repeated rows and repeated keys are documents of their own. A source without words has target
0. An empty table gives no rows. Other columns are ignored whatever their names. Texts are read once, whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.ranks import joined, kept, ranked

#: What separates words: space, and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
_EXACT = "decimal(38,9)"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, mean, target of ``sources`` (source, source_size, mean)."""
    if sources.isEmpty():
        return sources.withColumn("target", F.lit(0.0))
    placed = ranked(sources.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"])
    turn = F.array(*[F.lit(float(w)) for w in weights])[(F.col("rank") % len(weights)).cast("int")]
    placed = kept(placed.select("source", "source_size", "mean", turn.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("limit")), "weighed")
    budget = share * float(placed.agg(F.sum("source_size")).first()[0])
    level, full = 0.0, -1
    while True:
        # What one unit of weight gets; sources at their limit keep the limit, so the level only rises.
        is_full = F.col("limit") <= F.lit(level) * F.col("weight")
        at = placed.agg(F.count_if(is_full).alias("n"), F.sum(F.when(is_full, F.col("limit")).cast(_EXACT)).alias("taken"), F.sum(F.when(~is_full, F.col("weight"))).alias("weight")).first()
        if at.n == full or not at.weight:
            break
        full, level = at.n, (budget - float(at.taken or 0)) / at.weight
    reached = F.least("limit", F.lit(level) * F.col("weight")) if at.weight else F.col("limit")
    return placed.select("source", "source_size", "mean", reached.alias("target"))


def _rate(theta: Column, most: float) -> Column:
    return F.lit(most) / (F.lit(1.0) + F.exp(-theta * F.col("size") / F.col("mean")))


def balanced(counts: DataFrame, wanted: DataFrame, most: float, precision: float = 1e-7, rounds: int = 80) -> DataFrame:
    """source, theta: the multipliers at which the rates of ``counts`` (source, size, n) give ``wanted``'s targets.

    Null where every document is taken at ``most`` or the source has no words.
    """
    open_ = (F.col("target") < F.col("source_size") * F.lit(most)) & (F.col("source_size") > 0)
    none = F.lit(None).cast("double")
    now = kept(wanted.where(open_).select("source", "source_size", "mean", "target", F.lit(0.0).alias("theta"), none.alias("low"), none.alias("high")), "duals")
    for _ in range(rounds):
        met = joined(counts, now, ["source"])
        rated = met.withColumn("rate", _rate(F.col("theta"), most))
        given = F.col("n") * F.col("size") * F.col("rate")
        bent = given * F.col("size") / F.col("mean") * (1 - F.col("rate") / F.lit(most))
        sums = rated.groupBy("source").agg(F.sum(given.cast(_EXACT)).cast("double").alias("given"), F.sum(bent.cast(_EXACT)).cast("double").alias("slope"))
        stepped = joined(now, sums, ["source"]).select(
            "source", "source_size", "mean", "target", "theta", (F.col("given") - F.col("target")).alias("over"), "slope",
            F.when(F.col("given") <= F.col("target"), F.col("theta")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("given") > F.col("target"), F.col("theta")).otherwise(F.col("high")).alias("high"),
        )
        # A step goes no further than twice as far from zero; outside the bracket the middle is taken.
        reach = 2.0 + F.abs("theta")
        newton = F.when(F.col("slope") > 1e-9, F.greatest(F.least(F.col("over") / F.col("slope"), reach), -reach)).otherwise(F.when(F.col("over") > 0, reach).otherwise(-reach))
        step = F.col("theta") - newton
        inside = (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high")))
        done = F.abs("over") <= F.lit(precision) * F.col("target")
        next_theta = F.when(done, F.col("theta")).when(inside, step).otherwise((F.col("low") + F.col("high")) / 2)
        now = kept(stepped.select("source", "source_size", "mean", "target", next_theta.alias("theta"), "low", "high", done.alias("done")), "duals")
        if now.where("not done").isEmpty():
            break
        now = now.drop("done")
    return now.select("source", "theta")


_DEALT = T.StructType([T.StructField("source", T.StringType()), T.StructField("size", T.LongType()), T.StructField("n", T.LongType()), T.StructField("rate", T.DoubleType()), T.StructField("copies", T.LongType())])


def _whole_copies(most: int):
    def deal(rows):
        """Copies of each size of one source, longest first; the error of rounding is carried on in words."""
        rows = rows.sort_values("size", ascending=False, kind="stable")
        owed = float(rows["target"].iloc[0]) - float((rows["n"] * rows["size"] * rows["rate"]).sum())
        copies = []
        for size, n, rate in zip(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist()):
            asked = n * rate + (owed / size if size else 0.0)
            given = min(max(int(asked + 0.5), 0), most * n)
            owed += (n * rate - given) * size
            copies.append(given)
        return rows.assign(copies=copies)[_DEALT.fieldNames()]

    return deal


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
    most: int = 2, seed: int = 12, more: tuple[str, ...] = (),
) -> DataFrame:
    """key, *more, source, size, source_size, target, rate, copies, taken of every document.

    ``more`` columns are carried through the two sorts of the documents; leave texts out unless the mix is written from
    the result with ``repeated``.
    """
    fields = [F.col(key).alias("key"), F.col(source).cast("string").alias("source"), words(F.col(text)).alias("size"), F.struct(*[F.col(f"`{c}`") for c in (key, *more)]).alias("own")]
    sized = kept(docs.select(*fields), "sizes")
    counts = kept(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    whole = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    wanted = kept(targets(kept(whole.select("source", "source_size", (F.col("source_size") / F.col("docs")).alias("mean")), "sources"), weights, share, most), "targets")
    duals = balanced(counts, wanted, float(most))
    wanted = kept(joined(wanted, duals, ["source"], "left"), "tilts")
    rate = F.when(F.col("theta").isNotNull(), _rate(F.col("theta"), float(most))).when(F.col("source_size") > 0, F.lit(float(most))).otherwise(F.lit(most / 2))
    rated = joined(counts, wanted, ["source"]).select("source", "size", "n", "target", rate.alias("rate"))
    dealt = kept(rated.groupBy("source").applyInPandas(_whole_copies(most), _DEALT), "copies")
    placed = ranked(sized.withColumn("turn", F.xxhash64(F.lit(seed), "key")), ["source", "size"], ["turn", "key"])
    placed = joined(placed, dealt.withColumnRenamed("copies", "dealt"), ["source", "size"])
    copies = F.expr("dealt div n + if(rank < dealt % n, 1, 0)")
    return joined(placed, wanted, ["source"]).select(
        "own.*", F.col("source").alias(source), "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, with its number ``copy`` from 1."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
