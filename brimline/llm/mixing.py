"""Mixing sources to target numbers of words by entropy balancing, in DataFrame functions only.

Each source has a target, and each document a rate between 0 and `cap`, how often it is taken on average. Of all rates that meet a
source's target, those with the largest entropy are tilted exponentially in the document's size z (in mean sizes of its source):

    rate = cap / (1 + exp(-tilt * z)),        rate / (cap - rate) = exp(tilt * z),

so documents stay as near to half the cap as the target allows. The tilt is the root of a convex dual's derivative, found by Newton steps
that a bracket guards. Sums of a step depend on a document only by its source and size, so documents are counted by these once, and
the steps run on the counts, for all sources at a time.

Rates become copies by sequential Poisson sampling: a document takes the whole part of its rate, and of the rest, in the order of
u / fraction with u from a hash of the row, so many one more that the source comes as near to its target as its last document lets it.
That place in the order is found digit by digit: each turn adds up sizes by the next digits of the order, so nothing is sorted, and a
source of any size is never in one task.

Targets: sources by code point, null last, weigh 5, 2, 1, 5, ...; they share the goal by weight, none gets more than `cap` times its
size, and what is left over is shared again.

Defined results: a null or empty text, or one without words, has size 0 and is taken 0 times; documents without a source are a source of
their own; a source without words has target 0; repeated rows each count, and where only some of equal rows are taken it does not matter
which; texts of any length are counted whole; an empty table gives none; extra columns are kept, and one that bears the name of an
added one is replaced. Equal input gives equal copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brimline.llm.shared import numbered
from brimline.sources.writers import materialize

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2, 13
#: A source's rates meet its target when they miss it by no more than this part; tilts are rounded, so that sums in another order
#: give the same ones.
TOLERANCE, DIGITS = 1e-9, 9
MOST_STEPS = 200
#: Bits of a place in the order, bits that a turn looks at, and rows of a source that are few enough to be listed one by one.
ORDER_BITS, TURN_BITS, FEW = 52, 10, 4096
#: Part of its target that a source may miss without another round, and rounds at most.
NEAR, ROUNDS = 0.0005, 6
CUT = "struct<after: bigint, last: bigint, limit: bigint, each: double, ties: bigint, room: bigint>"

ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


def word_count(text: Column) -> Column:
    """Runs of characters other than space, tab to carriage return."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != "")).cast("long")


def measured(docs: DataFrame, kept: list[str], seed: int = SEED) -> DataFrame:
    """`kept` (a struct of columns), source, `size`, and `u`, a number between 0 and 1 from a hash of doc_id and text."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 64 - ORDER_BITS)
    return docs.select(F.struct(*[f"`{c}`" for c in kept]).alias("kept"), "source", word_count(F.col("text")).alias("size"),
                       ((h + 0.5) / F.lit(float(1 << ORDER_BITS))).alias("u"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, n_docs, source_size, target) of each source of a table with source and size.

    Each turn adds up two numbers over the sources that are below their limit; there are as many turns as it takes until no
    further source reaches it.
    """
    found = materialize(sizes.groupBy("source").agg(
        F.count_if(F.col("size") > 0).alias("n_docs"), F.sum("size").alias("source_size")))
    order = [F.col("source").isNull().cast("int"), F.coalesce("source", F.lit(""))]
    place = (F.col("place") - 1) % len(weights)
    found = materialize(numbered(found, order, "place").withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int"))).drop("place"))
    limit, level, full = cap * F.col("source_size"), None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > limit
        r = found.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(over, limit)).alias("held"), F.count_if(over).alias("full"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if r["full"] == full or not r["weight"]:
            break
        full, level = r["full"], (share * r["all"] - (r["held"] or 0)) / r["weight"]
    target = F.least(F.col("weight") * F.lit(level or 0.0), limit.cast("double"))
    return found.select("source", "n_docs", "source_size", target.alias("target"))


def _rate(tilt: Column, z: Column, cap: float) -> Column:
    return cap / (1 + F.exp(-tilt * z))


def tilts(sizes: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds `mean`, the mean size, and `tilt` to the sources; no tilt means that every document is taken `cap` times, or that none has words."""
    mean = F.col("source_size") / F.col("n_docs")
    share = F.col("target") / F.col("source_size")
    free = (F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size"))
    sources = materialize(sources.withColumns({
        "mean": F.when(F.col("n_docs") > 0, mean), "tilt": F.when(free, F.log(share / (cap - share)))}))
    cells = materialize(sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    none = F.lit(None).cast("double")
    state = sources.where("tilt is not null").withColumns({"low": none, "high": none, "done": F.lit(False)})
    columns = state.columns
    for _ in range(MOST_STEPS):
        joined = cells.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
            "s.*", F.col("c.size").alias("cell"), F.col("c.n").alias("n"))
        z = F.col("cell") / F.col("mean")
        rate = _rate(F.col("tilt"), z, cap)
        words = F.col("n") * F.col("cell")
        sums = joined.groupBy(*columns).agg(
            (F.sum(words * rate) - F.first("target")).alias("slope"),
            F.sum(words * z * rate * (1 - rate / cap)).alias("bend"))
        low, high = F.when(F.col("slope") < 0, F.col("tilt")).otherwise(F.col("low")), F.when(
            F.col("slope") > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.col("slope") / F.nullif(F.col("bend"), F.lit(0.0))
        inside = (F.col("_low").isNull() | (newton > F.col("_low"))) & (F.col("_high").isNull() | (newton < F.col("_high")))
        away = 2 * F.abs(F.col("tilt")) + 1
        middle = F.coalesce((F.col("_low") + F.col("_high")) / 2, F.col("_low") + away, F.col("_high") - away)
        closed = F.coalesce(F.col("_high") - F.col("_low") <= 1e-15 * away, F.lit(False))
        met = F.col("done") | (F.abs("slope") <= TOLERANCE * F.col("target")) | closed
        state = materialize(sums.withColumns({"_low": low, "_high": high}).select(
            "source", "n_docs", "source_size", "target", "mean",
            F.when(met, F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"),
            F.col("_low").alias("low"), F.col("_high").alias("high"), met.alias("done")))
        if not state.where("not done").limit(1).count():
            break
    rest = sources.where("tilt is null")
    return materialize(state.select(*rest.columns).withColumn("tilt", F.round("tilt", DIGITS)).union(rest))


@dataclass(frozen=True)
class Mix:
    """A row for each source: its target, its tilt, and `cuts` of the order of its documents. One more copy is taken of documents
    between `after` and `last` with at most `limit` words, and of `room` of the `ties` ones, of `each` words, that stand at `last`."""
    sources: DataFrame
    cap: float


def _rated(rows: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Adds what the sources know, `rate`, whole copies and the place in the order for one more (null for none) to rows."""
    side = sources.withColumnRenamed("source", "_of")
    out = rows.join(side, rows["source"].eqNullSafe(side["_of"])).drop("_of")
    z = F.col("size") / F.col("mean")
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("tilt").isNull(), F.lit(float(cap))).otherwise(
        _rate(F.col("tilt"), z, cap))
    out = out.withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    share = F.col("rate") - F.col("whole")
    order = F.floor(F.col("u") / (F.col("u") + share) * F.lit(float(1 << ORDER_BITS)))
    return out.withColumn("place", F.when(share > 0, order))


def balance(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> Mix:
    """The mix for a stored table with source, size and u.

    A round goes through the order until a source has what it needs. What is missing then is less than the next document; where that is
    more than a small part of the target, another round goes on behind that document with the smaller ones that still fit.
    """
    sources = tilts(sizes, targets(sizes, weights, share, cap), cap)
    rows = _rated(sizes.select("source", "size", "u"), sources, cap).select("source", "size", "target", "whole", "place")
    need = rows.groupBy("source").agg(
        F.first("target").alias("target"), (F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("need"))
    no_cuts = F.array().cast(f"array<{CUT}>")
    state = materialize(need.select(
        "source", "target", "need", F.lit(-1).cast("long").alias("after"), F.lit((1 << 63) - 1).alias("limit"),
        no_cuts.alias("cuts"), F.lit(True).alias("more")))
    queued = rows.where("place is not null").select("source", "size", "place")
    for _ in range(ROUNDS):
        open_ = F.col("more") & (F.col("need") > NEAR * F.col("target")) & (F.col("need") >= 1)
        active = state.where(open_)
        if not active.limit(1).count():
            break
        found = _place(queued, active.select("source", "need", "after", "limit")).withColumnRenamed("source", "_of")
        joined = active.join(found, active["source"].eqNullSafe(found["_of"]), "left").drop("_of")
        joined = joined.withColumn("each", F.col("words") / F.col("ties")).withColumn(
            "room", F.least(F.col("ties"), F.floor((F.col("need") - F.col("before")) / F.col("each"))))
        left = F.col("need") - F.col("before") - F.col("room") * F.col("each")
        cut = F.struct("after", "last", "limit", "each", "ties", "room").cast(CUT)
        there = F.col("last").isNotNull()
        state = materialize(joined.select(
            "source", "target", F.when(there, left).otherwise(F.col("need")).alias("need"), F.coalesce("last", "after").alias("after"),
            F.when(there, F.floor(left)).otherwise(0).cast("long").alias("limit"),
            F.when(there, F.concat("cuts", F.array(cut))).otherwise(F.col("cuts")).alias("cuts"),
            there.alias("more")).union(state.where(~open_)))
    # One more of the documents that rounds stopped at is taken if that brings the source nearer to its target.
    left = lambda c: F.abs(F.col("need") - c["each"])
    best = F.array_min(F.transform(F.filter("cuts", lambda c: (c["room"] < c["ties"]) & (left(c) < F.col("need"))), lambda c: F.struct(
        left(c).alias("left"), c["last"].alias("last"))))["last"]
    cuts = F.transform("cuts", lambda c: c.withField("room", c["room"] + F.coalesce((c["last"] == best).cast("long"), F.lit(0))))
    side = state.select(F.col("source").alias("_of"), cuts.alias("cuts"))
    whole = sources.join(side, sources["source"].eqNullSafe(side["_of"]), "left").drop("_of")
    return Mix(materialize(whole.withColumn("cuts", F.coalesce("cuts", no_cuts))), cap)


def _place(queued: DataFrame, active: DataFrame) -> DataFrame:
    """(source, before, last, ties, words): of each source the first place at which the queue's sums reach what it needs, the words
    before it, and the rows and words there."""
    state, shift = active.withColumns({"digits": F.lit(0).cast("long"), "gone": F.lit(0).cast("long")}), ORDER_BITS
    while shift:
        step = min(TURN_BITS, shift)
        shift -= step
        sums = _within(queued, state, shift + step).groupBy("source", F.shiftright("place", shift).alias("digits")).agg(
            *_state(), F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        state = materialize(_critical(sums, "digits").select(
            "source", "need", "after", "limit", "digits", (F.col("gone") + F.col("before")).alias("gone"), "rows"))
        if (state.agg(F.max("rows")).first()[0] or 0) <= FEW:
            break
        state = state.drop("rows")
    # A source has few distinct places left.
    sums = _within(queued, state, shift).groupBy("source", "place").agg(
        *_state(), F.sum("size").alias("words"), F.count(F.lit(1)).alias("ties"))
    return _critical(sums, "place").select(
        "source", (F.col("gone") + F.col("before")).alias("before"), F.col("place").alias("last"), "ties", "words")


def _within(queued: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """Rows of the queue with the digits found so far for their source."""
    return queued.alias("q").join(state.alias("s"), F.col("q.source").eqNullSafe(F.col("s.source")) & (
        F.shiftright("q.place", shift) == F.col("s.digits")) & (F.col("q.place") > F.col("s.after")) & (
        F.col("q.size") <= F.col("s.limit"))).select("q.*", "s.need", "s.after", "s.limit", "s.gone")


def _state() -> list[Column]:
    return [F.first(c).alias(c) for c in ("need", "after", "limit", "gone")]


def _critical(sums: DataFrame, key: str) -> DataFrame:
    """Of each source the first row by key up to which the sums reach what it needs, with `before`, the sum of those before it;
    its last row if they fall short. A source has a row for each of few keys."""
    order = f"over (partition by source order by {key}"
    summed = sums.withColumns({"before": F.expr(f"coalesce(sum(words) {order} rows between unbounded preceding and 1 preceding), 0)"),
                               "_last": F.expr(f"lead({key}) {order}) is null")})
    need = F.col("need") - F.col("gone")
    return summed.where(((F.col("before") < need) | (F.col("before") == 0)) & ((F.col("before") + F.col("words") >= need) | F.col("_last")))


def apply(rows: DataFrame, mix: Mix) -> DataFrame:
    """What `measured` keeps of each row, with `size`, `source_size`, `target`, `rate`, `copies` and `taken` (words)."""
    rated = _rated(rows.select("kept", "source", "size", "u"), mix.sources, mix.cap)
    at = lambda c: (F.col("place") == c["last"]) & (F.col("size") <= c["limit"])
    between = lambda c: (F.col("place") > c["after"]) & (F.col("place") < c["last"]) & (F.col("size") <= c["limit"])
    some = lambda c: (c["room"] > 0) & (c["room"] < c["ties"])
    more = F.exists("cuts", lambda c: between(c) | (at(c) & (c["room"] >= c["ties"])))

    def taken(df: DataFrame, more: Column) -> DataFrame:
        copies = F.col("whole") + F.coalesce(more, F.lit(False)).cast("long")
        return df.withColumn("copies", copies.cast("long")).select(
            "kept.*", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))

    if not mix.sources.where(F.exists("cuts", some)).limit(1).count():
        return taken(rated, more)
    # Equal rows of which only some take one more: they are numbered, as a source may have any number of them.
    tied = F.coalesce(F.exists("cuts", lambda c: some(c) & at(c)), F.lit(False))
    order = [F.col("source").isNull().cast("int"), F.coalesce("source", F.lit("")), F.col("place")]
    part = numbered(rated.where(tied), order, "number")
    first = part.groupBy("source", "place").agg(F.min("number").alias("first")).withColumnsRenamed({"source": "_of", "place": "_at"})
    part = part.join(first, part["source"].eqNullSafe(first["_of"]) & (part["place"] == first["_at"])).drop("_of", "_at")
    room = F.get(F.filter("cuts", lambda c: some(c) & at(c)), 0)["room"]
    return taken(rated.where(~tied), more).union(taken(part, F.col("number") - F.col("first") < room))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """The documents that are taken at least once, with all their columns and `copies`."""
    sizes = materialize(measured(docs, [], seed).drop("kept"))
    kept = [c for c in docs.columns if c not in ADDED]
    return apply(measured(docs, kept, seed), balance(sizes, weights, share, cap)).where("copies > 0")


def rates(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of each document; texts are read once."""
    sizes = materialize(measured(docs, ["doc_id", "source"], seed))
    return apply(sizes, balance(sizes.drop("kept"), weights, share, cap))
