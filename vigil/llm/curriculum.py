"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear between knots.
Its integral fixes the source's share of the token budget (capped at ``max_epochs`` times
its size, the excess reshared by weight).  A source's documents stand in a keyed order; the
cumulative demand for its tokens, inverted, turns a place in that order into a training
position, and documents are range-sorted by position.

Running sums are two-level: totals per (source, hash bucket), a window over those few
rows, then a window inside each bucket, so a source holding a third of all rows is spread
over all its buckets.  Only ids, sources and sizes are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.store import boxed

WORD = r"[^\x20\x09-\x0D]+"

#: rows that one hash bucket of one source should hold at most, on average
BUCKET_ROWS = 20_000

#: default schedules, dealt to the sources in turn: knots (time, weight); their
#: integrals are 3, 1 and 2
SCHEDULES = (((0.0, 4.0), (0.5, 3.0), (1.0, 2.0)),
             ((0.0, 0.5), (1.0, 1.5)),
             ((0.0, 2.0), (0.5, 3.0), (1.0, 0.0)))


def integral(knots) -> float:
    """Area under a piecewise linear schedule by the trapezium rule."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def word_count(text: Column) -> Column:
    """Words between blanks; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keyed_order(seed: str, key: Column) -> Column:
    """Hex md5 of seed and key: the order of documents inside a source."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
                 .cast("binary"))


def source_targets(sizes: DataFrame, weights: list[float], budget: float,
                   max_epochs: int = 2) -> DataFrame:
    """Targets of ``sizes`` (source, source_size; one row per source, a list a person
    configures): sources in code point order, null last, take ``weights`` in turn and share
    ``budget * all sizes``; a target stops at ``max_epochs`` times the source's size and
    the excess is reshared by weight until none is above.

    Resharing ends where every source above its cap is at it: in the order of
    cap / weight, source k is capped iff its cap is at most its share of what those before
    leave.  Adds ``turn, weight, target``.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.col("turn") + 1)
    s = (sizes.withColumn("turn", ((F.row_number().over(by_name) - 1) % n).cast("int"))
         .withColumn("weight", weight)
         .withColumn("cap", F.col("source_size") * max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(
        0, Window.unboundedFollowing)
    s = (s.withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(budget))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(ahead), F.lit(0)))
         .withColumn("weights_left", F.sum("weight").over(rest))
         .withColumn("capped", F.col("cap") * F.col("weights_left")
                     <= F.col("left") * F.col("weight")))
    everyone = Window.partitionBy()
    open_left = F.col("total") - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everyone), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everyone)
    return s.select("source", "source_size", "turn", "weight",
                    F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(open_left * F.col("weight") / open_weight).alias("target"))


def demand_time(share: str, turn: str, schedules) -> str:
    """SQL for the training time at which a source has used ``share`` (0..1) of its tokens:
    the inverse of its normalised cumulative demand.  Between two knots demand is quadratic
    in time; its root is taken in the form that also holds where the schedule is flat."""
    cases = []
    for k, knots in enumerate(schedules):
        whole, before, inner = integral(knots), 0.0, ""
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            area = (t1 - t0) * (w0 + w1) / 2
            need = f"greatest({share} * {whole!r}D - {before!r}D, 0.0D)"
            root = f"sqrt(greatest({w0 * w0!r}D + {need} * {2 * (w1 - w0) / (t1 - t0)!r}D, 0.0D))"
            at = (f"least({t0!r}D + coalesce({need} * 2.0D / nullif({w0!r}D + {root}, 0.0D), "
                  f"0.0D), {t1!r}D)")
            before += area
            inner += (f" WHEN {share} * {whole!r}D <= {before!r}D THEN {at}"
                      if t1 < knots[-1][0] else f" ELSE {at}")
        cases.append(f"WHEN {turn} = {k} THEN (CASE{inner} END)" if len(knots) > 2
                     else f"WHEN {turn} = {k} THEN {at}")
    return "(CASE " + " ".join(cases) + " END)"


def curriculum(df: DataFrame, *, schedules=SCHEDULES, budget: float = 1.5,
               max_epochs: int = 2, seed: str = "mix", size: Column | None = None,
               key_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text", ordered: bool = True) -> DataFrame:
    """``df`` with what the mix takes of each document and when, sorted by position (unless
    ``emit``, which sorts copies, follows: then ``ordered=False`` saves a sort of all rows).

    Adds ``size`` (words, or the given column), ``source_size``, ``target`` (of the
    source), ``taken`` (words the mix takes of the document, repeats counted), ``copies``
    (array of ``copy, words, position``) and ``position`` (0..1, of the first copy; null if
    nothing is taken).  Whole passes over a source are taken as often as the target holds
    them; then documents in keyed order until the target is met, the last one in part.  So a
    source's taken words are its rounded target, and no document exceeds
    ``max_epochs`` times its size.

    Edge cases: a null source is a source of its own, the last in order; a null text or one
    without words has size 0 and takes 0; a source without words has target 0; documents
    with equal keys stand next to each other, by size; an empty table gives no rows.  The
    result is the same on every run.  Columns of ``df`` with the names added here are
    replaced.
    """
    box, own = boxed(df, ADDED)
    n_rows = df.count()
    bits = max(0, (n_rows // BUCKET_ROWS).bit_length())
    rows = df.select(box, (size if size is not None else word_count(F.col(f"`{text_col}`")))
                     .alias("size"), F.col(f"`{source_col}`").alias("__source"),
                     F.col(f"`{key_col}`").alias("__key"),
                     keyed_order(seed, F.col(f"`{key_col}`")).alias("__order"))
    rows = rows.withColumn("__bucket", F.shiftright(
        F.conv(F.substring("__order", 1, 7), 16, 10).cast("long"), 28 - bits)
        if bits else F.lit(0).cast("long"))

    totals = rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("__sum"))
    per_source = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    buckets = totals.withColumn("__ahead", F.coalesce(F.sum("__sum").over(per_source), F.lit(0)))
    targets = source_targets(
        totals.groupBy(F.col("__source").alias("source")).agg(F.sum("__sum").alias("source_size")),
        [integral(k) for k in schedules], budget, max_epochs).select(
        F.col("source").alias("__s"), "source_size", "target", F.col("turn").alias("__turn"))
    # plain columns without nulls as keys: one shuffle of rows serves the join and the window
    keys = ["__named", "__null", "__bucket"]
    keyed = lambda df: df.withColumns({
        "__named": F.coalesce(F.col("__source").cast("string"), F.lit("")), "__null": F.col("__source").isNull()})
    buckets = (keyed(buckets.join(targets, F.col("__source").eqNullSafe(F.col("__s"))))
               .select(*keys, "__ahead", "source_size", "target", "__turn"))

    inside = Window.partitionBy(*keys).orderBy("__order", "__key", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    out = (keyed(rows).join(buckets, keys)
           .withColumn("__at", F.col("__ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
           .withColumn("__goal", F.round("target").cast("long"))
           .withColumn("__passes", F.when(F.col("source_size") > 0, F.floor(
               F.col("__goal") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
           .withColumn("__more", F.least(F.greatest(
               F.col("__goal") - F.col("__passes") * F.col("source_size") - F.col("__at"),
               F.lit(0)), F.col("size")))
           .withColumn("taken", F.col("__passes") * F.col("size") + F.col("__more")))
    made = F.expr(
        "filter(transform(sequence(0, cast(__passes AS int)), k -> struct(k AS copy, "
        "if(k < __passes, size, __more) AS words, (k * source_size + __at + "
        "if(k < __passes, size, __more) / 2.0D) / __goal AS share)), c -> c.words > 0)")
    timed = F.expr("transform(__made, c -> struct(c.copy AS copy, c.words AS words, "
                   + demand_time("c.share", "__turn", schedules) + " AS position))")
    out = (out.withColumn("__made", made).withColumn("copies", timed)
           .withColumn("position", F.expr("get(copies, 0).position")))
    if ordered:
        out = out.orderBy(F.col("position").asc_nulls_last(), "__key", "size")
    return (out.select(*own, "size", "source_size", "target", "taken", "copies", "position"))


def first_words(text: Column, n: Column) -> Column:
    """A text up to its ``n``-th word, blanks kept."""
    pieces = F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORD})"), 1)
    return F.array_join(F.slice(pieces, F.lit(1), n), "")


#: columns that ``curriculum`` adds, and ``emit``
ADDED = {"size", "source_size", "target", "taken", "copies", "position"}
EMITTED = {"copy", "words", "copy_position"}


def emit(plan: DataFrame, *, text_col: str = "text") -> DataFrame:
    """One row per copy that the mix takes, in training order; a copy taken in part has the
    text's first words.  Adds ``copy, words, copy_position``; drops the plan's columns."""
    own = [c for c in plan.columns if c.lower() not in ADDED | EMITTED]
    copies = plan.select(*[F.col(f"`{c}`") for c in own], "size", F.explode("copies").alias("__c"))
    text = F.when(F.col("__c.words") < F.col("size"), first_words(
        F.col(f"`{text_col}`"), F.col("__c.words").cast("int"))).otherwise(F.col(f"`{text_col}`"))
    return (copies.orderBy("__c.position", *[F.col(f"`{c}`") for c in own[:1]], "__c.copy")
            .select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in own],
                    F.col("__c.copy").alias("copy"), F.col("__c.words").alias("words"),
                    F.col("__c.position").alias("copy_position")))
