"""Event patterns over the ordered rows of each key.

Conditions are ordinary Columns. Every matcher is built from running aggregates, neighbour rows or bounded
time joins, so none of them gathers the rows of a key in one place. Matches are reported by the sequence
numbers (and times) of their rows and by counts, not as arrays of rows.

Input rows need an integer, per-table unique `order` column; `t` is event time in an integer unit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width, block_window, once, own_rows, running, with_neighbours
from eddyline.operators.joins import interval
from eddyline.operators.skips import PAST_LAST, resume_at, taken
from eddyline.session import cut


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def strict_sequence(
    df: DataFrame, key: str, order: str, conditions: Sequence[Column], measures: Mapping[str, tuple[int, str]], width: Width
) -> DataFrame:
    """Consecutive rows of a key meeting the conditions one after the other; overlapping matches are all kept.

    `measures` maps output columns to (position in the sequence, input column).
    """
    n = len(conditions)
    flags = {f"_c{i}": _flag(c) for i, c in enumerate(conditions)}
    names = list(dict.fromkeys(c for _, c in measures.values()))
    rows = df.withColumns(flags)
    payload = list(dict.fromkeys([*names, *flags]))
    around = with_neighbours(rows.select(*dict.fromkeys([key, order, *payload])), [key], [order], payload, width, after=n - 1)
    w = block_window([key], [order])
    seen = around.select("*", *[F.lead(f"_c{i}", i).over(w).alias(f"_m{i}") for i in range(1, n)],
                         *[F.lead(c, i).over(w).alias(out) if i else F.col(c).alias(f"{out}_") for out, (i, c) in measures.items()])
    hit = F.col("_c0")
    for i in range(1, n):
        hit = hit & F.col(f"_m{i}")
    return own_rows(seen).where(hit).select(
        key, *[F.col(out if i else f"{out}_").alias(out) for out, (i, _) in measures.items()]
    )


def not_next(df: DataFrame, key: str, order: str, first: Column, then: Column, width: Width) -> DataFrame:
    """A `first` row whose next row exists and is not a `then` row."""
    return strict_sequence(df, key, order, [first, ~_flag(then)], {"start_seq": (0, order)}, width)


def _with_next(df: DataFrame, key: str, order: str, name: str, row: Column, width: Width) -> DataFrame:
    """Attach the nearest later row of the key for which `row` (a struct) is not null."""
    return running(df, [key], [order], {name: ("last", row)}, width, exclusive=True, reverse=True)


def followed_by(df: DataFrame, key: str, order: str, first: Column, then: Column, width: Width) -> DataFrame:
    """A `first` row and the next `then` row of the key, whatever lies between."""
    nxt = F.when(_flag(then), F.struct(F.col(order).alias("seq")))
    rows = df.select(key, order, _flag(first).alias("_first"), nxt.alias("_row"))
    found = _with_next(rows, key, order, "_next", F.col("_row"), width)
    return found.where(F.col("_first") & F.col("_next").isNotNull()).select(
        key, F.col(order).alias("start_seq"), F.col("_next.seq").alias("end_seq")
    )


def followed_by_within(
    df: DataFrame, key: str, order: str, t: str, first: Column, then: Column, within: int, width: Width
) -> DataFrame:
    """Every `first` row with the next `then` row less than `within` later, or null: (key, start_seq, start_t, end_seq).

    A null `end_seq` is a timeout: the pattern's negative or side output.
    """
    nxt = F.when(_flag(then), F.struct(F.col(order).alias("seq"), F.col(t).alias("t")))
    rows = df.select(*dict.fromkeys([key, order, t]), _flag(first).alias("_first"), nxt.alias("_row"))
    found = _with_next(rows, key, order, "_next", F.col("_row"), width).where("_first")
    in_time = F.col("_next.t") - F.col(t) < within
    return found.select(
        key,
        F.col(order).alias("start_seq"),
        F.col(t).alias("start_t"),
        F.when(in_time, F.col("_next.seq")).alias("end_seq"),
    )


def followed_by_any(df: DataFrame, key: str, order: str, t: str, first: Column, then: Column, within: int) -> DataFrame:
    """A `first` row with each later `then` row less than `within` after it. The bound is mandatory."""
    firsts = df.where(first).select(key, F.col(order).alias("start_seq"), F.col(t).alias("start_t"))
    thens = df.where(then).select(key, F.col(order).alias("end_seq"), F.col(t).alias("end_t"))
    pairs = interval(firsts, thens, [key], "start_t", "end_t", -within, 0)
    later = (F.col("end_seq") > F.col("start_seq")) & (F.col("end_t") - F.col("start_t") < within)
    return pairs.where(later).select(key, "start_seq", "end_seq")


def later_ends(df: DataFrame, key: str, order: str, first: Column, then: Column, width: Width) -> DataFrame:
    """A `first` row with all later `then` rows, whatever lies between and however far, one row per start:
    (key, start_seq, n, first_end, last_end). The matches are the pairs of the start with each of the n ends."""
    hit = _flag(then)
    rows = df.select(key, order, _flag(first).alias("_first"), hit.cast("long").alias("_one"), F.when(hit, F.col(order)).alias("_at"))
    looks = {"n": ("sum", F.col("_one")), "first_end": ("last", F.col("_at")), "last_end": ("max", F.col("_at"))}
    found = running(rows, [key], [order], looks, width, exclusive=True, reverse=True)
    return found.where(F.col("_first") & (F.col("n") > 0)).select(key, F.col(order).alias("start_seq"), "n", "first_end", "last_end")


def later_combinations(df: DataFrame, key: str, order: str, first: Column, then: Column, width: Width) -> DataFrame:
    """`first`, the next `then`, and any one `then` after that, one row per start: (key, start_seq, mid_seq, n, last_end)."""
    found = later_ends(df, key, order, first, then, width).where("n > 1")
    return found.select(key, "start_seq", F.col("first_end").alias("mid_seq"), (F.col("n") - 1).alias("n"), "last_end")


def prefixes_until(df: DataFrame, key: str, order: str, item: Column, stop: Column, width: Width) -> DataFrame:
    """`item`+ until a `stop` row, one row per start: (key, start_seq, n, last_seq). The matches are the n prefixes of the
    items from the start up to the last one before the next stop row."""
    rows = df.select(key, order, _flag(item & ~stop).alias("_item"), _flag(stop).cast("long").alias("_stop"))
    marks = {"_no": ("sum", F.col("_item").cast("long")), "_part": ("sum", F.col("_stop"))}
    items = cut(running(rows, [key], [order], marks, width).where("_item").select(key, "_part", order, "_no"))
    ends = items.groupBy(key, "_part").agg(F.max("_no").alias("_to"), F.max(order).alias("last_seq"))
    return items.join(ends, [key, "_part"]).select(key, F.col(order).alias("start_seq"), (F.col("_to") - F.col("_no") + 1).alias("n"), "last_seq")


def first_and_any(df: DataFrame, key: str, order: str, t: str, first: Column, then: Column, within: int, width: Width) -> DataFrame:
    """`first`, the next `then`, and any one `then` after that, all less than `within` after the first row."""
    firsts = followed_by_within(df, key, order, t, first, then, within, width).where(F.col("end_seq").isNotNull())
    firsts = firsts.withColumnRenamed("end_seq", "mid_seq")
    thens = df.where(then).select(key, F.col(order).alias("end_seq"), F.col(t).alias("end_t"))
    pairs = interval(firsts, thens, [key], "start_t", "end_t", -within, 0)
    later = (F.col("end_seq") > F.col("mid_seq")) & (F.col("end_t") - F.col("start_t") < within)
    return pairs.where(later).select(key, "start_seq", "mid_seq", "end_seq")


def times_within(df: DataFrame, key: str, order: str, t: str, condition: Column, times: int, within: int, width: Width) -> DataFrame:
    """`times` rows meeting the condition, other rows allowed between, all less than `within` apart."""
    hits = df.where(condition)
    measures = {"start_seq": (0, order), "start_t": (0, t), "end_seq": (times - 1, order), "end_t": (times - 1, t)}
    runs = strict_sequence(hits, key, order, [F.lit(True)] * times, measures, width)
    return runs.where(F.col("end_t") - F.col("start_t") < within)


def one_or_more_until(
    df: DataFrame, key: str, order: str, t: str, item: Column, stop: Column, within: int, width: Width
) -> DataFrame:
    """`item`+ until a `stop` row: every prefix from every start, as (key, start_seq, last_seq, n).

    A stop row ends all open matches. Prefixes of one start are numbered by their distance in the running item
    count; start and last row are less than `within` apart.
    """
    rows = df.select(*dict.fromkeys([key, order, t]), _flag(item & ~stop).alias("_item"), _flag(stop).cast("long").alias("_stop"))
    marks = {"_no": ("sum", F.col("_item").cast("long")), "_part": ("sum", F.col("_stop"))}
    items = cut(running(rows, [key], [order], marks, width).where("_item").select(key, "_part", order, t, "_no"))
    return _prefixes(items, [key, "_part"], order, t, within).select(key, "start_seq", "last_seq", "n")


def _prefixes(items: DataFrame, keys: Sequence[str], order: str, t: str, within: int) -> DataFrame:
    starts = items.select(*keys, F.col(order).alias("start_seq"), F.col(t).alias("start_t"), F.col("_no").alias("_a"))
    lasts = items.select(
        *keys, F.col(order).alias("last_seq"), F.col(t).alias("last_t"), F.col("_no").alias("_b"),
        *[c for c in items.columns if c not in (*keys, order, t, "_no")],
    )
    pairs = interval(starts, lasts, keys, "start_t", "last_t", -within, 0)
    fits = (F.col("last_seq") >= F.col("start_seq")) & (F.col("last_t") - F.col("start_t") < within)
    return pairs.where(fits).withColumn("n", F.col("_b") - F.col("_a") + 1).drop("_a", "_b")


def followed_by_consecutive(df: DataFrame, key: str, order: str, first: Column, item: Column, width: Width) -> DataFrame:
    """`first`, then the next `item` row with the items directly after it: (key, start_seq, item_seq, n).

    The matches are the n prefixes of that run from its first item on.
    """
    is_item = _flag(item)
    rows = df.select(
        key, order, _flag(first).alias("_first"), is_item.alias("_item"),
        is_item.cast("long").alias("_one"),
        F.when(~is_item, F.col(order)).alias("_breaks"),
    )
    # counted from the end: items so far, and that count at the nearest later row that is no item
    numbered = once(running(rows, [key], [order], {"_after": ("sum", F.col("_one"))}, width, reverse=True), "numbered")
    at_break = F.when(~F.col("_item"), F.col("_after"))
    runs = once(running(numbered, [key], [order], {"_base": ("last", at_break)}, width, reverse=True), "runs")
    length = F.col("_after") - F.coalesce(F.col("_base"), F.lit(0))
    head = F.when(F.col("_item"), F.struct(F.col(order).alias("seq"), length.alias("n")))
    found = _with_next(runs.select(key, order, "_first", head.alias("_head")), key, order, "_run", F.col("_head"), width)
    return found.where(F.col("_first") & F.col("_run").isNotNull()).select(
        key,
        F.col(order).alias("start_seq"),
        F.col("_run.seq").alias("item_seq"),
        F.col("_run.n").alias("n"),
    )


def _numbered_runs(df: DataFrame, key: str, order: str, t: str, item: Column, end: Column, width: Width) -> DataFrame:
    """Item rows with their running number and the next `end` row (seq, t, items before it)."""
    rows = df.select(*dict.fromkeys([key, order, t]), _flag(item).alias("_item"), _flag(end).alias("_end"))
    numbered = once(running(rows, [key], [order], {"_no": ("sum", F.col("_item").cast("long"))}, width), "numbered")
    end_row = F.when(F.col("_end"), F.struct(F.col(order).alias("seq"), F.col(t).alias("t"), F.col("_no").alias("no")))
    found = _with_next(numbered.withColumn("_row", end_row), key, order, "_next", F.col("_row"), width)
    return found.where(F.col("_item")).select(key, order, t, "_no", "_next")


def greedy_before(df: DataFrame, key: str, order: str, t: str, item: Column, end: Column, width: Width) -> DataFrame:
    """`item`+ greedy followed by `end`: per start row all items from it up to the next end row.

    (key, start_seq, n, end_seq); with the non-greedy form every prefix 1..n is a match as well.
    """
    runs = _numbered_runs(df, key, order, t, item, end, width)
    return runs.where(F.col("_next").isNotNull()).select(
        key,
        F.col(order).alias("start_seq"),
        (F.col("_next.no") - F.col("_no") + 1).alias("n"),
        F.col("_next.seq").alias("end_seq"),
    )


def skip_strategies(df: DataFrame, key: str, order: str, t: str, item: Column, end: Column, width: Width) -> DataFrame:
    """`item`+ followed by `end` under the five after-match strategies, one row per strategy and start:
    (strategy, key, start_seq, matches, longest, end_seq) with the number of matches from this start, the number of items
    of the longest, and the start's own next end row.

    A match of a start takes the items from it up to some last item and the next end row after that. For equal starts the longest match is
    taken first. With it `none` keeps each start with each last item that has an end row after it, `to_next` one match per
    start, `past_last` one per end row, `to_first` the matches inside one stretch between end rows, and `to_last` the
    longest match plus the one starting at its last item.
    """
    runs = cut(_numbered_runs(df, key, order, t, item, end, width).where(F.col("_next").isNotNull()))
    items = runs.select(key, order, "_no", F.col("_next.seq").alias("end_seq"), F.col("_next.no").alias("_all"))
    stretch = items.groupBy(key, "end_seq").agg(F.min(order).alias("_first"), F.max(order).alias("_last"), F.count(F.lit(1)).alias("_n"))
    whole = items.groupBy(key).agg(F.max("_no").alias("_every"))

    def shaped(rows: DataFrame, name: str, start: str, matches: Column, longest: Column) -> DataFrame:
        return rows.select(
            F.lit(name).alias("strategy"), key, F.col(start).alias("start_seq"),
            matches.cast("long").alias("matches"), longest.cast("long").alias("longest"), "end_seq",
        )

    to_all, in_stretch, one = F.col("_every") - F.col("_no") + 1, F.col("_all") - F.col("_no") + 1, F.lit(1)
    out = [
        shaped(items.join(whole, key), "none", order, to_all, to_all),
        shaped(items, "to_next", order, one, in_stretch),
        shaped(stretch, "past_last", "_first", one, F.col("_n")),
        shaped(items, "to_first", order, in_stretch, in_stretch),
        shaped(stretch, "to_last", "_first", one, F.col("_n")),
        shaped(stretch.where("_n > 1"), "to_last", "_last", one, one),
    ]
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def run_then_within(
    df: DataFrame, key: str, order: str, t: str, item: Column, end: Column, within: int, width: Width, skip: str = PAST_LAST
) -> DataFrame:
    """Strict `item`+ `end` within a time: (key, start_seq, end_seq, n).

    A match takes a run of items directly before an end row, from any of its items less than `within` before that row. Past the last row, and to
    the end row ("to last end"), the match from the earliest of them is the only one of an end row; the conditions exclude each other. Other
    clauses: "to next row", "to first item" and "to last item" as in `skips.resume_at`.
    """
    is_item = _flag(item)
    if skip in (PAST_LAST, "to last end", "to first end"):
        plain = F.when(~is_item, F.struct(F.col(order).alias("seq"), F.col(t).alias("t"), _flag(end).alias("ok")))
        found = _with_next(df.select(*dict.fromkeys([key, order, t]), is_item.alias("_item"), plain.alias("_row")), key, order, "_stop", F.col("_row"), width)
        found = found.where(F.col("_item") & F.col("_stop.ok") & (F.col("_stop.t") - F.col(t) < within))
        return found.groupBy(key, F.col("_stop.seq").alias("end_seq")).agg(F.min(order).alias("start_seq"), F.count(F.lit(1)).alias("n"))
    counts = {"_before": ("sum", F.col("_item").cast("long")), "_prev": ("last", F.col(order))}
    rows = df.select(*dict.fromkeys([key, order, t]), is_item.alias("_item"), _flag(end).alias("_is_end"))
    numbered = once(running(rows, [key], [order], counts, width, exclusive=True), "numbered")
    row = F.when(~F.col("_item"), F.struct(F.col(order).alias("seq"), F.col(t).alias("t"), F.col("_is_end").alias("ok"), F.coalesce("_before", F.lit(0)).alias("no"), F.col("_prev").alias("prev")))
    found = _with_next(numbered.withColumn("_row", row), key, order, "_stop", F.col("_row"), width)
    matches = found.where(F.col("_item") & F.col("_stop.ok") & (F.col("_stop.t") - F.col(t) < within)).select(
        key, F.col(order).alias("start_seq"), F.col("_stop.seq").alias("end_seq"),
        (F.col("_stop.no") - F.coalesce("_before", F.lit(0))).alias("n"), F.col("_stop.prev").alias("_last_item"),
    )
    start = F.col("start_seq")
    resume = resume_at(skip, start, F.col("end_seq"), {"item": start}, {"item": F.col("_last_item")})
    return taken(matches, key, "start_seq", resume, width).drop("_last_item")


def reluctant(
    df: DataFrame, key: str, order: str, a: Column, b: Column, c: Column, measures: Sequence[str], width: Width
) -> DataFrame:
    """Strict `A B*? C`, skipping past the last row; conditions may overlap. Gives key, end_seq and measures of C.

    Every match ends at the first C after its A. Per C row, look back to the previous C row p:
    an A after p with only B rows in between makes this C a match whatever happened before; if the only such
    A is p itself, this C matches exactly when p did not end a match; otherwise it does not match. Hence the
    answer is the parity of the C rows since the last C row that was decided on its own.
    """
    seq = F.col(order)
    rows = df.select(
        *dict.fromkeys([key, order, *measures]), _flag(a).alias("_a"), _flag(b).alias("_b"), _flag(c).alias("_c")
    )
    looks = {
        "_last_a": ("last", F.when(F.col("_a"), seq)),
        "_not_b": ("last", F.when(~F.col("_b"), seq)),
        "_prev_c": ("last", F.when(F.col("_c"), F.struct(seq.alias("seq"), F.col("_a").alias("a")))),
        "_before": ("sum", F.col("_c").cast("long")),
    }
    ends = running(rows, [key], [order], looks, width, exclusive=True).where("_c")
    floor = F.coalesce(F.col("_not_b"), F.lit(-(2**63)))
    prev = F.coalesce(F.col("_prev_c.seq"), F.lit(-(2**63)))
    own_start = (F.col("_last_a") > prev) & (F.col("_last_a") >= floor)
    from_prev = F.coalesce(F.col("_prev_c.a"), F.lit(False)) & (prev >= floor)
    decided = F.when(_flag(own_start), 1).when(~from_prev, 0)
    number = F.coalesce(F.col("_before"), F.lit(0))
    numbered = once(ends.select(key, order, *measures, number.alias("_no"), decided.alias("_decided")), "ends")
    fixed = F.when(F.col("_decided").isNotNull(), F.struct(F.col("_no").alias("no"), F.col("_decided").alias("v")))
    known = running(numbered, [key], [order], {"_fixed": ("last", fixed)}, width)
    matched = F.pmod(F.col("_fixed.v") + F.col("_no") - F.col("_fixed.no"), F.lit(2)) == 1
    return known.where(matched).select(key, F.col(order).alias("end_seq"), *measures)


def reluctant_from_any(
    df: DataFrame, key: str, order: str, a: Column, b: Column, c: Column, measures: Sequence[str], width: Width, skip: str
) -> DataFrame:
    """Strict `A B*? C` under any skip clause: key, start_seq, end_seq and measures of C. Conditions may overlap.

    From an A row the match goes to the next C row if all rows between are B rows. "to next row", "to first C" and "to last C" as in
    `skips.resume_at`; past the last row this gives the matches of `reluctant`, which needs no row per A.
    """
    seq = F.col(order)
    rows = df.select(*dict.fromkeys([key, order, *measures]), _flag(a).alias("_a"), _flag(b).alias("_b"), _flag(c).alias("_c"))
    end = F.struct(seq.alias("seq"), *measures)
    looks = {"_end": ("last", F.when(F.col("_c"), end)), "_not_b": ("last", F.when(~F.col("_b"), seq))}
    ahead = running(rows, [key], [order], looks, width, exclusive=True, reverse=True)
    reaches = F.col("_end").isNotNull() & (F.coalesce("_not_b", F.lit(2**63 - 1)) >= F.col("_end.seq"))
    matches = ahead.where(F.col("_a") & reaches).select(key, seq.alias("start_seq"), F.col("_end.seq").alias("end_seq"), *[F.col(f"_end.{m}").alias(m) for m in measures])
    places = {"A": F.col("start_seq"), "C": F.col("end_seq")}
    resume = resume_at(skip, F.col("start_seq"), F.col("end_seq"), places, places)
    return taken(matches, key, "start_seq", resume, width)


def average_below(df: DataFrame, key: str, order: str, value: str, limit: int, width: Width) -> DataFrame:
    """Strict `A+ B` where the average of the A rows stays below `limit` and B is the row that breaks it; skip past last row.

    Gives (key, start_seq, last_seq, end_seq, total, n). With Q = running sum of (value - limit), the row that
    breaks a run started after row i is the first with Q >= Q(i), and the next run starts after it. So the
    breaking rows are the running maxima of Q (starting from 0), found by a running sum and a running maximum.
    """
    rows = df.select(key, order, F.col(value).cast("long").alias("_x"))
    before = {"_p": ("sum", F.col("_x")), "_no": ("sum", F.lit(1).cast("long")), "_prev": ("last", F.col(order))}
    sums = running(rows, [key], [order], before, width, exclusive=True)
    q = F.coalesce("_p", F.lit(0)) + F.col("_x") - (F.coalesce("_no", F.lit(0)) + 1) * limit
    levels = once(sums.select(key, order, "_x", "_prev", q.alias("_q")), "levels")
    tops = running(levels, [key], [order], {"_top": ("max", F.col("_q"))}, width, exclusive=True)
    breaks = F.col("_q") >= F.greatest(F.coalesce("_top", F.lit(0)), F.lit(0))
    marked = once(tops.select(key, order, "_x", "_prev", breaks.alias("_break")), "tops")
    # rows between two breaking rows, the later one included, share the sequence of the earlier one
    run_id = {"_run": ("last", F.when(F.col("_break"), F.col(order)))}
    runs = running(marked, [key], [order], run_id, width, exclusive=True).groupBy(key, "_run").agg(
        F.min(order).alias("start_seq"),
        F.max_by("_prev", order).alias("last_seq"),
        F.max(order).alias("end_seq"),
        (F.sum("_x") - F.max_by("_x", order)).alias("total"),
        (F.count(F.lit(1)) - 1).alias("n"),
        F.max_by("_break", order).alias("_closed"),
    )
    return runs.where(F.col("_closed") & (F.col("n") > 0)).select(key, "start_seq", "last_seq", "end_seq", "total", "n")
