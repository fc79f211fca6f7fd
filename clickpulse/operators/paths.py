"""Q3: page single-jump conversion along a target page flow.

"Next page" is the successor of a visit inside its session in
(action_time, event_id) order (D18), over all pages of the session; a log
without ``event_id`` is ordered by (action_time, page_id), which is
deterministic. A visit with a null page is a visit: no jump goes to, from or across it.

Skew: a session may be huge (a bot), and so may one minute of it. A window over
``session_id`` would sort it inside one task, so the visits are linked in three
levels, each exact:

1. ``lead`` inside each fine slice of a session: one second of visits whose ids agree but for
   their last 16 bits (without ids: one second's visits of one page);
2. fine slices of the same minute (``slice_chars=16`` of ``action_time``): a
   slice's last visit is followed by the first page of the next slice that is there
   (``last(..., ignorenulls)`` over the frame before the row, slices descending);
3. minutes of a session, in the same way.

Between levels equal (page, next page) pairs are counted together, so levels 2 and 3
see the distinct pairs and one border of each slice, not its visits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MINUTE_SLICE = 16   # len("yyyy-MM-dd HH:mm")
HOUR_SLICE = 13     # len("yyyy-MM-dd HH")
FINE_ID_BITS = 16   # ids in one fine slice


def page_views(visits: DataFrame) -> DataFrame:
    """(page_id, page_views): all visits per page."""
    return visits.groupBy("page_id").agg(F.count(F.lit(1)).alias("page_views"))


def _counted(rows: DataFrame, group: list[str]) -> DataFrame:
    """Equal (page, next) rows of a group as one, with their number."""
    return (rows.groupBy(*group, "page_id", "next", "is_last")
            .agg(F.sum("n").alias("n"), F.max("is_first").alias("is_first")))


def _linked(rows: DataFrame, group: list[str], part: str) -> DataFrame:
    """Joins the parts of each group: a part's last row gets the first page of the next part."""
    ahead = (Window.partitionBy(*group).orderBy(F.desc(part), F.desc("is_last"), "page_id", "next")
             .rowsBetween(Window.unboundedPreceding, -1))
    follows = F.last(F.when(F.col("is_first"), F.struct("page_id")), ignorenulls=True).over(ahead)
    earliest = F.min(part).over(Window.partitionBy(*group))
    out = rows.select(*group, part, "page_id", "next", "is_last", "is_first", "n", follows.alias("follows"),
                      earliest.alias("earliest"))
    return out.select(*group, "page_id", F.when(F.col("is_last"), F.col("follows")).otherwise(F.col("next")).alias("next"),
                      (F.col("is_last") & F.col("follows").isNull()).alias("is_last"),
                      (F.col("is_first") & (F.col(part) == F.col("earliest"))).alias("is_first"), "n")


def session_jumps(visits: DataFrame, slice_chars: int = MINUTE_SLICE, views: bool = False) -> DataFrame:
    """Consecutive (from_page, to_page) pairs inside sessions, pre-counted:
    (from_page, to_page, n) -- sum ``n`` per pair for the number of jumps.

    ``views=True`` adds (page, null, n) records whose ``n`` sum to the visits of
    each page, so page views come out of the same scan and chain."""
    ids = "event_id" in visits.columns
    order = ["action_time", *(["event_id"] if ids else []), "page_id"]
    tie = F.shiftright("event_id", FINE_ID_BITS) if ids else F.col("page_id")
    rows = visits.select("session_id", *order, F.struct("action_time", tie.alias("tie")).alias("fine"),
                         F.substring("action_time", 1, slice_chars).alias("slice"))
    w = Window.partitionBy("session_id", "fine").orderBy(*order)
    # A null page is a visit like any other: "has a next visit" is not "next page is known".
    marked = rows.select("session_id", "slice", "fine", "page_id",
                         F.lead(F.struct("page_id")).over(w).alias("next"),
                         (F.row_number().over(w) == 1).alias("is_first"), F.lit(1).cast("long").alias("n"))
    marked = marked.withColumn("is_last", F.col("next").isNull())
    minutes = _linked(_counted(marked, ["session_id", "slice", "fine"]), ["session_id", "slice"], "fine")
    linked = _linked(_counted(minutes, ["session_id", "slice"]), ["session_id"], "slice")
    pair = F.when(F.col("page_id").isNotNull() & F.col("next.page_id").isNotNull(),
                  F.struct(F.col("page_id").alias("from_page"), F.col("next.page_id").alias("to_page"),
                           F.col("n").alias("n")))
    parts = [pair]
    if views:
        parts.append(F.struct(F.col("page_id").alias("from_page"), F.lit(None).cast("long").alias("to_page"),
                              F.col("n").alias("n")))
    return (linked.select(F.explode(F.array_compact(F.array(*parts))).alias("j"))
            .select("j.from_page", "j.to_page", "j.n"))


def page_transitions(visits: DataFrame, slice_chars: int = MINUTE_SLICE) -> DataFrame:
    """(from_page, to_page, jumps) over all sessions."""
    return (session_jumps(visits, slice_chars).groupBy("from_page", "to_page")
            .agg(F.sum("n").cast("long").alias("jumps")))


def parse_flow(flow: str | list) -> list[int]:
    if isinstance(flow, str):
        return [int(x) for x in flow.split(",") if x.strip()]
    return [int(x) for x in flow]


def target_flow_pairs(spark: SparkSession, flow: str | list = "1,2,3,4,5,6,7") -> DataFrame:
    """The flow's consecutive pairs (step, from_page, to_page) (F10). A parameter, not data."""
    pages = parse_flow(flow)
    rows = [(i + 1, a, b) for i, (a, b) in enumerate(zip(pages[:-1], pages[1:]))]
    return spark.createDataFrame(rows, "step long, from_page long, to_page long")


def page_jump_ratio(visits: DataFrame, flow: str | list = "1,2,3,4,5,6,7",
                    slice_chars: int = MINUTE_SLICE) -> DataFrame:
    """Q3: (jump, from_page, to_page, jumps, page_views, ratio) for every flow pair.

    ``jumps`` = session jumps from ``from_page`` to ``to_page`` (0 when none);
    ``page_views`` = all visits of ``from_page``; ``ratio`` = jumps / page_views
    as a double, null when the page was never viewed (D9, D10, D11).
    The flow is a parameter (one row per step), so jumps and views are narrowed
    with literal predicates before their aggregation (P8) -- no join, no broadcast;
    both come from one scan of the visits.
    """
    pages = parse_flow(flow)
    steps = list(zip(pages[:-1], pages[1:]))
    # one row per distinct jump, as when results are keyed by the "x-y" text
    pairs = target_flow_pairs(visits.sparkSession, flow).select("from_page", "to_page").distinct()
    on_flow = reduce(lambda a, b: a | b, [(F.col("from_page") == a) & (F.col("to_page") == b)
                                         for a, b in steps], F.lit(False))
    is_view = F.col("to_page").isNull() & F.col("from_page").isin(sorted({a for a, _ in steps}))
    # Jumps and views from one scan and one chain: per flow page, its views and a
    # map to_page -> jumps (bounded by the flow length), then joined to the flow.
    counts = (session_jumps(visits, slice_chars, views=True).where(on_flow | is_view)
              .groupBy("from_page", "to_page").agg(F.sum("n").cast("long").alias("n")))
    per_page = counts.groupBy("from_page").agg(
        F.max(F.when(F.col("to_page").isNull(), F.col("n"))).alias("page_views"),
        F.map_from_entries(F.collect_list(F.when(F.col("to_page").isNotNull(), F.struct("to_page", "n"))))
        .alias("jump_map"))
    j = F.coalesce(F.try_element_at(F.col("jump_map"), F.col("to_page")), F.lit(0).cast("long"))
    v = F.coalesce(F.col("page_views"), F.lit(0).cast("long"))
    return (pairs.join(per_page, "from_page", "left")
            .select(F.concat_ws("-", F.col("from_page").cast("string"), F.col("to_page").cast("string"))
                    .alias("jump"),
                    "from_page", "to_page",
                    j.alias("jumps"), v.alias("page_views"),
                    F.when(v > 0, j.cast("double") / v.cast("double")).alias("ratio")))
