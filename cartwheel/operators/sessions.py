"""Sessions, navigation paths and the purchase funnel.

Navigation n-grams need each event's successors inside its session. A
``lead()`` window would put a whole session in one task; instead the events
are range-partitioned by (session, time), which splits a long session over
tasks, ``lead()`` runs inside each part, and the paths over the edges of
parts come from the few outer rows of the sessions that were split.
"""

from __future__ import annotations

from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import count_type, is_type
from cartwheel.functions.ranking import group_row_number, group_running_sum, range_parts, split_groups
from cartwheel.functions.sizing import materialize
from cartwheel.schema import CART, PURCHASE, VIEW

# Fixed value: minutes of inactivity that end a visit for gap-based sessions.
SESSION_GAP_MINUTES = 30


def navigation_paths(df: DataFrame, n: int = 2, by: str = "event_type",
                     session: str = "user_session", sep: str = ">") -> DataFrame:
    """Counts of n-step paths (consecutive events of a session) over
    ``by`` (event types, or categories with ``by="category_code"``)."""
    base = df.filter(F.col(session).isNotNull()).select(
        session, "event_time", "event_id", F.coalesce(F.col(by).cast("string"), F.lit("NULL"))
        .alias("_step"))
    order = [F.col("event_time"), F.col("event_id")]
    ranged = range_parts(base, [session], order)
    steps = [F.col("_step").alias("s0")]

    def ahead(w):
        return [F.lead("_step", i).over(w).alias(f"s{i}") for i in range(1, n)]

    inside = Window.partitionBy("_part", session).orderBy(*order)
    local = ranged.select(*steps, *ahead(inside), F.lead("event_id", n - 1).over(inside).alias("_end"))
    grams = local.filter(F.col("_end").isNotNull()).drop("_end")
    if n > 1:
        # Paths over the edge of a partition: the n - 1 outer rows of each
        # part of the few sessions that were split.
        back = Window.partitionBy("_part", session).orderBy(*[o.desc() for o in order])
        outer = (ranged.join(split_groups(ranged, [session]), session)
                 .withColumn("_a", F.row_number().over(inside)).withColumn("_z", F.row_number().over(back))
                 .filter((F.col("_a") < n) | (F.col("_z") < n)))
        across = Window.partitionBy(session).orderBy("_part", *order)
        over = outer.select(*steps, *ahead(across), "_part", F.lead("_part", n - 1).over(across).alias("_to"))
        grams = grams.unionByName(over.filter(F.col("_to") != F.col("_part")).drop("_part", "_to"))
    path = F.concat_ws(sep, *[F.col(f"s{i}") for i in range(n)])
    return grams.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "n", F.lit(n))


def frequent_sequences(df: DataFrame, by: str = "event_type", session: str = "user_session",
                       min_count: int = 2, max_length: int = 3, window: int = 64, sep: str = ">") -> DataFrame:
    """X1, sequences of any steps in order, gaps allowed: ``path, n`` (steps)
    and ``count``, the session parts that hold the path at least once, for paths
    of up to ``max_length`` steps in ``min_count`` parts or more.

    Prefix projection (MLlib's PrefixSpan). A session is cut into parts of
    ``window`` successive events, so a long one is no row of its own length; a
    path that spans two parts is not counted.
    """
    steps = df.filter(F.col(session).isNotNull()).select(
        session, "event_time", "event_id", F.coalesce(F.col(by).cast("string"), F.lit("NULL")).alias("_step"))
    order = [F.col("event_time"), F.col("event_id")]
    placed = group_row_number(steps, [session], order, "_pos")
    part = F.floor((F.col("_pos") - 1) / window).alias("_part")
    parts = materialize(placed.groupBy(session, part).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_step"))).alias("e"))  # ``window`` at most
        .select(F.transform("e", lambda x: F.array(x["_step"])).alias("sequence")))
    return frequent_patterns(parts, min_count, max_length).select(
        F.array_join("items", sep).alias("path"), F.size("items").alias("n"), "count")


def frequent_patterns(sequences: DataFrame, min_count: int, max_length: int) -> DataFrame:
    """Frequent subsequences of ``sequence`` (array of one-item arrays): items, count."""
    total = sequences.count()
    if not total:
        return sequences.select(F.flatten("sequence").alias("items"), F.lit(0).cast("long").alias("count")).limit(0)
    # Half a row below the count: the share times the rows rounds up to it.
    miner = PrefixSpan(minSupport=(min_count - 0.5) / total, maxPatternLength=max_length, sequenceCol="sequence")
    found = miner.findFrequentSequentialPatterns(sequences)
    return found.select(F.flatten("sequence").alias("items"), F.col("freq").alias("count"))


def session_metrics(df: DataFrame, session: str = "user_session") -> DataFrame:
    """Per session: user, events, distinct event types, first/last
    event, length in minutes, per-type counts and purchase value."""
    purchase = is_type(PURCHASE)
    return df.filter(F.col(session).isNotNull()).groupBy(session).agg(
        F.min("user_id").alias("user_id"),  # smallest user of the session
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("event_type").alias("event_types"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        ((F.unix_micros(F.max("event_time")) - F.unix_micros(F.min("event_time"))) / 6.0e7)
        .alias("minutes"),
        count_type(VIEW).alias("views"), count_type(CART).alias("carts"),
        count_type(PURCHASE).alias("purchases"),
        F.sum(F.when(purchase, F.col("price")).otherwise(F.lit(0.0))).alias("purchase_value"))


def gap_sessions(df: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
                 method: str = "ranked") -> DataFrame:
    """X2 option: visits split by ``gap_minutes`` of inactivity per user.

    A visit starts at a user's first event and at every event whose
    predecessor is ``gap_minutes`` or more earlier; it ends ``gap`` after its
    last event (Spark's session-window definition).

    ``method="ranked"`` (default) never holds one user in one task: events
    are range-partitioned by (user, time), the predecessor is the row before
    in the partition or the end of the user's part before, and the visit
    number is a running count of visit starts over the same kind of parts.
    ``method="session_window"`` uses Spark's ``session_window`` (sorted
    merge per user in one task).
    """
    users = df.filter(F.col("user_id").isNotNull())
    if method == "session_window":
        return users.groupBy(
            "user_id", F.session_window("event_time", f"{gap_minutes} minutes").alias("visit")
        ).agg(F.count(F.lit(1)).alias("events"), count_type(PURCHASE).alias("purchases")).select(
            "user_id", F.col("visit.start").alias("visit_start"),
            F.col("visit.end").alias("visit_end"), "events", "purchases")
    order = [F.col("event_time"), F.col("event_id")]
    base = users.select("user_id", "event_time", "event_id", "event_type")
    ranged = range_parts(base, ["user_id"], order)
    # The event before: in the same partition, or the last one of the user's
    # part before (only users that were split have one).
    local = F.lag("event_time").over(Window.partitionBy("_part", "user_id").orderBy(*order))
    ends = (ranged.join(split_groups(ranged, ["user_id"]), "user_id").groupBy("user_id", "_part")
            .agg(F.max("event_time").alias("_last")))
    before = ends.select("user_id", "_part", F.lag("_last").over(
        Window.partitionBy("user_id").orderBy("_part")).alias("_carried"))
    pos = (ranged.withColumn("_local", local).join(before, ["user_id", "_part"], "left")
           .withColumn("_prev", F.coalesce("_local", "_carried")).drop("_local", "_carried", "_part"))
    gap_us = gap_minutes * 60 * 1_000_000
    start = (F.col("_prev").isNull()
             | (F.unix_micros("event_time") - F.unix_micros("_prev") >= F.lit(gap_us)))
    flagged = pos.withColumn("_start", F.when(start, 1).otherwise(0))
    visits = group_running_sum(flagged, ["user_id"], order, F.col("_start"), "_visit")
    return visits.groupBy("user_id", "_visit").agg(
        F.min("event_time").alias("visit_start"),
        (F.max("event_time") + F.expr(f"INTERVAL {gap_minutes} MINUTES")).alias("visit_end"),
        F.count(F.lit(1)).alias("events"), count_type(PURCHASE).alias("purchases")).drop("_visit")


def funnel_stages(df: DataFrame, keys=("user_id", "product_id")) -> DataFrame:
    """X4 per key: first view, first cart not before it, first purchase not
    before that cart (NULL where the funnel stops)."""
    k = list(keys)
    t = F.col("event_time")
    views = df.filter(is_type(VIEW)).groupBy(*k).agg(F.min(t).alias("t_view"))
    carts = (df.filter(is_type(CART)).select(*k, "event_time").join(views, k)
             .filter(t >= F.col("t_view")).groupBy(*k).agg(F.min(t).alias("t_cart")))
    buys = (df.filter(is_type(PURCHASE)).select(*k, "event_time").join(carts, k)
            .filter(t >= F.col("t_cart")).groupBy(*k).agg(F.min(t).alias("t_purchase")))
    return views.join(carts, k, "left").join(buys, k, "left")


def funnel(df: DataFrame, keys=("user_id", "product_id")) -> DataFrame:
    """X4 summary: keys reaching view → cart → purchase, with step rates."""
    st = funnel_stages(df, keys)
    agg = st.agg(F.count(F.lit(1)).alias("viewed"), F.count("t_cart").alias("carted"),
                 F.count("t_purchase").alias("purchased"))
    return agg.select(
        "viewed", "carted", "purchased",
        F.try_divide(F.col("carted").cast("double"), F.col("viewed")).alias("view_to_cart"),
        F.try_divide(F.col("purchased").cast("double"), F.col("carted")).alias("cart_to_purchase"),
        F.try_divide(F.col("purchased").cast("double"), F.col("viewed")).alias("view_to_purchase"))
