"""Evidence over time: ledgers of points, changed regions, stability of references, feature memory.

Each is a pure function of the events, so batch and streaming runs give the same state (see streaming/).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip


def session_evidence(events: DataFrame) -> DataFrame:
    """(point_id, session, visible, matched): one row for a point and session. A match counts whenever it comes, also after a miss."""
    return events.groupBy("point_id", "session").agg(F.max("visible").alias("visible"), F.max("matched").alias("matched")).where("visible or matched")


def ledger(events: DataFrame, decay: float = 0.5, retire_after: int = 2) -> DataFrame:
    """(point_id, stability, consistency, unmatched_streak, sessions, state) from (point_id, session, visible, matched).

    A session's weight is decay ** age, age counting this point's later sessions; a point is retired after so
    many sessions without a match at the end.
    """
    s = session_evidence(events)
    w = Window.partitionBy("point_id").orderBy(F.desc("session"))
    x = s.withColumn("age", F.row_number().over(w) - 1)
    x = x.withColumn("hits_since", F.sum(F.col("matched").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    weight = F.pow(F.lit(decay), "age")
    g = x.groupBy("point_id").agg(
        F.least(F.lit(1.0), F.sum(F.when(F.col("matched"), weight).otherwise(0.0))).alias("stability"),
        (F.sum(F.when(F.col("matched"), weight).otherwise(0.0)) / F.sum(weight)).alias("consistency"),
        F.sum((F.col("hits_since") == 0).cast("long")).alias("unmatched_streak"),
        F.count("*").alias("sessions"),
    )
    return g.withColumn("state", F.when(F.col("unmatched_streak") >= retire_after, "RETIRED").when(F.col("unmatched_streak") > 0, "AGING").otherwise("ACTIVE"))


def unmatched_streak(events: DataFrame) -> DataFrame:
    return ledger(events).select("point_id", "unmatched_streak")


def changed_regions(rows: DataFrame, least_sessions: int = 2, least_frames: int = 2, most_ratio: float = 0.5) -> DataFrame:
    """(tile, sessions, low_frames, min_ratio, decision, reason) from (session, tile, low_support_frames, support_ratio).

    Rows with too few frames or a ratio that is missing or too good don't count. Promoted: seen by enough
    sessions with enough frames together.
    """
    ok = rows.where((F.col("low_support_frames") >= least_frames) & (F.col("support_ratio") <= most_ratio))
    g = ok.groupBy("tile").agg(F.countDistinct("session").alias("sessions"), F.sum("low_support_frames").alias("low_frames"), F.min("support_ratio").alias("min_ratio"))
    enough = F.col("low_frames") >= least_sessions * least_frames
    return g.withColumn("decision", F.when((F.col("sessions") >= least_sessions) & enough, "PROMOTE").otherwise("HOLD")).withColumn("reason", F.when(F.col("sessions") < least_sessions, "few_sessions").when(~enough, "few_frames").otherwise("supported"))


def reference_stability(references: DataFrame, hits: DataFrame, half_life: float = 1.0, bonus: float = 0.45, low: float = 0.05, high: float = 2.0) -> DataFrame:
    """(ref, stability): prior times decay by age in sessions, and a bonus for its share of the most hits, within bounds."""
    h = hits.groupBy("ref").agg(F.sum("hits").alias("hits"))
    most = h.agg(F.max("hits").alias("most"))
    j = references.join(h, "ref", "left").crossJoin(F.broadcast(most))  # one row
    v = F.col("prior") * F.pow(F.lit(0.5), F.col("age") / half_life) + F.coalesce(F.lit(bonus) * F.col("hits") / F.greatest("most", F.lit(1)), F.lit(0.0))
    return j.select("ref", clip(v, low, high).alias("stability"))


#: Rewards of feature events.
EVENT_VALUES = {"CORRECT": 1.0, "INCORRECT": -1.0, "UNMATCHED": -0.2}


def event_value(event: Column) -> Column:
    out = F.lit(None).cast("double")
    for name, v in EVENT_VALUES.items():
        out = F.when(event == name, v).otherwise(out)
    return out


def classify_events(eligible: DataFrame, matched: DataFrame) -> DataFrame:
    """(query_id, feature_id, event): CORRECT with any inlier, INCORRECT with matches only, UNMATCHED without."""
    m = matched.groupBy("query_id", "feature_id").agg(F.max("inlier").alias("inlier"))
    j = eligible.select("query_id", "feature_id").distinct().join(m, ["query_id", "feature_id"], "left")
    return j.withColumn("event", F.when(F.col("inlier"), "CORRECT").when(F.col("inlier").isNotNull(), "INCORRECT").otherwise("UNMATCHED")).drop("inlier")


def feature_memory(events: DataFrame, start: float = 0.5, rate: float = 0.1, low: float = 0.0, high: float = 1.0, keep: int = 32) -> DataFrame:
    """(feature_id, score, last_ts, history): scores move by rate * reward and are clamped at each event, in the order of (ts, event).

    A feature's events are one array; that is bounded by how often one feature is seen, not by the table.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event", event_value(F.col("event")).alias("value"))))
    g = events.groupBy("feature_id").agg(ordered.alias("e"))
    score = F.aggregate("e", F.lit(start), lambda s, x: F.least(F.lit(high), F.greatest(F.lit(low), s + rate * F.coalesce(x["value"], F.lit(0.0)))))
    return g.select("feature_id", score.alias("score"), F.element_at("e", -1)["ts"].alias("last_ts"), F.slice("e", F.greatest(F.lit(1), F.size("e") - keep + 1), keep).alias("history"))


def stability_fold(events: DataFrame, per_day: float = 0.98, confirm: int = 2) -> DataFrame:
    """(record, geometric, appearance, confirmations, state) of (record, ts in days, kind, value).

    Both scores decay with days passed; an event that is older than the last one doesn't turn time back.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ts", "kind", "value")))
    g = events.groupBy("record").agg(ordered.alias("e"))
    init = F.struct(F.lit(0.5).alias("g"), F.lit(0.5).alias("a"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("t"))

    def step(s: Column, x: Column) -> Column:
        days = F.greatest(F.lit(0.0), F.coalesce(x["ts"].cast("double") - s["t"], F.lit(0.0)))
        d = F.pow(F.lit(per_day), days)
        add = lambda v, kind: clip(v * d + F.when(x["kind"] == kind, F.coalesce(x["value"].cast("double"), F.lit(0.0))).otherwise(0.0))
        return F.struct(add(s["g"], "geometric").alias("g"), add(s["a"], "appearance").alias("a"), (s["n"] + F.when(x["value"] > 0, 1).otherwise(0)).cast("long").alias("n"), F.greatest(F.coalesce(s["t"], x["ts"].cast("double")), x["ts"].cast("double")).alias("t"))

    f = g.select("record", F.aggregate("e", init, step).alias("s"))
    low = F.least("s.g", "s.a")
    state = F.when(low < 0.2, "UNSTABLE").when((low >= 0.6) & (F.col("s.n") >= confirm), "STABLE").otherwise("CANDIDATE")
    return f.select("record", F.col("s.g").alias("geometric"), F.col("s.a").alias("appearance"), F.col("s.n").alias("confirmations"), state.alias("state"))


def route_decision(frames: DataFrame, overlap: float = 0.60, skip: float = 0.95, least_inliers: float = 50, attempts: float = 0.70) -> DataFrame:
    """(sequence, register_rate, median_inliers, decision) of incoming frames (sequence, attempted, registered, inliers)."""
    g = frames.groupBy("sequence").agg(
        F.avg(F.col("registered").cast("double")).alias("register_rate"),
        F.avg(F.col("attempted").cast("double")).alias("attempt_rate"),
        F.expr("percentile(inliers, 0.5)").alias("median_inliers"),
    )
    low = F.coalesce(F.col("median_inliers") < least_inliers, F.lit(True))
    return g.withColumn("decision", F.when((F.col("attempt_rate") >= attempts) & (F.col("register_rate") < overlap) & low, "RETRIEVAL_HIGH_BUT_INLIERS_LOW").when((F.col("register_rate") > skip) & ~low, "SKIP").when(F.col("register_rate") >= overlap, "REGISTER").otherwise("SUBMAP"))


def lift_matches(matches: DataFrame, observations: DataFrame, radius: float = 2.0, margin: float = 0.5) -> DataFrame:
    """Matches snapped to their reference's nearest observation within a radius, if no other point's is nearly as near.

    matches: match_id, ref_id, r_x, r_y, q_x, q_y, confidence; observations: image_id, x, y, point3d_id.
    """
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    m = matches.select("*", cell("r_x").alias("_cx"), cell("r_y").alias("_cy"), steps).withColumn("_cx", F.col("_cx") + F.col("o.i")).withColumn("_cy", F.col("_cy") + F.col("o.j")).drop("o")
    o = observations.where("point3d_id is not null").select(F.col("image_id").alias("ref_id"), F.col("x").alias("_x"), F.col("y").alias("_y"), "point3d_id", cell("x").alias("_cx"), cell("y").alias("_cy"))
    j = m.join(o, ["ref_id", "_cx", "_cy"]).withColumn("distance", F.sqrt((F.col("r_x") - F.col("_x")) ** 2 + (F.col("r_y") - F.col("_y")) ** 2)).where(F.col("distance") <= radius)
    w = Window.partitionBy("match_id").orderBy("distance", "point3d_id")
    j = j.withColumn("_next", F.lead("distance").over(w)).withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return j.where(F.col("_next").isNull() | (F.col("_next") - F.col("distance") >= margin)).drop("_next", "_r", "_cx", "_cy", "_x", "_y")


def merge_lifted(lifted: DataFrame, radius: float = 2.0) -> DataFrame:
    """One correspondence for each query and point: around its most confident one, weighted mean place, noisy-or confidence, references."""
    w = Window.partitionBy("query_id", "point3d_id").orderBy(F.desc("confidence"), "match_id")
    x = lifted.withColumn("_ax", F.first("q_x").over(w)).withColumn("_ay", F.first("q_y").over(w))
    x = x.where((F.col("q_x") - F.col("_ax")) ** 2 + (F.col("q_y") - F.col("_ay")) ** 2 <= radius**2)
    c = F.least(F.col("confidence"), F.lit(1 - 1e-9))
    return x.groupBy("query_id", "point3d_id").agg((F.sum(F.col("q_x") * F.col("confidence")) / F.sum("confidence")).alias("q_x"), (F.sum(F.col("q_y") * F.col("confidence")) / F.sum("confidence")).alias("q_y"), (1 - F.exp(F.sum(F.log(1 - c)))).alias("confidence"), F.countDistinct("ref_id").alias("references"))
