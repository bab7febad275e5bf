"""Page states: legal moves, effective states, batch replay of an event log, export choices, monitoring counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.rx import blank, count, has, one_of, solid_lines, strip, tally


def moves(spark: SparkSession) -> DataFrame:
    """(from_state, to_state) of every legal move; each state may also stay, and any may fail."""
    legal = {(a, b) for a, to in P.MOVES.items() for b in (*to, P.FAILED, a)}
    return spark.createDataFrame(sorted(legal), "from_state string, to_state string")


def rank(state: Column) -> Column:
    """The place of a state in the order, -1 for failed and unknown ones."""
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in P.STATES]), state).cast("int"), F.lit(0)) - 1


def at_least(state: Column, target: str) -> Column:
    return rank(state) >= P.STATES.index(target)


def effective(current: Column, last_success: Column) -> Column:
    return F.when(current == P.FAILED, last_success).otherwise(current)


def invalid_moves(events: DataFrame) -> DataFrame:
    """Events whose move isn't legal."""
    return events.join(F.broadcast(moves(events.sparkSession)), ["from_state", "to_state"], "left_anti")


def replayed(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Current and last successful state of each key, from the to_states of its events in order.

    A failed page goes on from its last successful state; an event that repeats the state, or an illegal one, changes
    nothing, and illegal ones are counted."""
    legal = F.create_map(*[x for a, to in P.MOVES.items() for x in (F.lit(a), F.array(*[F.lit(b) for b in (*to, P.FAILED)]))])
    kind = "struct<current:string,last:string,moves:int,illegal:int>"
    start = F.struct(F.lit("NEW").alias("current"), F.lit("NEW").alias("last"), F.lit(0).alias("moves"), F.lit(0).alias("illegal")).cast(kind)

    def move(s: Column, to: Column) -> Column:
        at = effective(s["current"], s["last"])
        same = (to == s["current"]) & (to != P.FAILED)
        ok = F.array_contains(legal[at], to) | (to == at)
        new = F.struct(to.alias("current"), F.when(to == P.FAILED, at).otherwise(to).alias("last"), (s["moves"] + 1).alias("moves"), s["illegal"].alias("illegal"))
        bad = F.struct(s["current"].alias("current"), s["last"].alias("last"), s["moves"].alias("moves"), (s["illegal"] + 1).alias("illegal"))
        return F.when(same, s).when(ok, new.cast(kind)).otherwise(bad.cast(kind))

    listed = events.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, "to_state"))).alias("e"))
    done = listed.withColumn("s", F.aggregate(F.transform("e", lambda x: x["to_state"]), start, move))
    return done.select(*key, F.col("s.current").alias("current_state"), F.col("s.last").alias("last_success_state"), F.col("s.moves").alias("n_moves"), F.col("s.illegal").alias("n_illegal"))


def missing_pages(wanted: DataFrame, have: DataFrame, key: list[str]) -> DataFrame:
    return wanted.join(have, key, "left_anti")


def resumed(wanted: DataFrame, checkpoints: DataFrame, legacy: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The wanted pages with what is known of them: a checkpoint before a legacy stage document, column by column."""
    a = checkpoints.select(*key, *[F.col(c).alias(f"_a_{c}") for c in columns])
    b = legacy.select(*key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    return wanted.join(a, key, "left").join(b, key, "left").select(*wanted.columns, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns])


def export_text(p: DataFrame) -> DataFrame:
    """pages with export_text and export_source: the final text of restored pages, else the repaired one, else what earlier stages left.

    Columns: current_state, last_success_state, final_text, repaired_text, has_structure_plan, has_repair_plan,
    legacy_restored, legacy_repaired, legacy_cleaned, primary_clean_text, rule_cleaned_text, raw_text."""
    state = effective(F.col("current_state"), F.col("last_success_state"))
    final = F.col("has_structure_plan") | at_least(state, "STRUCTURE_RESTORED")
    repaired = (F.coalesce("repaired_text", F.lit("")) != "") | F.col("has_repair_plan") | at_least(state, "REPAIRED")
    source = (
        F.when(final, "final_text").when(repaired, "repaired_text").when(F.col("legacy_restored").isNotNull(), "legacy_restored")
        .when(F.col("legacy_repaired").isNotNull(), "legacy_repaired").when(F.col("legacy_cleaned").isNotNull(), "legacy_cleaned").otherwise("page_state_fallback")
    )
    full = lambda c: F.when(F.col(c) != "", F.col(c))
    chosen = (
        F.when(source == "final_text", F.col("final_text")).when(source == "repaired_text", F.col("repaired_text")).when(source == "legacy_restored", F.col("legacy_restored"))
        .when(source == "legacy_repaired", F.col("legacy_repaired")).when(source == "legacy_cleaned", F.col("legacy_cleaned")).otherwise(F.coalesce(full("primary_clean_text"), full("rule_cleaned_text"), F.col("raw_text")))
    )
    return p.withColumn("export_source", source).withColumn("export_text", F.coalesce(chosen, F.lit("")))


def export_reason(p: DataFrame, book: str = "book") -> DataFrame:
    """pages with why each is left out of the export, or null. Columns: page_number, route_decision, page_type, review_tags, text."""
    text = strip(F.coalesce("text", F.lit("")))
    x = solid_lines(text)
    n = F.size(x)
    noted = tally(x, lambda y: has(y, P.EXPORT_NOTE_LINE) | has(y, P.EXPORT_REFERENCE, "i"))
    tagged = F.coalesce(F.arrays_overlap("review_tags", F.array(*[F.lit(t) for t in P.NOTE_TAGS])), F.lit(False))
    heavy = one_of(F.col("page_type"), ["reference_only"]) | (tagged & (n >= 3) & (noted >= F.greatest(F.lit(3), F.floor(n / 2))))
    body = (count(text, r"\b[А-Яа-яЁё]{4,}\b") >= 25) | (count(text, "[.!?…]") >= 3)
    total = F.count("*").over(W.partitionBy(book))
    nonbody = one_of(F.col("route_decision"), ["skip_nonbody_page"]) | one_of(F.col("page_type"), [*P.NONBODY_TYPES, "empty"])
    front = (total >= 20) & (F.col("page_number") <= 4) & (has(text, P.EXPORT_FRONT, "i") | ~body)
    back = (total >= 20) & (F.col("page_number") >= total - 3) & has(text, P.EXPORT_BACK, "i")
    reason = F.when(nonbody, "filtered_nonbody_page").when(blank(text), "filtered_empty_page").when(heavy, "filtered_note_heavy_page").when(front, "filtered_frontmatter_page").when(back, "filtered_backmatter_page")
    return p.withColumn("filter_reason", reason)


def monitoring(p: DataFrame) -> DataFrame:
    """(metric, key, n): counts of page states, of failures by agent, and of risks, repair and structure outcomes.

    Columns: current_state, risk_level, repair_status, structure_status, final_text_source, processing_history."""
    single = F.array(
        *[F.struct(F.lit(m).alias("metric"), c.alias("key")) for m, c in (
            ("state", F.coalesce(F.when(F.col("current_state") != "", F.col("current_state")), F.lit("UNKNOWN"))), ("risk", F.col("risk_level")), ("repair_status", F.col("repair_status")),
            ("structure_status", F.col("structure_status")), ("final_text_source", F.col("final_text_source")),
        )]
    )
    failures = F.transform(F.filter("processing_history", lambda e: e["to_state"] == P.FAILED), lambda e: F.struct(F.lit("failed_by_agent").alias("metric"), F.coalesce(e["agent"], F.lit("unknown")).alias("key")))
    both = F.concat(single, F.coalesce(failures, F.array().cast("array<struct<metric:string,key:string>>")))
    return p.select(F.explode(both).alias("x")).where("x.key IS NOT NULL AND x.key <> ''").groupBy("x.metric", "x.key").agg(F.count("*").alias("n"))
