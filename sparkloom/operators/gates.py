"""Release gates over evaluation results: rows (gate, severity, message). A release passes without a failure row.

Result tables are a suite's, dozens of rows; rules are expressions over joins of two or three of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import columns as C
from sparkloom.operators.evaluate import best_groups, mean_reciprocal_rank, unique_groups

LIMIT = 0.45
MARGIN = 0.05
LEAST_MRR = 0.65
GENERIC = tuple(f"G0{i}" for i in range(1, 6))
IDENTIFIER = tuple(f"I0{i}" for i in range(1, 7))
TASK = tuple(f"T0{i}" for i in range(1, 6))
OFFICIAL = (*(f"O0{i}" for i in range(1, 6)), "E06")
EXPOSED = tuple(f"E0{i}" for i in range(1, 7))
PRIMARY = (*GENERIC, *IDENTIFIER, *TASK)
GENERIC_FAMILY, OFFICIAL_FAMILY = "set_document_property", "official"
OTHER_FAMILIES = ("rest_operation_step", "groovy_stream", "edi_qualifier_map", "mcp_schema_cookie")


def _rows(df: DataFrame, gate: str, *message: Column | str, severity: str = "failure") -> DataFrame:
    text = F.concat(*[F.lit(m) if isinstance(m, str) else F.coalesce(m.cast("string"), F.lit("none")) for m in message])
    return df.select(F.lit(gate).alias("gate"), F.lit(severity).alias("severity"), text.alias("message"))


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _one(df: DataFrame, condition: Column, gate: str, *message: Column | str) -> DataFrame:
    return _rows(df.where(F.coalesce(condition, F.lit(True))), gate, *message)


def _expected(results: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row a wanted query, whether or not it was run."""
    return results.sparkSession.createDataFrame([(i,) for i in ids], "query_id string")


def query_hits(results: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(query_id, passed): any group of the query was found."""
    found = results.groupBy("query_id").agg(F.bool_or("hit").alias("found"))
    return _expected(results, ids).join(found, "query_id", "left").select("query_id", F.coalesce("found", F.lit(False)).alias("passed"))


def _fewer(results: DataFrame, ids: Sequence[str], least: int, gate: str) -> DataFrame:
    passed = query_hits(results, ids).agg(F.count_if("passed").alias("n"))
    return _one(passed, F.col("n") < least, gate, F.col("n"), f" of {len(ids)} queries pass, {least} are needed")


def _each(results: DataFrame, ids: Sequence[str], gate: str) -> DataFrame:
    return _rows(query_hits(results, ids).where(~F.col("passed")), gate, F.col("query_id"), " has no target among its hits")


def _groups_hit(results: DataFrame, wanted: Sequence[tuple[str, int]], gate: str) -> DataFrame:
    own = results.sparkSession.createDataFrame([list(w) for w in wanted], "query_id string, group_index int")
    found = own.join(results.select("query_id", "group_index", "hit"), ["query_id", "group_index"], "left")
    return _rows(found.where(~F.coalesce("hit", F.lit(False))), gate, F.col("query_id"), " group ", F.col("group_index"), " wasn't found")


def _best(results: DataFrame, ids: Sequence[str]) -> DataFrame:
    return _expected(results, ids).join(best_groups(results), "query_id", "left")


def _bounds(best: DataFrame, gate: str, rank: int | None = None, distance: float | None = LIMIT, status: bool = False) -> list[DataFrame]:
    out = []
    if rank is not None:
        out.append(_one(best, F.col("rank") > rank, gate, F.col("query_id"), " rank ", F.col("rank"), f", at most {rank}"))
    if distance is not None:
        out.append(_one(best, F.col("distance") > distance, gate, F.col("query_id"), " distance ", F.col("distance"), f", at most {distance}"))
    if status:
        out.append(_one(best, F.col("status") != "ok", gate, F.col("query_id"), " status ", F.col("status")))
    return out


def official_control(results: DataFrame) -> DataFrame:
    best = _best(results, OFFICIAL)
    return _all([*_bounds(best, "official", rank=3), _one(best, F.col("rank1_source_type") != "official", "official", F.col("query_id"), " first hit isn't official")])


def _zip(before: DataFrame, after: DataFrame, ids: Sequence[str]) -> DataFrame:
    own = before.where(F.col("query_id").isin(*ids)).select("query_id", "group_index", F.col("hit").alias("was"))
    return own.join(after.select("query_id", "group_index", F.col("hit").alias("now")), ["query_id", "group_index"])


def identifier_regression(before: DataFrame, after: DataFrame) -> DataFrame:
    """Lost identifier targets fail; those missed by both are noted."""
    pairs = _zip(before, after, IDENTIFIER)
    lost = _rows(pairs.where("was AND NOT now"), "identifier-regression", F.col("query_id"), " group ", F.col("group_index"), " was found before")
    never = _rows(pairs.where("NOT was AND NOT now"), "identifier-regression", F.col("query_id"), " group ", F.col("group_index"), " was never found", severity="advisory")
    return lost.unionByName(never)


def _distances(results: DataFrame, query: str, name: str) -> DataFrame:
    return _best(results, [query]).select("query_id", F.col("distance").alias(f"{name}_distance"), F.coalesce("rank", F.lit(C.MISS_RANK)).alias(f"{name}_rank"))


def fallback_release(b56: DataFrame, c0: DataFrame, b5: DataFrame, built: bool = True) -> DataFrame:
    """Gates of a release without descriptions."""
    spark = b56.sparkSession
    parts = [official_control(b56), _each(b56, IDENTIFIER, "identifier"), *_bounds(_best(b56, ["I06"]), "identifier", rank=2), _fewer(b56, TASK, 4, "task"), _groups_hit(b56, [("T02", 0), ("T03", 0), ("T03", 1)], "task")]
    first = lambda df, name: df.where("query_id = 'T02' AND group_index = 0").select("query_id", F.col("distance").alias(f"{name}_distance"))
    t02 = _expected(b56, ["T02"]).join(first(b56, "own"), "query_id", "left").join(first(c0, "base"), "query_id", "left")
    parts.append(_one(t02, F.col("own_distance") > LIMIT, "task", "T02 distance ", F.col("own_distance")))
    parts.append(_rows(t02.where(~C.improved(F.col("own_distance"), F.col("base_distance"), MARGIN)), "task", "T02 distance ", F.col("own_distance"), " isn't better than ", F.col("base_distance")))
    parts.append(_rows(_zip(b5, b56, IDENTIFIER + TASK).where("was AND NOT now"), "regression", F.col("query_id"), " group ", F.col("group_index"), " fell out"))
    g01 = _distances(b56, "G01", "own").join(_distances(c0, "G01", "base"), "query_id")
    parts.append(_rows(g01.where(~C.improved(F.col("own_distance"), F.col("base_distance"), MARGIN)), "generic", "G01 distance ", F.col("own_distance"), " isn't better than ", F.col("base_distance")))
    parts.append(_rows(g01.where("own_rank > base_rank"), "generic", "G01 rank ", F.col("own_rank"), " after ", F.col("base_rank")))
    recall = lambda df, name: df.where(F.col("query_id").isin(*GENERIC, *EXPOSED)).agg(F.count_if("hit").alias(name))
    parts.append(_rows(recall(b56, "own").join(F.broadcast(recall(c0, "base"))).where("own < base"), "recall", F.col("own"), " groups found, ", F.col("base"), " before"))
    notes = [("generic", "advisory", "a release without descriptions isn't held to the generic rescue gate")] + ([] if built else [("build", "failure", "build invariants don't hold")])
    return _all([*parts, spark.createDataFrame(notes, "gate string, severity string, message string")])


def full_release(b567: DataFrame, b56: DataFrame) -> DataFrame:
    """Gates of a release with descriptions."""
    groups = unique_groups(b567.where(F.col("query_id").isin(*PRIMARY)))
    told = groups.agg(F.count(F.lit(1)).alias("n"), F.count("rank").alias("hits"), F.count_if(F.col("distance") <= LIMIT).alias("within"), mean_reciprocal_rank(F.col("rank")).alias("mrr"))
    every = b567.where(F.col("query_id").isin(*EXPOSED[1:5]) & ~F.col("hit"))
    return _all([
        _fewer(b567, GENERIC, 4, "generic"), _each(b567, IDENTIFIER, "identifier"), _fewer(b567, TASK, 4, "task"), _fewer(b567, PRIMARY, 14, "companion"),
        _one(told, F.col("hits") < 15, "companion", F.col("hits"), " of ", F.col("n"), " distinct groups found, 15 are needed"),
        _one(told, F.col("within") < 14, "companion", F.col("within"), " of ", F.col("n"), " distinct groups near enough, 14 are needed"),
        _one(told, F.col("mrr") < LEAST_MRR - 1e-9, "companion", "MRR ", F.col("mrr")),
        _each(b567, ["G01"], "mandatory"), _groups_hit(b567, [("T02", 0), ("T03", 0), ("T03", 1)], "mandatory"),
        *_bounds(_best(b567, ["G01"]), "rescue", rank=2, status=True), official_control(b567), *_bounds(_best(b567, ["E01"]), "exposed", rank=2, status=True),
        _rows(every, "exposed", F.col("query_id"), " group ", F.col("group_index"), " wasn't found"), identifier_regression(b56, b567),
    ])


def _family(results: DataFrame, families: Sequence[str]) -> DataFrame:
    """Best group of each family; ValueError-like failure at run time if a family wasn't run."""
    wanted = results.sparkSession.createDataFrame([(f,) for f in families], "family string")
    best = best_groups(results, "family")
    found = wanted.join(best, "family", "left").withColumn("query_id", F.col("family"))
    known = F.coalesce(F.col("status"), F.raise_error(F.concat(F.lit("no result of family "), F.col("family"))).cast("string"))
    return found.withColumn("status", known)


def _holdout_official(results: DataFrame) -> list[DataFrame]:
    best = _family(results, [OFFICIAL_FAMILY])
    return [*_bounds(best, "holdout-official", rank=3), _one(best, F.col("rank1_source_type") != "official", "holdout-official", "first hit isn't official")]


def holdout_full(results: DataFrame) -> DataFrame:
    generic = _family(results, [GENERIC_FAMILY])
    note = lambda df, *m: _rows(df, "holdout-generic", *m, severity="advisory")
    return _all([
        _rows(results.where(~F.col("hit")), "holdout", F.col("family"), " group ", F.col("group_index"), " wasn't found"),
        *_bounds(generic, "holdout-generic", rank=2, distance=None, status=True), note(generic, "distance ", F.col("distance")),
        note(generic.where(F.coalesce(F.col("distance") > LIMIT, F.lit(True))), "distance ", F.col("distance"), f" is over {LIMIT}"),
        *_bounds(_family(results, OTHER_FAMILIES), "holdout", distance=None, status=True), *_holdout_official(results),
    ])


def holdout_fallback(results: DataFrame, base: DataFrame) -> DataFrame:
    """No family may fall behind the baseline in status, nor in rank where the baseline found its target."""
    families = (GENERIC_FAMILY, *OTHER_FAMILIES)
    own = _family(results, families).select("family", "status", F.coalesce("rank", F.lit(C.MISS_RANK)).alias("rank"))
    was = _family(base, families).select("family", F.col("status").alias("base_status"), F.coalesce("rank", F.lit(C.MISS_RANK)).alias("base_rank"), "hit")
    both = own.join(was, "family")
    return _all([
        *_holdout_official(results), _rows(both.where("hit AND rank > base_rank"), "holdout-regression", F.col("family"), " rank ", F.col("rank"), " after ", F.col("base_rank")),
        _rows(both.where(C.status_rank(F.col("status")) < C.status_rank(F.col("base_status"))), "holdout-regression", F.col("family"), " status ", F.col("status"), " after ", F.col("base_status")),
        _rows(both.where(~F.col("hit")), "holdout-regression", F.col("family"), " had no target to be compared with", severity="advisory"),
        _rows(both.limit(1), "holdout-generic", "a release without descriptions isn't held to the generic rescue gate", severity="advisory"),
    ])


def verdict(report: DataFrame) -> DataFrame:
    """One row: passed, failures, advisories."""
    return report.agg((F.count_if(F.col("severity") == "failure") == 0).alias("passed"), F.count_if(F.col("severity") == "failure").alias("failures"), F.count_if(F.col("severity") == "advisory").alias("advisories"))
