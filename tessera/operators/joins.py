"""Joins: guarded lookups, uniqueness guard, band and pair matching."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

class DuplicateKeyError(ValueError):
    pass


def key_profile(df: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """(rows, distinct keys, keys occurring more than once) in one job."""
    r = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"),
                F.count_if(F.col("_n") > 1).alias("dups"))
           .first())
    return int(r["rows"]), int(r["keys"]), int(r["dups"])


def duplicate_keys(df: DataFrame, keys: Sequence[str], sample: int = 5) -> DataFrame:
    """Up to ``sample`` keys that occur more than once, in key order."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1).orderBy(*keys).limit(sample))


def guard_unique(df: DataFrame, keys: Sequence[str], sample: int = 5) -> None:
    """Raise ``DuplicateKeyError`` listing sample duplicates."""
    dups = key_profile(df, keys)[2]
    if dups:
        shown = [tuple(r[k] for k in keys) for r in duplicate_keys(df, keys, sample).collect()]
        raise DuplicateKeyError(
            f"lookup must hold a single row per {tuple(keys)}; {dups} duplicated keys, e.g. {shown}")


def unique_lookup(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with ``_matched``, grouped in the plan itself: a key that occurs twice raises when it is read."""
    others = [c for c in lookup.columns if c not in keys]
    rows = F.first(F.struct(*others, F.lit(True).alias("_matched"))).alias("_r")
    name = F.concat(F.lit("lookup must hold a single row per key; it holds several of "), F.to_json(F.struct(*keys)))
    return (lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), rows)
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others],
                    F.when(F.col("_n") > 1, F.raise_error(name).cast("boolean")).otherwise(F.col("_r._matched")).alias("_matched")))


def suffix_overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Rename right-side non-key columns that also exist on the left."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    for c in right.columns:
        if c in clash:
            right = right.withColumnRenamed(c, c + suffix)
    return right


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                suffix: str = "_r", require_unique: bool = True, null_safe: bool = False) -> DataFrame:
    """Left (or inner) lookup join with a uniqueness guard on the lookup side
    and suffixing of clashing columns. ``_matched`` tells real misses from
    matched rows whose values are NULL. Whether the lookup is broadcast is
    left to the planner, which goes by its bytes.

    The lookup side is materialised once (reliable checkpoint): the guard
    and the join then read the same rows, nothing upstream of the lookup is
    recomputed, and filters the optimizer infers from the join keys apply to
    stored columns instead of re-running key clean-up."""
    right = suffix_overlaps(left, right, keys, suffix).withColumn("_matched", F.lit(True))
    right = cut_lineage(right)
    if require_unique:
        guard_unique(right, keys)
    if null_safe:
        cond = None
        r = right.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in right.columns])
        for k in keys:
            e = left[k].eqNullSafe(r[f"_rk_{k}"])
            cond = e if cond is None else cond & e
        out = left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])
    else:
        out = left.join(right, list(keys), how)
    return out.withColumn("_matched", F.coalesce(F.col("_matched"), F.lit(False)))


def band_match(issues: DataFrame, attempts: DataFrame, keys: Sequence[str], issue_band: str,
               attempt_band: str, drift: int) -> DataFrame:
    """Pairs (issue, attempt) equal on ``keys`` whose band indices differ by at
    most ``drift``. The attempt side is expanded into its ``2*drift+1``
    admissible issue bands, so the match is a plain equi join (hash or
    sort-merge), never a nested loop."""
    expanded = attempts.withColumn(
        "_band", F.explode(F.sequence(F.col(attempt_band) - drift, F.col(attempt_band) + drift)))
    i = issues.withColumn("_band", F.col(issue_band))
    return i.join(expanded, [*keys, "_band"], "inner").drop("_band")


def first_offset_pair(df: DataFrame, group: str, pos: str, value: str, target) -> DataFrame:
    """Per group, the pair a single left-to-right pass with a value->last
    position map returns: the first ``j`` having an earlier ``i`` with
    ``v_i + v_j = target``, paired with the latest such ``i`` before ``j``.

    No pairs are enumerated. Step 1: ``j`` qualifies iff the first position
    of its complement is earlier (aggregate + equi join on a unique key).
    Step 2: one row per group probes its complement once more for the
    latest earlier position. Linear in the rows.
    """
    firsts = df.groupBy(group, F.col(value).alias("_v")).agg(F.min(pos).alias("_first"))
    probe = df.select(group, F.col(pos).alias("_j"), (F.lit(target) - F.col(value)).alias("_v"))
    hits = probe.join(firsts, [group, "_v"], "inner").where(F.col("_first") < F.col("_j"))
    best = hits.groupBy(group).agg(F.min(F.struct("_j", "_v")).alias("_p")) \
               .select(group, F.col("_p._j").alias("_j"), F.col("_p._v").alias("_v"))
    cand = df.select(group, F.col(pos).alias("_i"), F.col(value).alias("_v"))
    latest = cand.join(best, [group, "_v"], "inner").where(F.col("_i") < F.col("_j")) \
                 .groupBy(group, "_j").agg(F.max("_i").alias("_i"))
    return latest.select(group, F.col("_i").alias("i"), F.col("_j").alias("j"))


def zero_sum_triples(df: DataFrame, group: str, value: str, values_per_task: int = 5_000) -> DataFrame:
    """Distinct value triples (a <= b <= c, a + b + c = 0) per group, honouring multiplicity.

    Rows are first reduced to distinct (group, value, count). The least of three values with sum 0 is at most 0 and the
    middle one at most minus half of it, so only such pairs are formed, inside the join's condition. The least values of
    a group are dealt over a part for every ``values_per_task`` values it has, its other values are repeated in each:
    a hot group's pairs are formed in many tasks."""
    d = df.groupBy(group, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("m"))
    parts = d.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / values_per_task).alias("_parts"))
    own = d.join(parts, group)
    a = own.where(F.col("v") <= 0).select(group, F.pmod(F.xxhash64("v"), F.col("_parts")).alias("_part"),
                                          F.col("v").alias("a"), F.col("m").alias("ma"))
    b = own.select(group, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part"),
                   F.col("v").alias("b"), F.col("m").alias("mb"))
    c = d.select(group, F.col("v").alias("c"), F.col("m").alias("mc"))
    ab = (a.join(b, [group, "_part"]).where((F.col("b") >= F.col("a")) & (F.col("b") * 2 <= -F.col("a")))
          .withColumn("c", -(F.col("a") + F.col("b"))))
    need = (F.when((F.col("a") == F.col("b")) & (F.col("b") == F.col("c")), F.col("ma") >= 3)
             .when(F.col("a") == F.col("b"), F.col("ma") >= 2)
             .when(F.col("b") == F.col("c"), F.col("mb") >= 2)
             .otherwise(F.lit(True)))
    return ab.join(c, [group, "c"]).where(need).select(group, "a", "b", "c")
