"""Product code remapping: exact, then reverse, then fuzzy.

Work happens per distinct code; rows only meet the result in one join at the end. The mapping is
``(row_no, old_code, old_name, new_code, new_name)`` with blanks as "" (see ``as_mapping``). No
side is broadcast by hint: adaptive execution does so where the measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import materialize
from orderloom.sources.tables import CODE_HEADER, NAME_HEADER

THRESHOLD = 0.70
PREFIX = 3


def last_wins(mapping: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The last row's values per key, as building a dict row by row would leave them."""
    return (mapping.groupBy(key).agg(F.max_by(F.struct(*values), F.col("row_no")).alias("_v"))
            .select(key, "_v.*"))


def _blank(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (c == "")


def _lookup(mapping: DataFrame) -> DataFrame:
    return last_wins(mapping, "old_code", ["new_code", "new_name"])


def _reverse_lookup(mapping: DataFrame) -> DataFrame:
    """new_code -> what its last old_code maps to."""
    back = last_wins(mapping.where("new_code <> ''"), "new_code", ["old_code"])
    target = _lookup(mapping).select("old_code", F.col("new_code").alias("_to"), F.col("new_name").alias("_name"))
    return back.join(target, "old_code").select("new_code", "_to", "_name")


def map_exact(data: DataFrame, mapping: DataFrame, code: str = CODE_HEADER) -> DataFrame:
    """Adds ``mapped_code, mapped_name``; NULL where the code is no old code."""
    table = _lookup(mapping).select(
        F.col("old_code").alias("_old"), F.col("new_code").alias("mapped_code"), F.col("new_name").alias("mapped_name"))
    return data.join(table, F.col(f"`{code}`") == F.col("_old"), "left").drop("_old")


def map_reverse(data: DataFrame, mapping: DataFrame, code: str = CODE_HEADER) -> DataFrame:
    """For rows still without a mapped code: the code may be a new code already.

    Adds ``reverse_hit``; a hit replaces both mapped values, even by "".
    """
    table = _reverse_lookup(mapping).withColumnRenamed("new_code", "_new")
    open_row = _blank("mapped_code") & ~_blank(F.col(f"`{code}`"))
    hit = F.col("_new").isNotNull() & open_row
    return (
        data.join(table, F.col(f"`{code}`") == F.col("_new"), "left")
        .withColumn("reverse_hit", hit)
        .withColumn("mapped_code", F.when(F.col("reverse_hit"), F.col("_to")).otherwise(F.col("mapped_code")))
        .withColumn("mapped_name", F.when(F.col("reverse_hit"), F.col("_name")).otherwise(F.col("mapped_name")))
        .drop("_new", "_to", "_name")
    )


# --- fuzzy ------------------------------------------------------------------------------------
#
# Two codes within k edits share a string that both reach by deleting at most k characters. So
# candidates come from equi joins on such shortened strings, for k = 1, 2, 3, and only codes whose
# best match is still open go on to the next k. The number of strings that share one shortened
# form depends on the alphabet and k, not on the size of the mapping. Long codes that stay open
# are cut into parts, one of which must survive with at most one edit.

_LENGTH_LIMIT = {1: 200, 2: 40, 3: 14}


def _shortened(texts: Column) -> Column:
    """All strings with one more character deleted."""
    one_less = lambda v: F.when(F.length(v) > 0, F.transform(
        F.sequence(F.lit(1), F.length(v)),
        lambda i: F.concat(F.substring(v, F.lit(1), i - 1), F.substring(v, i + 1, F.length(v)))))
    return F.array_distinct(F.flatten(F.array_compact(F.transform(texts, one_less))))


def _with_variants(df: DataFrame, k: int, tag: str) -> DataFrame:
    """One row per (deletions j <= k, shortened text)."""
    step = df.withColumn("_v0", F.array("res"))
    for j in range(1, k + 1):
        step = step.withColumn(f"_v{j}", _shortened(F.col(f"_v{j - 1}")))
    tagged = lambda j: F.transform(F.col(f"_v{j}"), lambda v: F.struct(F.lit(j).alias("j"), v.alias("v")))
    levels = F.flatten(F.array(*[tagged(j) for j in range(k + 1)]))
    return (step.select(*df.columns, F.explode(levels).alias("_s"))
            .select(*df.columns, F.col("_s.j").alias(tag), F.col("_s.v").alias("_v")))


class _Rule:
    """Threshold arithmetic on whole numbers: similarity >= p/q  <=>  q*(m-d) >= p*m."""

    def __init__(self, threshold: float):
        t = Fraction(str(threshold))
        self.p, self.q = t.numerator, t.denominator

    def edits(self, longest: Column) -> Column:
        return F.floor(longest * (self.q - self.p) / self.q).cast("int")


def _blocks(codes: DataFrame, mapping: DataFrame, rule: _Rule) -> tuple[DataFrame, DataFrame]:
    """Codes and targets with their block and what is left of the text inside the block."""
    targets = (mapping.where("new_code <> ''").groupBy("new_code")
               .agg(F.min_by(F.struct("row_no", "old_code"), F.col("row_no")).alias("_first"))
               .select("new_code", "_first.*"))
    targets = materialize(targets, "fuzzy-targets")
    spelled = F.array(*[F.struct(F.lit(n).alias("plen"), F.substring("new_code", 1, n).alias("prefix"))
                        for n in range(1, PREFIX + 1)])
    prefixes = (targets.select(F.explode(F.array_distinct(F.filter(
        spelled, lambda s: F.length(s["prefix"]) == s["plen"]))).alias("_p")).select("_p.*").distinct()
        .withColumn("found", F.lit(True)))
    plen = F.least(F.lit(PREFIX), F.length("code"))
    shaped = (codes.withColumn("plen", plen).withColumn("prefix", F.expr("substring(code, 1, plen)"))
              .join(prefixes, ["plen", "prefix"], "left")
              .withColumn("cut", F.when(F.col("found"), F.col("plen")).otherwise(0))
              .select("code", F.length("code").alias("n"), "cut",
                      F.expr("substring(code, 1, cut)").alias("block"),
                      F.expr("substring(code, cut + 1)").alias("res")))
    shaped = materialize(shaped, "fuzzy-codes")
    in_use = shaped.select("cut", "block").distinct()
    placed = targets.select(
        "*", F.length("new_code").alias("m"),
        F.explode(F.array(*[F.lit(i) for i in range(PREFIX + 1)])).alias("cut"))
    placed = (placed.where("cut <= m")
              .withColumn("block", F.expr("substring(new_code, 1, cut)"))
              .withColumn("res", F.expr("substring(new_code, cut + 1)"))
              .join(in_use, ["cut", "block"], "left_semi"))
    placed = materialize(placed, "fuzzy-placed")
    # The most edits that any target length in the block allows; codes out of reach of all end here.
    sizes = placed.select("cut", "block", "m").distinct()
    allowed = rule.edits(F.greatest("n", "m"))
    reach = (shaped.join(sizes, ["cut", "block"]).where(F.abs(F.col("n") - F.col("m")) <= allowed)
             .groupBy("code").agg(F.max(allowed).alias("reach")))
    return materialize(shaped.join(reach, "code"), "fuzzy-reach"), placed


def _best(pairs: DataFrame, rule: _Rule) -> DataFrame:
    """Best target per code; the first mapping row wins among equals."""
    longest = F.greatest("n", "m")
    within = pairs.withColumn("_d", F.levenshtein("c_res", "t_res"))
    within = within.where(rule.q * (longest - F.col("_d")) >= rule.p * longest)
    scored = within.withColumn("sim", 1 - F.col("_d") / longest)
    return (scored.groupBy("code")
            .agg(F.max(F.struct("sim", (-F.col("row_no")).alias("_rank"), "old_code")).alias("_b"))
            .select("code", "_b.*"))


def _close_pairs(codes: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    limit = _LENGTH_LIMIT[k]
    # Only targets that an open code of their block could reach are spelled out.
    band = codes.select("cut", "block", F.explode(F.sequence(F.col("n") - k, F.col("n") + k)).alias("m")).distinct()
    targets = targets.join(band, ["cut", "block", "m"], "left_semi")
    left = _with_variants(codes.where(F.length("res") <= limit).select("code", "n", "cut", "block", "res"), k, "_jc")
    right = _with_variants(
        targets.where(F.length("res") <= limit).select("row_no", "old_code", "m", "cut", "block", "res"), k, "_jt")
    joined = left.withColumnRenamed("res", "c_res").join(
        right.withColumnRenamed("res", "t_res"), ["cut", "block", "_v"])
    exact_cut = (F.greatest("_jc", "_jt") == k) | ((F.col("_jc") == 0) & (F.col("_jt") == 0))
    return joined.where(exact_cut)


def _parts(tau: Column) -> Column:
    """So many parts that ``tau`` edits leave one of them at most one edit."""
    return (F.floor(tau / 2) + 1).cast("int")


def _part_pairs(codes: DataFrame, targets: DataFrame, rule: _Rule) -> DataFrame:
    """Pairs of any length within the threshold, for codes the close pairs left open."""
    sizes = targets.select("cut", "block", "m").distinct()
    asked = (codes.select("code", "n", "cut", "block", F.col("res").alias("c_res")).join(sizes, ["cut", "block"])
             .withColumn("tau", rule.edits(F.greatest("n", "m"))).where(F.abs(F.col("n") - F.col("m")) <= F.col("tau"))
             .withColumn("h", _parts(F.col("tau"))))

    # Part i of a target of length L covers [i*L/h, (i+1)*L/h): the same formula on both sides.
    def spans(df: DataFrame, length: Column) -> DataFrame:
        df = df.withColumn("_len", length).select("*", F.explode(F.sequence(F.lit(0), F.col("h") - 1)).alias("part"))
        return (df.withColumn("_from", F.floor(F.col("part") * F.col("_len") / F.col("h")).cast("int"))
                .withColumn("_to", F.floor((F.col("part") + 1) * F.col("_len") / F.col("h")).cast("int")))

    wanted = asked.select("cut", "block", "m", "tau", "h").distinct()
    right = targets.select("row_no", "old_code", "m", "cut", "block", F.col("res").alias("t_res")).join(wanted, ["cut", "block", "m"])
    right = spans(right, F.length("t_res"))
    text = F.expr("substring(t_res, _from + 1, _to - _from)")
    right = (right.withColumn("_part", F.array(text))
             .withColumn("_v", F.explode(F.array_union(F.col("_part"), _shortened(F.col("_part")))))
             .drop("_len", "_from", "_to", "_part", "h"))

    left = spans(asked, F.col("m") - F.col("cut"))
    # For the last part that survives, each later one costs two edits; so at most 2*part+1 are left
    # to shift its start, and shifts on both sides together cannot cost more than tau.
    drift = F.col("n") - F.col("m")
    side = F.least(2 * F.col("part") + 1, F.col("tau"))
    low = F.greatest(-side, F.floor((drift - F.col("tau") - 1) / 2).cast("int"))
    high = F.least(side, F.ceil((drift + F.col("tau") + 1) / 2).cast("int"))
    reach = lambda shift: F.least(F.greatest(F.col("_from") + shift, F.lit(0)), F.length("c_res"))
    left = left.withColumn("_low", low).withColumn("_high", high).where("_low <= _high")
    starts = F.array_distinct(F.sequence(reach(F.col("_low")), reach(F.col("_high"))))
    width = F.col("_to") - F.col("_from")
    piece = lambda extra: F.transform(
        starts, lambda s: F.substring(F.col("c_res"), s + 1, F.greatest(F.lit(0), width + extra)))
    # A piece one longer or equally long meets the part after one deletion, a shorter one as it is.
    meets = F.array_distinct(F.concat(piece(-1), piece(0), _shortened(piece(0)), _shortened(piece(1))))
    left = left.withColumn("_v", F.explode(meets)).drop("_len", "_from", "_to", "h", "_low", "_high")
    return left.join(right, ["cut", "block", "m", "tau", "part", "_v"])


def best_matches(codes: DataFrame, mapping: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(code, best_old, similarity) for non-blank codes that reach the threshold.

    Targets are the non-blank new codes; if any of them starts with the first three characters of
    the code, only those. A best match with a blank old code counts as no match.
    """
    rule = _Rule(threshold)
    codes = codes.where(~_blank("code")).select("code").distinct()
    open_codes, targets = _blocks(codes, mapping, rule)
    found = []
    for k in (1, 2, 3):
        best = _best(_close_pairs(open_codes, targets, k), rule)
        # Closed if no target allows more than k edits, or if k+1 edits cannot do as well.
        ceiling = 1 - F.lit(k + 1) / (F.col("n") + k + 1)
        covered = F.length("res") + k <= _LENGTH_LIMIT[k]
        closed = covered & ((F.col("reach") <= k) | (F.coalesce("sim", F.lit(-1.0)) > ceiling))
        judged = materialize(open_codes.join(best, "code", "left").withColumn("closed", closed), f"fuzzy-{k}")
        found.append(judged.where("sim IS NOT NULL").select("code", "sim", "_rank", "old_code"))
        open_codes = judged.where("NOT closed").drop("sim", "_rank", "old_code", "closed")
        if open_codes.isEmpty():
            break
    else:
        found.append(_best(_part_pairs(open_codes, targets, rule), rule))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return (every.groupBy("code").agg(F.max(F.struct("sim", "_rank", "old_code")).alias("_b"))
            .where("_b.old_code <> ''")
            .select("code", F.col("_b.old_code").alias("best_old"), F.col("_b.sim").alias("similarity")))


def map_fuzzy(data: DataFrame, mapping: DataFrame, threshold: float = THRESHOLD, code: str = CODE_HEADER) -> DataFrame:
    """For rows still without a mapped code: the values of the most similar new code's row.

    Adds ``fuzzy_hit`` and ``similarity``; a hit replaces both mapped values, even by "".
    """
    name = F.col(f"`{code}`")
    waiting = _blank("mapped_code") & ~_blank(name)
    best = best_matches(data.where(waiting).select(name.alias("code")), mapping, threshold)
    target = _lookup(mapping).select(F.col("old_code").alias("best_old"), F.col("new_code").alias("_to"),
                                     F.col("new_name").alias("_name"))
    table = best.join(target, "best_old").select(F.col("code").alias("_code"), "_to", "_name", "similarity")
    return (
        data.join(table, (name == F.col("_code")) & waiting, "left")
        .withColumn("fuzzy_hit", F.col("_code").isNotNull())
        .withColumn("mapped_code", F.when(F.col("fuzzy_hit"), F.col("_to")).otherwise(F.col("mapped_code")))
        .withColumn("mapped_name", F.when(F.col("fuzzy_hit"), F.col("_name")).otherwise(F.col("mapped_name")))
        .drop("_code", "_to", "_name")
    )


# --- cascade ----------------------------------------------------------------------------------

def resolve_codes(counted: DataFrame, mapping: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All three steps for a table of distinct ``code``s; further columns pass through."""
    exact = map_exact(counted, mapping, "code").withColumn("exact_hit", F.col("mapped_code").isNotNull())
    back = materialize(map_reverse(exact, mapping, "code"), "remap")
    return map_fuzzy(back, mapping, threshold, "code")


def apply_mapping(data: DataFrame, mapping: DataFrame, threshold: float = THRESHOLD,
                  code: str = CODE_HEADER, name: str = NAME_HEADER) -> DataFrame:
    """The data with code and name overwritten wherever a non-blank new value was found."""
    old = F.col(f"`{code}`")
    codes = data.select(old.alias("code")).where("code IS NOT NULL").distinct()
    changes = (resolve_codes(codes, mapping, threshold)
               .where(~_blank("mapped_code") | ~_blank("mapped_name"))
               .select(F.col("code").alias("_code"), "mapped_code", "mapped_name"))
    keep = lambda new, current: F.when(~_blank(new), F.col(new)).otherwise(current)
    columns = {c: F.col(f"`{c}`") for c in data.columns}
    columns[code] = keep("mapped_code", old)
    if name in columns:
        columns[name] = keep("mapped_name", columns[name])
    return (data.join(changes, old == F.col("_code"), "left")
            .select(*[c.alias(n) for n, c in columns.items()]))


def mapping_stats(data: DataFrame, mapping: DataFrame, threshold: float = THRESHOLD,
                  code: str = CODE_HEADER) -> DataFrame:
    """Row counts per step. An exact hit on a blank new code can count again in a later step."""
    counted = data.groupBy(F.col(f"`{code}`").alias("code")).agg(F.count(F.lit(1)).alias("_n"))
    hits = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.col("_n"))), F.lit(0))
    return (resolve_codes(counted, mapping, threshold)
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_count"), hits("exact_hit").alias("exact_matched_count"),
                 hits("reverse_hit").alias("reverse_matched_count"), hits("fuzzy_hit").alias("fuzzy_matched_count"))
            .withColumn("matched_count", F.col("exact_matched_count") + F.col("reverse_matched_count")
                        + F.col("fuzzy_matched_count")))
