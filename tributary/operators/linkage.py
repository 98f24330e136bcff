"""Blocked similarity linkage: for each left name the best right names.

* Names are reduced to distinct (block, token-sorted name) first.
* score >= cutoff means LCS >= need, where need follows from the two lengths. Names
  of a block and a pair of lengths form a cell; cells of lengths that cannot reach the
  cutoff do not exist.
* In a cell the characters that may stay unmatched are known: `spare_l` of the left and
  `spare_r` of the right name, together the bound. The right name is cut into one piece
  more than the bound. Unmatched characters cannot touch every piece, and there is one
  piece, number i, with exactly i of them before it and none inside (pigeonhole over the
  running sums). That piece stands in the left name, moved by as many places as left ones
  exceed right ones among the i, so the left name looks up (spare_l + 1) (spare_r + 1)
  pieces of text in an index of the right pieces (segment signatures; cf. Li, Deng, Wang
  and Feng 2012, with insertions and deletions only).
* Small cells, and those whose pieces would be too short, compare all their names instead,
  in blocks. Which way a cell takes follows from the counted names of both sides; results
  are the same. Where only the best are wanted, cells whose names share pieces (a host, a
  prefix) compare all as well: a block then keeps the best of each left name and computes
  the LCS of those alone that their characters allow to come before these.
* A pair that meets passes a test on 128-bit sets of its characters and, if it met on
  several pieces, counts at the first of them alone.
* Cutoffs are tried from equal names downwards.  A left name that has found as
  many right rows as are wanted is finished, because lower cutoffs cannot change
  its best ones.  Names in dense neighbourhoods never reach the low cutoffs.

Every step is exact: the result equals that of comparing all pairs in a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.fixed_values import (
    ACTION_REVIEW,
    ACTION_VERIFY,
    CANDIDATE_LIMIT,
    CANDIDATE_SCORE,
    DATE_WINDOW_DAYS,
    MATCH_SCORE,
    METHOD_FUZZY,
)
from tributary.functions.dates import day_difference
from tributary.functions.similarity import NearestNames, lcs_length, reaches, score
from tributary.functions.text import block_key, token_sorted
from tributary.operators.skew import skew_join
from tributary.staging import stage

CUTOFF_STEPS = (100, 88)  # tried before the final cutoff; 100 stands for equal names

#: Compared pairs that a row of the index of pieces is worth.
INDEX_COST = 1
#: Characters of a piece at least.
_SHORTEST_PIECE = 3
#: Names of each side that meet in one block where a cell compares all.
_BLOCK = 512
#: The same where only the best are kept, and pairs of a task there.
_LEFT_BLOCK, _RIGHT_BLOCK, _PAIRS_A_TASK = 2048, 16384, 1 << 22
#: Pairs of a block that a meeting on a piece is worth, and one of how many names are counted for it.
_MEETING_COST, _COUNTED = 10, 8


def linkage_rows(
    df: DataFrame,
    row_id: str = "employee_id",
    name: str = "employee_name",
    block_on: str = "last_name",
    date: str = "hire_date",
    source: str = "source",
    order: str = "_ord",
) -> DataFrame:
    """The columns that linkage needs, under fixed names, with block and sorted name."""
    return df.select(
        F.col(order).alias("ord"),
        F.col(row_id).alias("id"),
        F.col(source).alias("source"),
        F.col(name).alias("name"),
        F.col(date).alias("date"),
        block_key(F.col(block_on)).alias("block"),
        token_sorted(F.col(name)).alias("key"),
    ).where(F.col("name").isNotNull())


def _needed(total: str, cutoff: int) -> str:
    """SQL: smallest LCS of a pair of this total length that reaches the cutoff."""
    return f"int(({cutoff} * ({total}) + 199) div 200)"


def _computed_once(sql: str) -> Column:
    """The value as the only row of an explode, which Spark does not copy into later
    expressions; inside a lambda a copy would be computed for every element."""
    return F.explode(F.array(F.expr(sql)))


def with_character_sets(keys: DataFrame) -> DataFrame:
    """Adds the length of `key` and two bit sets of its characters.

    Each character and running number of its repetitions has one of 128 bits: each bit
    that only one of two names has is a character that the other one lacks.
    """
    sorted_chars = "array_sort(regexp_extract_all(key, '(?s)(.)'))"
    places = "transform(_chars, (char, place) -> pmod(xxhash64(char, place - array_position(_chars, char)), 128))"

    def bits(low: int) -> Column:
        own = f"filter(_places, p -> p >= {low} and p < {low + 64})"
        return F.expr(f"aggregate({own}, 0L, (bits, p) -> bits | shiftleft(1L, int(p - {low})))")

    return (
        keys.withColumn("_chars", _computed_once(sorted_chars))
        .withColumn("_places", _computed_once(places))
        .withColumns({"length": F.length("key"), "low_bits": bits(0), "high_bits": bits(64)})
        .drop("_chars", "_places")
    )


def cells(left: DataFrame, right: DataFrame, cutoff: int, index_cost: float = INDEX_COST) -> DataFrame:
    """block, l_length, r_length of names that can reach the cutoff, names of both sides, and how they meet.

    `pieces` is null where all names of the cell are compared.
    """
    def counted(names: DataFrame, side: str) -> DataFrame:
        rows = names.where("length > 0").groupBy("block", F.col("length").alias(f"{side}_length"))
        return rows.agg(F.count("*").alias(f"{side}_names"))

    need = _needed("l_length + r_length", cutoff)
    both = counted(left, "l").join(counted(right, "r"), "block")
    possible = both.withColumn("need", F.expr(need)).where("need <= least(l_length, r_length)").withColumns(
        {"spare_l": F.expr("l_length - need"), "spare_r": F.expr("r_length - need")})
    pieces = F.expr("spare_l + spare_r + 1")
    index_rows = F.expr("r_names * (spare_l + spare_r + 1) + l_names * (spare_l + 1) * (spare_r + 1)")
    by_pieces = (F.col("r_length") >= pieces * _SHORTEST_PIECE) & (index_rows * index_cost <= F.expr("l_names * r_names"))
    return possible.withColumns({"index_rows": index_rows, "pieces": F.when(by_pieces, pieces)})


_BEGIN = "int(piece * r_length div pieces)"
_LENGTH = "int((piece + 1) * r_length div pieces - piece * r_length div pieces)"


def _found_at(piece: str) -> str:
    """SQL: places of the left name, from 0, at which a piece of the right one may stand."""
    unmatched = f"sequence(greatest(0, {piece} - spare_l), least({piece}, spare_r))"
    begin = _BEGIN.replace("piece ", f"{piece} ")
    return f"transform({unmatched}, r -> {begin} + {piece} - 2 * r)"


def meetings(left: DataFrame, right: DataFrame, planned: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Rows of both sides as a and b, and the condition on which they meet.

    Where all are compared, a right name waits under its own length for the left names of
    all lengths that fit; where pieces are, both sides have a row a piece.
    """
    cell = ["block", "l_length", "r_length"]
    whole, cut = planned.where("pieces IS NULL"), planned.where("pieces IS NOT NULL")
    waiting = whole.groupBy("block", "r_length").agg(
        F.ceil(F.sum("l_names") / _BLOCK).cast("int").alias("l_blocks"), F.ceil(F.first("r_names") / _BLOCK).cast("int").alias("r_blocks"))
    l = left.withColumn("l_length", F.col("length"))
    r = right.withColumn("r_length", F.col("length"))

    def in_blocks(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.withColumn(f"_{own}", F.pmod(F.xxhash64("key"), F.col(f"{own}_blocks")).cast("int")).withColumn(
            f"_{other}", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
        rows = rows.withColumn("meeting", F.xxhash64("block", "r_length", "_l", "_r")).withColumn("piece", F.lit(None).cast("int"))
        return rows.drop("_l", "_r", "l_blocks", "r_blocks")

    def in_pieces(rows: DataFrame, texts: str) -> DataFrame:
        rows = rows.withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)"))).withColumn("_text", F.explode(F.expr(texts)))
        return rows.withColumn("meeting", F.xxhash64(*cell, "piece", "_text")).drop("_text")

    known = [*cell, "spare_l", "spare_r", "pieces"]
    looked_up = (f"array_distinct(transform(filter({_found_at('piece')}, at -> at >= 0 and at + {_LENGTH} <= l_length), "
                 f"at -> substring(key, at + 1, {_LENGTH})))")
    a = in_blocks(skew_join(l, whole.select(*known).join(waiting, ["block", "r_length"]), ["block", "l_length"]), "l", "r")
    a = a.unionByName(in_pieces(skew_join(l, cut.select(*known), ["block", "l_length"]), looked_up))
    b = in_blocks(skew_join(r, waiting, ["block", "r_length"]), "r", "l")
    indexed = in_pieces(skew_join(r, cut.select(*known), ["block", "r_length"]), f"array(substring(key, {_BEGIN} + 1, {_LENGTH}))")
    return a.alias("a"), b.unionByName(indexed.drop("l_length", "spare_l", "spare_r", "pieces")).alias("b"), F.expr("a.meeting = b.meeting")


def _first_meeting() -> Column:
    """Whether no piece before the one on which two names met stands in the left name."""
    earlier = "transform(sequence(0, piece - 1), i -> struct(i, " + _found_at("i") + " as places))"
    length = _LENGTH.replace("piece ", "e.i ").replace("(piece + 1)", "(e.i + 1)")
    begin = _BEGIN.replace("piece ", "e.i ")
    stands = (f"exists(e.places, at -> at >= 0 and at + {length} <= l_length "
              f"and substring(key, at + 1, {length}) = substring(right_key, {begin} + 1, {length}))")
    return F.expr(f"piece is null or piece = 0 or not exists({earlier}, e -> {stands})")


def similar_pairs(left: DataFrame, right: DataFrame, cutoff: int, index_cost: float = INDEX_COST, planned: DataFrame | None = None) -> DataFrame:
    """Pairs of distinct names of one block whose score reaches the cutoff, of all cells or the planned ones.

    Inputs come from with_character_sets; further columns of the right side stay.  The
    exploded sides are far larger than their inputs suggest, hence the hint for
    a join that shuffles, spills and splits skewed partitions.
    """
    own = ("block", "key", "length", "low_bits", "high_bits")
    others = [c for c in right.columns if c not in own]
    planned = stage(cells(left, right, cutoff, index_cost), "linkage-cells") if planned is None else planned
    a, b, same = meetings(left, right, planned)

    def lacking(one: str, other: str) -> str:
        return " + ".join(f"bit_count({one}.{bits} & ~{other}.{bits})" for bits in ("low_bits", "high_bits"))

    met = a.join(  # conditions are tested in this order
        b.hint("merge"),
        same & F.expr(
            f"""{lacking('a', 'b')} <= a.spare_l and {lacking('b', 'a')} <= a.spare_r
            and a.r_length = b.r_length and a.block = b.block and a.piece <=> b.piece"""
        ),
    )
    total = F.col("l_length") + F.col("r_length")
    measured = met.select(
        "a.block", "a.key", F.col("b.key").alias("right_key"), *[f"b.{c}" for c in others],
        *[f"a.{c}" for c in ("l_length", "r_length", "spare_l", "spare_r", "pieces", "piece")],
        lcs_length("a.key", "b.key").alias("lcs"),
    )
    return measured.where(reaches(F.col("lcs"), total, cutoff)).where(_first_meeting()).select(
        "block", "key", "right_key", *others, score(F.col("lcs"), total).alias("score")
    )


def _with_rare_pieces(left: DataFrame, right: DataFrame, planned: DataFrame) -> DataFrame:
    """Cells with `pieces` only where names seldom meet on them, by the counts of some names of both sides."""
    cell = ["block", "l_length", "r_length"]
    some = F.expr(f"pmod(xxhash64(key), {_COUNTED}) = 0")
    a, b, _ = meetings(left.where(some), right.where(some), planned.where("pieces IS NOT NULL"))
    met = (
        a.groupBy("meeting", *cell).agg(F.count("*").alias("a_rows"))
        .join(b.groupBy("meeting").agg(F.count("*").alias("b_rows")), "meeting")
        .groupBy(*cell).agg((F.sum(F.col("a_rows") * F.col("b_rows")) * _COUNTED**2).alias("met"))
    )
    seldom = F.coalesce("met", F.lit(0)) * _MEETING_COST <= F.col("l_names") * F.col("r_names")
    return planned.join(met, cell, "left").withColumn("pieces", F.when(seldom, F.col("pieces"))).drop("met")


def nearest_in_blocks(left: DataFrame, right: DataFrame, planned: DataFrame, cutoff: int, limit: int) -> DataFrame:
    """Pairs of the planned cells whose score reaches the cutoff, among them the `limit` best of each left name.

    A left name has at most `limit` pairs a block. Right names come in the order of
    `first_ord`; blocks are dealt to tasks by their number of pairs, not by bytes.
    """
    others = [c for c in right.columns if c not in ("block", "key", "length", "low_bits", "high_bits")]
    kinds = {field.name: field.dataType for field in right.schema}
    waiting = planned.groupBy("block", "r_length").agg(
        F.ceil(F.sum("l_names") / _LEFT_BLOCK).cast("int").alias("l_blocks"),
        F.ceil(F.first("r_names") / _RIGHT_BLOCK).cast("int").alias("r_blocks"))
    known = planned.select("block", "l_length", "r_length").join(waiting, ["block", "r_length"])

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return rows.withColumns({
            f"_{own}": F.pmod(F.xxhash64("key"), F.col(f"{own}_blocks")).cast("int"), "_side": F.lit(int(own == "r"))}).withColumn(
            f"_{other}", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))

    l = dealt(skew_join(left.withColumn("l_length", F.col("length")), known, ["block", "l_length"]), "l", "r")
    l = l.withColumns({c: F.lit(None).cast(kinds[c]) for c in others})
    r = dealt(skew_join(right.withColumn("r_length", F.col("length")), waiting, ["block", "r_length"]), "r", "l")
    place = ["block", "r_length", "_l", "_r"]
    columns = [*place, "_side", "key", "low_bits", "high_bits", *others]
    pairs = planned.agg(F.sum(F.col("l_names").cast("double") * F.col("r_names"))).first()[0] or 0
    rows = l.select(*columns).unionByName(r.select(*columns)).repartition(int(pairs // _PAIRS_A_TASK) + 1, *place)
    fields = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("key", T.StringType()), T.StructField("right_key", T.StringType()),
        *[T.StructField(c, kinds[c]) for c in others], T.StructField("lcs", T.IntegerType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, waiting, found, met = None, [], [], None, []

        def sets(run: pa.RecordBatch) -> np.ndarray:
            return np.column_stack([run.column(c).to_numpy().view(np.uint64) for c in ("low_bits", "high_bits")])

        def ended() -> Iterator[pa.RecordBatch]:
            if found is not None and len(found.best()[0]):
                l, r, lcs = found.best()
                rights = pa.Table.from_batches(met).take(pa.array(r)).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at[0]] * len(l), pa.string()), pa.array(names, pa.string()).take(pa.array(l)),
                     *[rights.column(c).combine_chunks() for c in ("key", *others)], pa.array(lcs.astype(np.int32))],
                    ["block", "key", "right_key", *others, "lcs"])

        for batch in batches:
            if not len(batch):
                continue
            turns = np.zeros(len(batch) - 1, bool)
            for c in (*place, "_side"):
                turns |= pc.not_equal(batch.column(c)[1:], batch.column(c)[:-1]).to_numpy(zero_copy_only=False)
            for begin, end in zip([0, *(np.flatnonzero(turns) + 1)], [*(np.flatnonzero(turns) + 1), len(batch)], strict=True):
                run = batch.slice(begin, end - begin)
                here = tuple(run.column(c)[0].as_py() for c in place)
                if here != at:
                    yield from ended()
                    at, names, waiting, found, met = here, [], [], None, []
                if run.column("_side")[0].as_py() == 0:
                    names += run.column("key").to_pylist()
                    waiting.append(sets(run))
                elif names:
                    found = found or NearestNames(names, np.concatenate(waiting), here[1], cutoff, limit)
                    found.meet(run.column("key").to_pylist(), sets(run))
                    met.append(run.select(["key", *others]))
        yield from ended()

    near = rows.sortWithinPartitions(*place, "_side", "first_ord").mapInArrow(search, fields)
    total = F.length("key") + F.length("right_key")
    return near.select("block", "key", "right_key", *others, score(F.col("lcs"), total).alias("score"))


def nearest_pairs(left: DataFrame, right: DataFrame, cutoff: int, limit: int) -> DataFrame:
    """Pairs whose score reaches the cutoff, among them the `limit` best of each left name."""
    planned = stage(cells(left, right, cutoff, _MEETING_COST), "linkage-cells")
    planned = stage(_with_rare_pieces(left, right, planned), "linkage-cells")
    rare, common = planned.where("pieces IS NOT NULL"), planned.where("pieces IS NULL")
    return nearest_in_blocks(left, right, common, cutoff, limit).unionByName(similar_pairs(left, right, cutoff, planned=rare))


def _best(pairs: DataFrame, members: DataFrame, limit: int) -> DataFrame:
    """The `limit` best right rows per left name: score, then input order.

    They belong to the best `limit` right names, so only these look up their rows,
    and at most limit² rows of a left name are ever collected.
    """
    ranking = Window.partitionBy("block", "key").orderBy(F.desc("score"), "first_ord")
    near = (
        pairs.withColumn("_rank", F.row_number().over(ranking))
        .where(F.col("_rank") <= limit)
        .select("block", "key", "right_key", "score")
    )
    rows = members.select("block", F.col("key").alias("right_key"), "members")
    placed = F.transform(
        "members",
        lambda m: F.struct(
            (-F.col("score")).alias("negative"),
            m["ord"].alias("ord"), m["id"].alias("id"), m["source"].alias("source"),
            m["name"].alias("name"), m["date"].alias("date"),
            F.col("score").alias("score"),
        ),
    )
    return (
        near.join(rows, ["block", "right_key"])  # both sides shuffled: AQE splits hot names
        .groupBy("block", "key")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list(placed))), 1, limit).alias("candidates"))
    )


def best_candidates(
    left: DataFrame,
    right: DataFrame,
    cutoff: int = CANDIDATE_SCORE,
    limit: int = CANDIDATE_LIMIT,
    steps: tuple[int, ...] = CUTOFF_STEPS,
) -> DataFrame:
    """Per distinct left name (block, key) its best right rows as an ordered array.

    `steps` are the cutoffs tried before the final one.
    """
    per_name = Window.partitionBy("block", "key").orderBy("ord")
    members = (
        right.withColumn("_rank", F.row_number().over(per_name))
        .where(F.col("_rank") <= limit)
        .groupBy("block", "key")
        .agg(
            F.array_sort(F.collect_list(F.struct("ord", "id", "source", "name", "date"))).alias("members")
        )
        .withColumn("first_ord", F.get("members", F.lit(0))["ord"])
    )
    members = stage(members, "linkage-right")
    targets = stage(with_character_sets(members.select("block", "key", "first_ord")), "linkage-right")
    wanted = left.where("name != ''").select("block", "key").distinct()
    wanted = stage(with_character_sets(wanted), "linkage-left")

    def equal_names(names: DataFrame) -> DataFrame:
        same = names.select("block", "key").join(
            members.select("block", "key", "first_ord"), ["block", "key"]
        )
        return same.select("*", F.col("key").alias("right_key"), F.lit(100.0).alias("score"))

    finished = []
    for step in (*steps, cutoff):
        if step == 100:
            pairs = equal_names(wanted)
        else:  # empty names have no characters to meet on
            blank = equal_names(wanted.where("length = 0"))
            pairs = nearest_pairs(wanted, targets, step, limit).unionByName(blank)
        found = stage(_best(pairs, members, limit), "linkage-found")
        if step != cutoff:
            found = found.where(F.size("candidates") >= limit)
            wanted = wanted.join(found.select("block", "key"), ["block", "key"], "left_anti")
        finished.append(found)
    return reduce(DataFrame.unionByName, finished)


def linked_rows(
    left: DataFrame,
    right: DataFrame,
    cutoff: int = CANDIDATE_SCORE,
    limit: int = CANDIDATE_LIMIT,
    match_score: int = MATCH_SCORE,
    window_days: int = DATE_WINDOW_DAYS,
) -> DataFrame:
    """Left rows that have a candidate, with their ranked candidates and the match.

    `candidates` holds id, source, name, date, score and day difference in rank
    order; `match` is the first that reaches the score within the date window.
    """
    found = best_candidates(left, right, cutoff, limit)
    named = left.where("name != ''")
    rows = skew_join(named, found, ["block", "key"])
    candidates = F.transform(
        "candidates",
        lambda c: F.struct(
            c["ord"].alias("ord"), c["id"].alias("id"), c["source"].alias("source"),
            c["name"].alias("name"), c["date"].alias("date"), c["score"].alias("score"),
            day_difference(F.col("date"), c["date"]).alias("days"),
        ),
    )
    confirmed = F.filter(
        "candidates",
        lambda c: (c["score"] >= match_score) & F.coalesce(c["days"] <= window_days, F.lit(False)),
    )
    return rows.withColumn("candidates", candidates).withColumn(
        "match", F.get(confirmed, F.lit(0))
    ).drop("block", "key")


def candidate_list(linked: DataFrame) -> DataFrame:
    """One row per left row and candidate, rank starting at 1."""
    ranked = linked.select("id", "name", "date", F.posexplode("candidates").alias("place", "c"))
    return ranked.select(
        F.col("c.id").alias("gt_employee_id"),
        F.col("c.name").alias("gt_name"),
        F.col("id").alias("ac_employee_id"),
        F.col("name").alias("ac_name"),
        (F.col("place") + 1).alias("rank"),
        F.col("c.score").alias("name_score"),
        F.col("c.days").alias("date_diff_days"),
    )


def match_edges(linked: DataFrame) -> DataFrame:
    """Edges from the right keeper to each confirmed left row."""
    return linked.where(F.col("match").isNotNull()).select(
        F.col("match.id").alias("keeper_id"),
        F.col("match.source").alias("keeper_source"),
        F.col("id").alias("dropped_id"),
        F.col("source").alias("dropped_source"),
        F.lit(METHOD_FUZZY).alias("match_method"),
        F.col("match.score").alias("match_score"),
        F.lit(0).alias("edge_priority"),
        F.col("ord").alias("edge_order"),
    )


def review_list(linked: DataFrame) -> DataFrame:
    """Best candidate of each left row that has candidates but no match."""
    best = F.get("candidates", F.lit(0))
    return linked.where(F.col("match").isNull()).withColumn("best", best).select(
        F.col("best.id").alias("gt_employee_id"),
        F.col("best.name").alias("gt_name"),
        F.col("best.date").alias("gt_hire_date"),
        F.col("id").alias("ac_employee_id"),
        F.col("name").alias("ac_name"),
        F.col("date").alias("ac_hire_date"),
        F.col("best.score").alias("name_score"),
        F.col("best.days").alias("date_diff_days"),
    )


def recommended_action(name_score: Column, match_score: int = MATCH_SCORE) -> Column:
    return F.when(name_score >= match_score, ACTION_VERIFY).otherwise(ACTION_REVIEW)
