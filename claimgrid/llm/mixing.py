"""Mixing sources to target weights by a min-cost flow over membership patterns.

Rows count for their own source, but equal texts may lie in several: a text's membership pattern is the set of sources it
occurs in. Documents are aggregated by pattern: words of the distinct texts, and words of the rows of each source (a cell). A
flow routes the sources' quotas to the patterns. The first use of a pattern's texts is free, and each further use costs
more, whichever source makes it, so quotas go to texts that nobody else uses before any text is repeated. A cell's flow is
then made of whole passes over its rows and a part of one more, which goes to rows in the order of a seeded hash. The cut is
found by sums over hash bins, then exactly among the rows of the one bin that holds it, so no task sorts a whole source.

Only sums of patterns and cells come to the driver; more than MAX_PATTERNS of them raise an error. Texts of more than WIDE
sources are grouped by how many sources they have, so patterns stay few: with 20 sources there are at most 1,367.

Defined cases: a null text has size 0; a null source is a source of its own and the last; a source of size 0 has target
0; where all words are 0 all targets are 0; rows with equal doc_id and size have equal hashes and are ordered by text;
from LEVELS uses on a text's next use costs the same; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import packed, small_side, written

SEED, PASSES, WEIGHTS = 20, 3, (1, 2, 3)
MAX_PATTERNS = 200_000
#: Most sources of a pattern of its own, and levels of cost.
WIDE, LEVELS = 3, 8
#: Hash bins of a pattern.
BINS = 4096
ADDED = ("_size", "_source_size", "_target", "_copies")


def targets(sizes: dict, weights: dict, most: float = PASSES) -> dict:
    """Each source's share of all words by weight; above ``most`` times its size it is cut, and the excess reshared."""
    total = float(sum(sizes.values()))
    out = dict.fromkeys(sizes, 0.0)
    free, left = set(sizes), total
    while free:
        weight = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / weight > most * sizes[s]}
        if not over:
            out |= {s: left * weights[s] / weight for s in free}
            break
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        free -= over
    return out


def level_of(used: float, words: float, levels: int = LEVELS) -> int:
    """What one more word of a pattern costs: how often its texts are used already, levels - 1 at most."""
    return min(levels - 1, int(used / words + 1e-9)) if words else levels - 1


def route(words: dict[str, float], cells: dict[tuple[str, str | None], float], quotas: dict, passes: int = PASSES, levels: int = LEVELS) -> dict[tuple, float]:
    """Words to take of each cell (pattern, source): a min-cost flow from the sources' quotas to the patterns' texts.

    words: of a pattern's distinct texts. cells: of a source's rows in a pattern; each row serves ``passes`` times at most.
    A pattern's next word costs its level. Costs lie on the patterns alone, so what is routed at a cost never has to be taken
    back later: one level after another is opened, and quotas are routed to what is open (breadth-first shortest paths,
    also by moving another source's words to another pattern) until none is left.
    """
    flow, used, need = dict.fromkeys(cells, 0.0), dict.fromkeys(words, 0.0), {s: float(q) for s, q in quotas.items()}
    of_source: dict = {}
    in_pattern: dict = {}
    for p, s in cells:
        of_source.setdefault(s, []).append(p)
        in_pattern.setdefault(p, []).append(s)
    least = max(1e-6, 1e-12 * sum(cells.values()))
    for level in range(levels):
        room = {p: (math.inf if level == levels - 1 else (level + 1) * n) for p, n in words.items()}
        for s, ps in of_source.items():  # what needs no detour
            for p in ps:
                amount = min(need.get(s, 0.0), room[p] - used[p], passes * cells[p, s] - flow[p, s])
                if amount > 0:
                    flow[p, s] += amount
                    used[p] += amount
                    need[s] -= amount
        while True:
            # From all open quotas at once; a source may hand a pattern on from another source, which then looks elsewhere.
            came = {s: None for s in need if need[s] > least}
            queue, ends, seen = deque(came), [], set()
            while queue:
                s = queue.popleft()
                for p in of_source.get(s, ()):
                    if p in seen or passes * cells[p, s] - flow[p, s] <= least:
                        continue
                    seen.add(p)
                    if room[p] - used[p] > least:
                        ends.append((s, p))
                        continue
                    for t in in_pattern[p]:
                        if t not in came and flow[p, t] > least:
                            came[t] = (s, p)
                            queue.append(t)
            moved = False
            for s, p in ends:
                path, at, amount = [(s, p)], s, min(room[p] - used[p], passes * cells[p, s] - flow[p, s])
                while came[at] is not None:
                    up, q = came[at]
                    amount = min(amount, flow[q, at], passes * cells[q, up] - flow[q, up])
                    path.append((up, q, at))
                    at = up
                amount = min(amount, need[at])
                if amount <= least:
                    continue
                moved = True
                flow[p, s] += amount
                used[p] += amount
                need[at] -= amount
                for up, q, loser in path[1:]:
                    flow[q, up] += amount
                    flow[q, loser] -= amount
            if not moved:
                break
    return flow


def cost(words: dict[str, float], flow: dict[tuple, float], levels: int = LEVELS) -> float:
    """What a flow of whole words costs."""
    used: dict = {}
    for (p, _), x in flow.items():
        used[p] = used.get(p, 0.0) + x
    return sum(level_of(i, words[p], levels) for p, x in used.items() for i in range(round(x)))


def bounded(df: DataFrame, what: str) -> list:
    rows = df.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} {what}: group rare sources first")
    return rows


def mix(docs: DataFrame, size: Column, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES, seed: int = SEED, tie: Column | None = None) -> DataFrame:
    """All rows and columns of docs, with ``_size``, ``_source_size``, ``_target``, ``_copies`` (columns so named are replaced).

    size: words of a row. _source_size and _target are of its source; _copies is how often the mix takes it. tie: tells
    equal texts (default: the text's hash). docs is read several times, so a narrow table of sizes serves where texts aren't
    needed.
    """
    spark = docs.sparkSession
    tie = F.xxhash64("text") if tie is None else tie
    rows = packed(docs, _size=size.cast("long"), _source=F.col("source").cast("string"), _u=F.xxhash64(F.lit(seed), "doc_id", size.cast("long")), _tie=tie)
    rows = rows.withColumn("_bin", F.shiftrightunsigned("_u", 64 - BINS.bit_length() + 1).cast("int"))
    narrow = written(rows.drop("row"), "mix-rows")
    # Each distinct text with its pattern; copies fold before anything is shuffled.
    texts = narrow.groupBy("_tie", "_source").agg(F.max("_size").alias("_size"))
    texts = texts.groupBy("_tie").agg(F.array_sort(F.collect_set(F.struct("_source"))).alias("own"), F.max("_size").alias("_size"))
    pattern = F.when(F.size("own") <= WIDE, F.to_json("own")).otherwise(F.concat(F.lit("sources: "), F.size("own")))
    texts = written(texts.select("_tie", "_size", F.size("own").alias("_n"), pattern.alias("_p")), "mix-texts")
    words = {r["_p"]: r["words"] for r in bounded(texts.groupBy("_p").agg(F.sum("_size").alias("words")), "patterns")}
    if not words:
        return _shown(rows.withColumns({"_source_size": F.lit(0).cast("long"), "_target": F.lit(0.0), "_copies": F.lit(0)}), docs)
    shared = small_side(texts.where("_n > 1").select("_tie", F.col("_p").alias("_q")))
    known = lambda df: df.join(shared, "_tie", "left").withColumn("_p", F.coalesce("_q", F.to_json(F.array(F.struct("_source"))))).drop("_q")
    rows, narrow = known(rows), known(narrow)
    binned = written(narrow.groupBy("_p", "_source", "_bin").agg(F.sum("_size").alias("words")), "mix-bins")
    cells = {(r["_p"], r["_source"]): r["words"] for r in bounded(binned.groupBy("_p", "_source").agg(F.sum("words").alias("words")), "cells")}
    sizes: dict = {}
    for (_, s), n in cells.items():
        sizes[s] = sizes.get(s, 0) + n
    names = sorted(sizes, key=lambda s: (s is not None, s or ""))
    names = names[1:] + names[:1] if names[0] is None else names  # null is last
    goal = targets(sizes, {s: weights[i % len(weights)] for i, s in enumerate(names)}, passes)
    flow = route(words, cells, goal, passes)
    # A cell is taken in whole documents. What its rounding leaves over is made good in its source's largest cell, its last.
    last = {s: p for n, p, s in sorted(((n, p, s) for (p, s), n in cells.items()), key=lambda x: x[:2])}
    first = [c for c in cells if last[c[1]] != c[0]]
    if first:
        rounded = _placed(narrow, binned, _plan(spark, {c: flow[c] for c in first}, cells, sizes, goal, passes))
        rounded = rounded.groupBy("_p", "_source").agg(F.sum(F.col("_size") * F.col("_copies")).alias("taken"))
        took = dict.fromkeys(sizes, 0.0)
        for r in rounded.collect():  # a row for each cell
            took[r["_source"]] += r["taken"]
        flow |= {(p, s): min(max(goal[s] - took[s], 0.0), passes * cells[p, s]) for s, p in last.items()}
    return _shown(_placed(rows, binned, _plan(spark, flow, cells, sizes, goal, passes)), docs)


def _plan(spark: SparkSession, flow: dict, cells: dict, sizes: dict, goal: dict, passes: int) -> DataFrame:
    """For each cell: whole passes, and the words of the part that gets one more."""
    plan = []
    for (p, s), x in flow.items():
        n = cells[p, s]
        whole = min(passes, int(x / n + 1e-9)) if n else 0
        plan.append((p, s, whole, max(0.0, x - whole * n) if whole < passes else 0.0, sizes[s], goal[s]))
    return F.broadcast(spark.createDataFrame(plan, "_pp string, _ps string, _whole int, _part double, _source_size long, _target double"))  # MAX_PATTERNS rows at most


def _placed(rows: DataFrame, binned: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of the plan's cells with ``_copies``: the bin in which a cell's cut lies is ordered row by row."""
    same = (F.col("_p") == F.col("_pp")) & F.col("_source").eqNullSafe(F.col("_ps"))
    before = Window.partitionBy("_p", "_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    cut = binned.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cut = cut.join(plan, same).where("_part > 0 and before < _part and before + words >= _part")
    cut = cut.groupBy("_p", "_source").agg(F.min(F.struct("_bin", "before")).alias("c"))
    cut = F.broadcast(cut.select(F.col("_p").alias("_cp"), F.col("_source").alias("_cs"), F.col("c._bin").alias("_cut"), F.col("c.before").alias("_before")))  # a row for each cell
    rows = rows.join(plan, same).join(cut, (F.col("_p") == F.col("_cp")) & F.col("_source").eqNullSafe(F.col("_cs")), "left")
    within = Window.partitionBy("_p", "_source").orderBy("_u", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = rows.where("_bin = _cut")
    at_cut = at_cut.withColumn("_sum", F.col("_before") + F.coalesce(F.sum("_size").over(within), F.lit(0)))
    at_cut = at_cut.withColumn("_more", F.col("_sum") + F.col("_size") / 2 <= F.col("_part"))
    rest = rows.where("_cut is null or _bin <> _cut").withColumns({"_sum": F.lit(None).cast("long"), "_more": F.coalesce(F.col("_bin") < F.col("_cut"), F.col("_part") > 0)})
    return rest.unionByName(at_cut).withColumn("_copies", F.col("_whole") + F.col("_more").cast("int"))


def _shown(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ADDED), *ADDED)


def words_of(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0."""
    spaced = F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.split(F.trim(F.concat(spaced, F.lit(" "))), " +")) - (F.trim(spaced) == "").cast("int")


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixed.where("_copies > 0").select(*(F.col(f"`{c}`") for c in columns), F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*(F.col(f"`{c}`") for c in columns))
