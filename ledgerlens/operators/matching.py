"""Maximum one-to-one matching of two sides' rows inside groups.

A pool holds the distinct rows of both sides that still want a partner: ``_id``
(unique), ``side`` ('L' or 'R'), ``n`` (copies) and the row's columns. A matching
is a table of flows (l_id, r_id, n): n copies of the one go with n of the other.

* ``interval_flows``: a left row accepts the right rows whose value lies in its
  interval. A sweep over the values in order gives each right row the open
  left row that closes first, which makes the matching a maximum one (intervals
  over sorted points: the partner that can wait least goes first).
* ``text_flows``: rows accept texts within an edit distance. Candidates come from
  an index of deletion neighbourhoods (two texts within k edits have a common text
  after at most k deletions each), never from all pairs of a group; inside each
  connected set of texts augmenting paths raise the matching to a maximum.

Both spread by group. A group of more than ``GROUP_ROWS`` rows is cut into stretches
that are swept side by side. A stretch hands the rows still open at its border
to the next one, which is swept again if they are not those it started with,
until nothing changes: then every stretch has what a sweep of the whole group would
have had. Where intervals have no upper end, open rows are all alike, and running
sums over the stretches take the place of the sweep.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stored

# Distinct rows (or links of texts) of a group that one task sweeps; no result depends on it.
GROUP_ROWS = 250_000
# Numbers that a task writes out for the copies of one row at a time; likewise.
COPIES_PER_CHUNK = 100_000

FLOWS = "l_id long, r_id long, n long"


def as_group(exprs: Sequence[str]) -> str:
    """SQL: values as one struct: never NULL, and NULL fields compare as values."""
    return "named_struct(" + ", ".join(f"'c{k}', {e}" for k, e in enumerate(exprs)) + ")"


def grouped_hash(exprs: Sequence[str]) -> str:
    """SQL: a hash of the values, by which rows of a group find each other; groups
    that share one are told apart by their values."""
    return f"xxhash64({', '.join(exprs)})"


def shuffled(df: DataFrame) -> DataFrame:
    """A join side that is dealt out like the other one, never sent whole to each
    task through the driver: its rows grow with the input, and a stored table may be
    compressed to a small part of what its rows take."""
    return df.hint("merge")


def expand(df: DataFrame, count: str, number: str | None = None, most: int | None = None) -> DataFrame:
    """Each row ``count`` times, numbered from 0 as ``number``; many copies of one
    row spread over tasks. ``most``: a bound of the counts, if known; where it shows
    that none are that many, ``df`` is computed once, not twice."""
    if most is not None and most <= COPIES_PER_CHUNK:
        copies = df.filter(f"{count} > 0").selectExpr("*", f"explode(sequence(0L, {count} - 1)) AS _copy")
        return copies.selectExpr(*df.columns, *([f"_copy AS {number}"] if number else []))
    cut = df.filter(f"{count} > 0").selectExpr("*", f"explode(sequence(0L, ({count} - 1) DIV {COPIES_PER_CHUNK})) AS _chunk")
    spread = cut.filter("_chunk = 0").unionByName(cut.filter("_chunk > 0").repartition(*df.columns, "_chunk"))
    start = f"_chunk * {COPIES_PER_CHUNK}L"
    copies = spread.selectExpr("*", f"explode(sequence({start}, least({count}, {start} + {COPIES_PER_CHUNK}L) - 1)) AS _copy")
    return copies.selectExpr(*df.columns, *([f"_copy AS {number}"] if number else []))


def _flows_by_number(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Flows of ranges: the copies of a left row (group, id, n, start: the number of
    its first copy) go with the right copies that have the same numbers."""
    sides = [
        expand(df.select(*group, "id", "n", "start"), "n", "k").selectExpr(*(f"{g} AS {s}_{g}" for g in group), f"id AS {s}_id", f"start + k AS {s}_k")
        for df, s in ((left, "l"), (right, "r"))
    ]
    on = " AND ".join([*(f"l_{g} = r_{g}" for g in group), "l_k = r_k"])
    return sides[0].join(shuffled(sides[1]), F.expr(on)).groupBy("l_id", "r_id").agg(F.expr("count(1) AS n"))


# --- values in intervals ----------------------------------------------------------


def _sweeper(keep_open: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sweep units (rows after ``first``) in order of ``p``, lefts before rights.

    A unit's open rows wait in a heap by the end of their interval, of which
    expired ones are dropped; memory holds those alone, not the unit. With
    ``keep_open`` rows still open at the end of a unit are written too (r_id null)."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from heapq import heappop, heappush

        waiting: list = []  # (no end, end, order, own value, id, copies left)
        unit = (0, 0)
        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * 5
            out.clear()
            names = ("gid", "s", "l_id", "r_id", "n")
            return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(names, cols, strict=True)})

        def close() -> None:
            if keep_open:
                out.extend((*unit, w[4], None, w[5]) for w in waiting)
            waiting.clear()

        order = 0
        for batch in batches:
            for first, left, i, n, p, hi, own, strict, gid, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first:
                    close()
                    unit = (gid, s)
                if left:
                    order += 1
                    heappush(waiting, (hi is None, 0 if hi is None else hi, order, own, i, n))
                    continue
                barred = []
                while n and waiting:
                    w = heappop(waiting)
                    if not w[0] and w[1] < p:
                        continue
                    if strict and w[3] == own:
                        barred.append(w)
                        continue
                    take = min(n, w[5])
                    out.append((*unit, w[4], i, take))
                    n -= take
                    if w[5] > take:
                        heappush(waiting, (*w[:5], w[5] - take))
                for w in barred:
                    heappush(waiting, w)
            yield table()
        close()
        yield table()

    return sweep


SWEPT = "gid long, s long, l_id long, r_id long, n long"
_EVENT = ["first", "is_left", "_id", "n", "p", "hi", "own", "strict", "gid", "s"]


def _swept(events: DataFrame, keep_open: bool) -> DataFrame:
    """Events (unit: (_h, _g), dealt by _h, or (gid, s); early, p, is_left, _row, ...)
    swept by unit."""
    unit = ["gid", "s"] if keep_open else ["_h", "_g"]
    order = ["early", "p", "side", "_row"]
    run = f"PARTITION BY {', '.join(unit)}"
    first = f"row_number() OVER ({run} ORDER BY {', '.join(order)}) = 1 AS first"
    flagged = (events.repartition(*unit) if keep_open else events).selectExpr("*", first)
    return flagged.sortWithinPartitions(*unit, *order).select(*_EVENT).mapInArrow(_sweeper(keep_open), SWEPT)


def interval_flows(
    pool: DataFrame, groups: Sequence[str], value: str, low: str, high: str | None, row: Sequence[str],
    strict: str = "false", usable: str = "true", name: str = "interval",
) -> DataFrame:
    """A maximum matching inside the groups, each left row with right rows whose
    ``value`` is from ``low`` to ``high`` (SQL over a left row, both included;
    ``high`` None: no end).

    Rows with a NULL among ``groups`` or in their value match nothing, nor do left
    rows that are not ``usable``. Equal values are taken in the order of the columns
    ``row``. Where ``strict`` holds (it must be the same for a group) equal values do
    not go together; if both sides have such rows, the matching is one that no single
    pair can be added to, not always a maximum."""
    there = " AND ".join(f"({g}) IS NOT NULL" for g in [*groups, value])
    events = pool.filter(f"{there} AND (side = 'R' OR ({usable}))").selectExpr(
        f"{grouped_hash(groups)} AS _h", f"{as_group(groups)} AS _g", "side", "side = 'L' AS is_left", "_id", "n",
        f"CASE WHEN side = 'L' THEN {low} ELSE {value} END AS p",
        f"CASE WHEN side = 'L' THEN {high or 'NULL'} END AS hi" if high else f"CASE WHEN false THEN {value} END AS hi",
        f"{value} AS own", f"coalesce({strict}, true) AS strict", f"{as_group(row)} AS _row", "1 AS early",
    )
    # Groups with one side match nothing. They are found by hashes alone, so most
    # rows that have no partner are not sorted.
    met = stored(_two_sided(events, "_h"), f"{name}-met")
    widest = met.agg(F.expr("max(size)")).first()[0]
    if widest is None:
        return pool.limit(0).selectExpr("_id AS l_id", "_id AS r_id", "n")
    both, most = events.join(shuffled(met.select("_h")), "_h", "left_semi"), None
    if widest > GROUP_ROWS:
        wide = events.join(shuffled(met.filter(f"size > {GROUP_ROWS}").select("_h")), "_h", "left_semi")
        sized = stored(_two_sided(wide, "_g").filter(f"size > {GROUP_ROWS}").selectExpr("_g AS _large", "size", "monotonically_increasing_id() AS gid"), f"{name}-large")
        most, large = sized.agg(F.expr("max(size)")).first()[0], sized.drop("size")
        # Repeated, as the join deals rows by their whole group.
        both = both.join(shuffled(large), F.expr("_g = _large"), "left_anti").repartition("_h")
    flows = _swept(both.selectExpr("*", "0L AS gid", "0L AS s"), False).select("l_id", "r_id", "n")
    if most is None:
        return stored(flows, name)
    events = stored(_stretches(events, large, -(-most // GROUP_ROWS)), f"{name}-stretches")
    ended = events if high is not None else events.filter("strict")
    flows = flows.unionByName(_side_by_side(ended, name))
    if high is None:
        flows = flows.unionByName(_endless(events.filter("NOT strict")))
    return stored(flows, name)


def _two_sided(events: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that both sides have, and the number of their rows."""
    sized = events.groupBy(key).agg(F.expr("count(1) AS size"), F.expr("count_if(side = 'L') AS lefts"))
    return sized.filter("lefts > 0 AND lefts < size").select(key, "size")


def _stretches(events: DataFrame, large: DataFrame, count: int) -> DataFrame:
    """Events of large groups with gid and the number s of their stretch: values
    between bounds from a quantile sketch of the group."""
    keyed = events.join(shuffled(large), F.expr("_g = _large")).drop("_large", "_g", "_h")
    if count < 2:
        return keyed.selectExpr("*", "0L AS s")
    shares = ", ".join(f"{k / count!r}D" for k in range(1, count))
    bounds = keyed.groupBy("gid").agg(F.expr(f"percentile_approx(p, array({shares}), {10 * count}) AS bounds")).withColumnRenamed("gid", "_b")
    return keyed.join(bounds, F.expr("gid = _b")).selectExpr("*", "CAST(size(filter(bounds, b -> b < p)) AS BIGINT) AS s").drop("_b", "bounds")


def _side_by_side(events: DataFrame, name: str) -> DataFrame:
    """Flows of stretches, swept again while what the stretch before leaves open
    is not what they started with. The first stretch is right at once, so each
    round makes at least one more right; mostly two or three rounds do."""
    units = stored(
        events.select("gid", "s").distinct().selectExpr("gid", "s", "lead(s) OVER (PARTITION BY gid ORDER BY s) AS next"), f"{name}-units"
    )
    done = stored(_swept(events, True), f"{name}-swept")
    # What a stretch started with, as a sum of hashes; a stretch not named started with nothing.
    used = None
    waiting = events.filter("is_left").drop("gid", "s", "n", "early").withColumnRenamed("_id", "_open")
    while True:
        left_open = done.filter("r_id IS NULL").join(units.filter("next IS NOT NULL"), ["gid", "s"]).selectExpr("gid", "next AS s", "l_id", "n")
        sent = left_open.groupBy("gid", "s").agg(F.expr("sum(CAST(xxhash64(l_id, n) AS DECIMAL(20,0))) AS sum"), F.expr("count(1) AS rows"))
        sent = stored(sent, f"{name}-sent")
        if used is None:
            changed = sent.select("gid", "s")
        else:
            changed = sent.exceptAll(used).select("gid", "s").union(used.exceptAll(sent).select("gid", "s")).distinct()
        changed = stored(changed, f"{name}-changed")
        if changed.isEmpty():
            return done.filter("r_id IS NOT NULL").select("l_id", "r_id", "n")
        again = left_open.join(changed, ["gid", "s"], "left_semi").join(shuffled(waiting), F.expr("l_id = _open")).selectExpr("*", "l_id AS _id", "0 AS early").drop("l_id", "_open")
        rows = events.join(changed, ["gid", "s"], "left_semi").unionByName(again)
        done = stored(done.join(changed, ["gid", "s"], "left_anti").unionByName(_swept(rows, True)), f"{name}-swept")
        used = sent


def _endless(events: DataFrame) -> DataFrame:
    """Flows of stretches whose intervals have no end. Among the rows up to a
    value, as many rights stay alone as they ever were ahead of the lefts; the
    j-th right that has a partner goes with the j-th left. Sums and peaks of
    stretches add up, so stretches are summed apart."""
    run = "OVER (PARTITION BY gid, s ORDER BY p, side, _row ROWS UNBOUNDED PRECEDING)"
    summed = events.selectExpr("gid", "s", "p", "side", "_row", "_id", "n", f"sum(CASE WHEN is_left THEN n ELSE 0L END) {run} AS a", f"sum(CASE WHEN is_left THEN 0L ELSE n END) {run} AS b")
    peaked = summed.selectExpr("*", f"max(b - a) {run} AS peak")
    totals = peaked.groupBy("gid", "s").agg(F.expr("max(a) AS a"), F.expr("max(b) AS b"), F.expr("max(peak) AS peak"))
    before = "OVER (PARTITION BY gid ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offset = totals.selectExpr("gid", "s", "peak", f"coalesce(sum(a) {before}, 0L) AS a0", f"coalesce(sum(b) {before}, 0L) AS b0")
    offset = offset.selectExpr("gid AS g0", "s AS s0", "a0", "b0", f"greatest(0L, coalesce(max(b0 - a0 + peak) {before}, 0L)) AS peak0")
    placed = peaked.join(offset, F.expr("gid = g0 AND s = s0")).selectExpr(
        "gid", "side", "_id AS id", "n", "a0 + a AS a", "b0 + b AS b", "greatest(peak0, b0 - a0 + peak) AS alone",
        "greatest(peak0, coalesce(b0 - a0 + lag(peak) OVER (PARTITION BY gid, s ORDER BY p, side, _row), 0L)) AS alone_before",
    )
    left = placed.filter("side = 'L'").selectExpr("gid", "id", "n", "a - n AS start")
    right = placed.filter("side = 'R'").selectExpr("gid", "id", "n - (alone - alone_before) AS paired", "b - n - alone_before AS start")
    right = right.filter("paired > 0").withColumnRenamed("paired", "n")
    return _flows_by_number(left, right, ["gid"])


# --- texts within an edit distance -------------------------------------------------


def _deletions(text: str, most: int) -> str:
    """SQL: the text and all texts after at most ``most`` deletions of a character."""
    out = f"array({text})"
    for _ in range(most):
        shorter = "flatten(transform(v, t -> transform(sequence(1, greatest(length(t), 1)), i -> concat(substr(t, 1, i - 1), substr(t, i + 1)))))"
        out = f"transform(array({out}), v -> array_distinct(concat(v, {shorter})))[0]"
    return out


def _augmenter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Units of links (first, l, r, ln, rn, distance) to flows (l, r, n): texts that
    are equal first, then along augmenting paths."""

    def solve(links: list[tuple]) -> Iterator[tuple[int, int, int]]:
        supply, demand, flow, near = {}, {}, {}, {}
        back: dict[int, set] = {}
        for r_distance, l, r, ln, rn in sorted((d, l, r, ln, rn) for l, r, ln, rn, d in links):
            supply.setdefault(l, ln)
            demand.setdefault(r, rn)
            near.setdefault(l, []).append(r)
            take = min(supply[l], demand[r])
            if take and not r_distance:
                flow[l, r] = take
                back.setdefault(r, set()).add(l)
                supply[l] -= take
                demand[r] -= take
        seen: set = set()  # rights that no path leads on from, until a path is found
        for start in sorted(near):
            while supply[start]:
                came, queue, found = {}, [start], None
                reached = {start}
                for l in queue:
                    for r in near[l]:
                        if r in came or r in seen:
                            continue
                        came[r] = l
                        if demand[r]:
                            found = r
                            break
                        for other in back.get(r, ()):
                            if other not in reached:
                                reached.add(other)
                                came[-1 - other] = r
                                queue.append(other)
                    if found is not None:
                        break
                if found is None:
                    seen.update(r for r in came if r >= 0)
                    break
                path, r = [], found
                while True:
                    l = came[r]
                    path.append((l, r))
                    if l == start:
                        break
                    r = came[-1 - l]
                # From the second step on, a left gives up the right that leads to it.
                take = min(supply[start], demand[found], *(flow[l, path[k + 1][1]] for k, (l, _) in enumerate(path[:-1])), 1 << 62)
                for k, (l, r) in enumerate(path):
                    flow[l, r] = flow.get((l, r), 0) + take
                    back.setdefault(r, set()).add(l)
                    if k + 1 < len(path):
                        held = path[k + 1][1]
                        flow[l, held] -= take
                        if not flow[l, held]:
                            del flow[l, held]
                            back[held].discard(l)
                supply[start] -= take
                demand[found] -= take
        yield from ((l, r, n) for (l, r), n in sorted(flow.items()))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(("l_id", "r_id", "n"), cols, strict=True)})

        links: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for first, *link in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first and links:
                    out.extend(solve(links))
                    links = []
                links.append(tuple(link))
            yield table(out)
        yield table(list(solve(links)) if links else [])

    return units


def connected(links: DataFrame, name: str) -> DataFrame:
    """v, root for the ends a, b of links: the least vertex of its connected set,
    by labels that fall to the least of the neighbours' and then to their own label's."""
    edges = stored(links.union(links.selectExpr("b", "a")).distinct(), f"{name}-edges")
    labels = stored(edges.groupBy(F.col("a").alias("v")).agg(F.expr("least(min(b), max(a)) AS root")), f"{name}-labels")
    while True:
        least = edges.join(shuffled(labels), F.expr("b = v")).groupBy("a").agg(F.expr("min(root) AS near"))
        lower = labels.join(shuffled(least), F.expr("v = a"), "left").selectExpr("v", "root AS old", "least(root, coalesce(near, root)) AS root")
        jump = labels.selectExpr("v AS _v", "root AS _far")
        lower = stored(lower.join(shuffled(jump), F.expr("root = _v"), "left").selectExpr("v", "old", "least(root, coalesce(_far, root)) AS root"), f"{name}-labels")
        if lower.filter("old <> root").isEmpty():
            return lower.select("v", "root")
        labels = lower.select("v", "root")


def text_flows(pool: DataFrame, groups: Sequence[str], text: str, most: int, row: Sequence[str], usable: str = "true", name: str = "text") -> DataFrame:
    """A maximum matching inside the groups, rows with rows whose ``text`` is
    within ``most`` edits. It starts from texts that are equal, which stay matched
    (with another text, if that lets one more pair be made).

    Rows with a NULL among ``groups`` or in their text match nothing, nor do rows
    that are not ``usable``. Rows with the same text are taken in the order of
    the columns ``row``. The index holds every text about length^most / most! times,
    so it is meant for small distances."""
    there = " AND ".join(f"({g}) IS NOT NULL" for g in [*groups, text])
    rows = pool.filter(f"{there} AND ({usable})").selectExpr(
        f"{grouped_hash(groups)} AS _h", f"{as_group(groups)} AS _g", f"{text} AS t", "side", "_id", "n", f"{as_group(row)} AS _row"
    )
    both = rows.join(shuffled(_two_sided(rows, "_h").select("_h")), "_h", "left_semi")
    # A text is named by the least id of its rows, times 2, plus 1 if it has several.
    run = "PARTITION BY _h, _g, side, t"
    numbered = both.selectExpr(
        "_h", "_g", "t", "side", "_id AS id", "n", f"2 * min(_id) OVER ({run}) + CAST(count(1) OVER ({run}) > 1 AS BIGINT) AS tid",
        f"sum(n) OVER ({run}) AS total", f"sum(n) OVER ({run} ORDER BY _row ROWS UNBOUNDED PRECEDING) - n AS start",
        f"_id = min(_id) OVER ({run}) AS names",
    )
    numbered = stored(numbered, f"{name}-rows")
    copies = numbered.agg(F.expr("max(total)")).first()[0]
    if copies is None:
        return pool.limit(0).selectExpr("_id AS l_id", "_id AS r_id", "n")
    texts = numbered.filter("names")
    if most > 0:
        # The hashes hold the group's, so the index need not.
        index = texts.selectExpr("side", "tid", f"explode(array_distinct(transform({_deletions('t', most)}, v -> xxhash64(_h, v)))) AS v")
        left, right = (index.filter(f"side = '{s}'").selectExpr(f"v AS {s}_v", f"tid AS {s}") for s in "LR")
        met = left.join(shuffled(right), F.expr("L_v = R_v")).select("L", "R").distinct()
        ends = [texts.filter(f"side = '{s}'").selectExpr(f"tid AS {s}_tid", f"_g AS {s}_g", f"t AS {s}_t", f"total AS {s}_n", *(["_h"] if s == "L" else [])) for s in "LR"]
        near = met.join(shuffled(ends[0]), F.expr("L = L_tid")).join(shuffled(ends[1]), F.expr("R = R_tid AND L_g = R_g"))
        near = near.selectExpr("_h", "L", "R", "L_n", "R_n", f"levenshtein(L_t, R_t, {most}) AS d").filter("d >= 0")
    else:
        left, right = (texts.filter(f"side = '{s}'").selectExpr(f"_h AS {s}_h", f"_g AS {s}_g", f"t AS {s}_t", f"tid AS {s}", f"total AS {s}_n") for s in "LR")
        near = left.join(shuffled(right), F.expr("L_h = R_h AND L_g = R_g AND L_t = R_t")).selectExpr("L_h AS _h", "L", "R", "L_n", "R_n", "0 AS d")
    links = stored(near, f"{name}-links")
    large = links.groupBy("_h").agg(F.expr("count(1) AS size")).filter(f"size > {GROUP_ROWS}")
    unit = "_h"
    if not large.isEmpty():
        roots = connected(links.selectExpr("2 * L AS a", "2 * R + 1 AS b"), name)
        links, unit = links.join(shuffled(roots), F.expr("2 * L = v")).drop("v"), "root"
    keyed = links.repartition(unit).selectExpr("*", f"row_number() OVER (PARTITION BY {unit} ORDER BY L, R) = 1 AS first")
    flows = keyed.sortWithinPartitions(unit, "L", "R").select("first", "L", "R", "L_n", "R_n", "d").mapInArrow(_augmenter(), FLOWS)
    flows = stored(flows, f"{name}-flows")
    return stored(_of_rows(numbered, flows, copies), name)


def _of_rows(numbered: DataFrame, flows: DataFrame, most: int) -> DataFrame:
    """Flows between texts as flows between their rows. The row of a text that has
    one is known; else copies are numbered within a text, on both sides and in the flows."""
    plain = flows.filter("l_id % 2 = 0 AND r_id % 2 = 0").selectExpr("l_id DIV 2 AS l_id", "r_id DIV 2 AS r_id", "n")
    starts = flows.filter("l_id % 2 <> 0 OR r_id % 2 <> 0").selectExpr(
        "l_id", "r_id", "n",
        "sum(n) OVER (PARTITION BY l_id ORDER BY r_id ROWS UNBOUNDED PRECEDING) - n AS ls",
        "sum(n) OVER (PARTITION BY r_id ORDER BY l_id ROWS UNBOUNDED PRECEDING) - n AS rs",
    )
    met = expand(starts, "n", "k", most).selectExpr("l_id AS l_tid", "r_id AS r_tid", "ls + k AS lk", "rs + k AS rk")
    for s in "lr":
        own = expand(numbered.filter(f"side = '{s.upper()}' AND tid % 2 <> 0").select("tid", "id", "n", "start"), "n", "k", most)
        own = own.selectExpr(f"tid AS _{s}t", f"id AS _{s}", f"start + k AS _{s}k")
        met = met.join(shuffled(own), F.expr(f"{s}_tid = _{s}t AND {s}k = _{s}k"), "left")
    met = met.selectExpr("coalesce(_l, l_tid DIV 2) AS l_id", "coalesce(_r, r_tid DIV 2) AS r_id")
    return plain.unionByName(met.groupBy("l_id", "r_id").agg(F.expr("count(1) AS n")))
