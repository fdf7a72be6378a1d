"""Train, valid and test splits that never part related rows (problem 5).

Rows that share an article, author, scaffold or compound, also through other rows, form
a component.  Components are found by alternating large-star and small-star steps on
edges from each row to the least row of each of its keys; every step writes its edges
to the shared folder.  What joins the members of a key or hub with its least one is split:
keys with more than :data:`HOT` members, of which there can be few, are broadcast.

The allocation pools the profiles that can flow alike, bundles components by size and pool,
sends the rows of the pools to the splits by a min-cost flow with quotas and deviation costs,
shares each bundle out as its pool's flow goes, and rounds to whole components.  Inside a
bundle the splits alternate along its components, those of one profile side by side and in
the order of a hash, so every profile, however many there are, is shared out like its bundle.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayweave.session import discard, settle

KEYS = ("pmcid", "author_id", "scaffold", "inchikey")
#: Values that are stated but shared by unrelated rows.
NOT_SHARED = {"scaffold": ("acyclic",)}
QUOTAS = (("train", 0.8), ("valid", 0.1), ("test", 0.1))
#: Members from which a key is joined by broadcast; there are at most so many of these keys as rows over this number.
HOT = 500_000
#: Members that one salt of a ranked group stands for; ranks don't depend on it.
PER_SALT = 1_000_000


def split_name(column: Column) -> Column:
    """The split of a row: letter case and outer blanks have no meaning, 'val' is 'valid', '' is no split."""
    name = F.lower(F.trim(column))
    return F.when(name == "val", "valid").when(name != "", name)


def key_edges(rows: DataFrame, node: str = "release_id", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``u, v``: each row and the least row of each key it has, where they differ."""
    tagged = []
    for k in keys:
        value = F.col(k).cast("string")
        shared = value.isNotNull() & (value != "") & ~value.isin(*NOT_SHARED.get(k, ("",)))
        tagged.append(F.when(shared, F.concat(F.lit(f"{k}="), value)))
    spread = rows.where(F.col(node).isNotNull()).select(F.col(node).alias("u"), F.explode(F.array(*tagged)).alias("k")).where(F.col("k").isNotNull())
    # a key is worth following only if two rows have it
    least = spread.groupBy("k").agg(F.min("u").alias("v"), F.max("u").alias("w"), F.count("*").alias("n")).where(F.col("v") < F.col("w")).select("k", "v", "n")
    return _with_least(spread, least, "k", rows.count() > HOT).where(F.col("u") != F.col("v")).select("u", "v").distinct()


def _with_least(members: DataFrame, least: DataFrame, key: str, many: bool) -> DataFrame:
    """``members`` joined with the row of their ``key``, which has ``n`` of them.

    Unless there are ``many`` rows in all, no key can be hot.  Else hot ones are sent to
    all tasks, and the shuffle sees at most :data:`HOT` members of any other key.
    """
    if not many:
        return members.join(least.drop("n"), key)
    hot = members.join(F.broadcast(least.where(F.col("n") > HOT).drop("n")), key)
    return hot.unionByName(members.join(F.broadcast(least.where(F.col("n") > HOT).select(key)), key, "left_anti").join(least.where(F.col("n") <= HOT).drop("n"), key))


def _large_star(edges: DataFrame, many: bool) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    return _with_least(both.where(F.col("v") > F.col("u")), least, "u", many).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, many: bool) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _with_least(down, least, "u", many).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` of the nodes that have an edge; a component's name is its least node."""

    def mark(df: DataFrame) -> tuple[int, int]:
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], int(row["h"] or 0)

    now = settle(edges, "edges")
    before = mark(now)
    for _ in range(most_rounds):
        last, now = now, settle(_small_star(_large_star(now, before[0] > HOT // 2), before[0] > HOT // 2), "stars")
        discard(last)
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def grouped(rows: DataFrame, node: str = "release_id", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``rows`` with ``component``; a row that shares nothing is a component of its own."""
    found = components(key_edges(rows, node, keys)).withColumnRenamed("node", "__node__")
    joined = rows.join(found, F.col(node) == F.col("__node__"), "left").drop("__node__")
    return joined.withColumn("component", F.coalesce("component", node))


def parted_rows(rows: DataFrame, node: str = "release_id", split: str = "split", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Distinct ``node`` of the rows that have a split while their component's rows have more than one.

    Null ids are no rows of the result, null and blank keys are shared with nobody.
    """
    slim = rows.select(node, F.lit(None).cast("string").alias("split") if split not in rows.columns else split_name(F.col(split)).alias("split"), *keys)
    labelled = grouped(slim, node, keys).where(F.col("split").isNotNull() & F.col(node).isNotNull()).select(node, "split", "component")
    parted = labelled.groupBy("component").agg(F.min("split").alias("a"), F.max("split").alias("b")).where(F.col("a") != F.col("b")).select("component")
    return labelled.join(parted, "component", "left_semi").select(node).distinct()


class _Flow:
    """Min-cost flow by successive shortest paths over a small graph."""

    def __init__(self) -> None:
        self.out: list[list[int]] = []
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []

    def node(self) -> int:
        self.out.append([])
        return len(self.out) - 1

    def arc(self, a: int, b: int, capacity: int, cost: int) -> int:
        for x, y, room, price in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.left.append(room)
            self.cost.append(price)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        while True:
            price, via, queue, queued = {source: 0}, {}, deque([source]), {source}
            while queue:
                a = queue.popleft()
                queued.discard(a)
                for e in self.out[a]:
                    b = self.to[e]
                    if self.left[e] > 0 and price[a] + self.cost[e] < price.get(b, 1 << 60):
                        price[b], via[b] = price[a] + self.cost[e], e
                        if b not in queued:
                            queued.add(b)
                            queue.append(b)
            if sink not in price:
                return
            amount, b = 1 << 60, sink
            while b != source:
                amount = min(amount, self.left[via[b]])
                b = self.to[via[b] ^ 1]
            b = sink
            while b != source:
                self.left[via[b]] -= amount
                self.left[via[b] ^ 1] += amount
                b = self.to[via[b] ^ 1]


#: Costs of a row beyond a split's quota and beyond a label profile's share of it.
OVER_SPLIT, OVER_PROFILE = 1000, 1
#: Parts of a quota, and what a row costs more in each further one.
PARTS, FILLING = 8, 10


def _largest_small(total: int, quotas: tuple[tuple[str, float], ...]) -> int:
    """Size up to which a component fits into every split that has a quota; few components exceed it."""
    return min((q for q in (round(total * share) for _, share in quotas) if q), default=0)


def _shares(bundles: list[tuple[int, int, int]], quotas: tuple[tuple[str, float], ...]) -> tuple[dict[int, list[float]], dict[tuple[int, int], list[int]]]:
    """Share of each profile's rows that goes to each split, and the rows of each oversized bundle.

    Bundles of one profile cost the same, so the flow has one node for all of them; only
    bundles whose components exceed some split's quota, of which there are few, have nodes
    of their own, with arcs to the splits they fit into, or to the largest one.
    """
    total = sum(s * n for s, _, n in bundles)
    quota = [round(total * share) for _, share in quotas]
    flow = _Flow()
    source, sink = flow.node(), flow.node()
    splits = [flow.node() for _ in quotas]
    for k, node in enumerate(splits):
        # a quota fills in parts of rising cost, so that what is short is short in all splits alike
        for part in range(PARTS):
            flow.arc(node, sink, quota[k] * (part + 1) // PARTS - quota[k] * part // PARTS, part * FILLING)
        flow.arc(node, sink, total, OVER_SPLIT)
    rows: dict[int, int] = {}
    for s, p, n in bundles:
        rows[p] = rows.get(p, 0) + s * n
    share_of = {}
    for p, count in sorted(rows.items()):
        for k, (_, share) in enumerate(quotas):
            share_of[p, k] = flow.node()
            flow.arc(share_of[p, k], splits[k], round(count * share), 0)
            flow.arc(share_of[p, k], splits[k], count, OVER_PROFILE)
    arcs: dict[tuple, int] = {}

    def offer(name: tuple, p: int, count: int, fitting: list[int]) -> None:
        node = flow.node()
        flow.arc(source, node, count, 0)
        for k in fitting:
            arcs[(*name, k)] = flow.arc(node, share_of[p, k], count, 0)

    small, least = dict(rows), _largest_small(total, quotas)
    for s, p, n in sorted(bundles, reverse=True):
        if s <= least:
            break
        small[p] -= s * n
        offer((s, p), p, s * n, [k for k in range(len(quotas)) if s <= quota[k]] or [max(range(len(quotas)), key=quota.__getitem__)])
    for p, count in sorted(small.items()):
        if count:
            offer((p,), p, count, list(range(len(quotas))))
    flow.run(source, sink)
    sent = {name: flow.left[e ^ 1] for name, e in arcs.items()}
    every = range(len(quotas))
    profiles = {p: [sent[p, k] / count for k in every] for p, count in small.items() if count}
    return profiles, {(s, p): [sent.get((s, p, k), -1) for k in every] for s, p in {name[:2] for name in sent if len(name) == 3}}


def allocate(bundles: list[tuple[int, int, int]], quotas: tuple[tuple[str, float], ...] = QUOTAS) -> dict[tuple[int, int], list[int]]:
    """Components of each bundle ``(size, profile, count)`` per split.

    The flow says how the rows of each profile go.  Each bundle is shared out so, largest
    components first; what rounding to whole components leaves over or short is carried to
    the next bundle, so each split ends within one of the last components of its quota.
    Time grows with the number of bundles, not its square.
    """
    if not sum(s * n for s, _, n in bundles):
        return {}
    shares, own = _shares(bundles, quotas)
    out: dict[tuple[int, int], list[int]] = {}
    carry = [0.0] * len(quotas)
    for s, p, n in sorted(bundles, reverse=True):
        flows = own.get((s, p)) or [s * n * share for share in shares[p]]
        allowed = [k for k in range(len(quotas)) if flows[k] >= 0]
        wanted = [max(flows[k], 0) + carry[k] for k in range(len(quotas))]
        given = [0] * len(quotas)
        for k in sorted(allowed, key=lambda k: -wanted[k]):
            given[k] = min(n - sum(given), max(0, int(wanted[k] // s)))
        rest = n - sum(given)
        if rest > len(quotas):  # an oversized bundle without room elsewhere
            given[max(allowed, key=lambda k: quotas[k][1])] += rest
            rest = 0
        for _ in range(rest):
            given[max(allowed, key=lambda k: wanted[k] - given[k] * s)] += 1
        carry = [w - g * s for w, g in zip(wanted, given)]
        out[s, p] = given
    return out


def ranked(df: DataFrame, group: list[str], order: list[str], salts: int, runs: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``rank`` from 0 inside each group, in the order of a hash, rows of equal ``runs`` side by side.

    A group is ranked in ``salts`` parts, which are ranges of the hashes, so that ranks are the same for any number of them.
    """
    part = lambda h: F.floor((F.col(h) / 2.0**64 + 0.5) * salts)
    hashed = df.withColumns({"__g": F.xxhash64(*group, *runs), "__h": F.xxhash64(*order)}).withColumns({"__t": part("__g"), "__s": part("__h")})
    cells = hashed.groupBy(*group, *runs, "__g", "__t", "__s").agg(F.count("*").alias("__n"))
    inside = F.sum("__n").over(Window.partitionBy(*group, "__t").orderBy("__g", *runs, "__s")) - F.col("__n")
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy("__t")) - F.col("__n")
    wide = cells.groupBy(*group, "__t").agg(F.sum("__n").alias("__n")).select(*group, "__t", before.alias("__before"))
    firsts = cells.withColumn("__inside", inside).join(wide, [*group, "__t"]).select(*group, *runs, "__s", (F.col("__before") + F.col("__inside")).alias("__first"))
    inside = F.row_number().over(Window.partitionBy(*group, *runs, "__s").orderBy("__h", *order)) - 1
    return hashed.withColumn("__r", inside).join(firsts, [*group, *runs, "__s"]).withColumn("rank", F.col("__first") + F.col("__r")).drop("__g", "__h", "__t", "__s", "__first", "__r")


def alternated(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with ``split``: of each group, whose rows have ``rank`` from 0, as many rows as its ``given`` has for each of the ``names``.

    Any stretch of ranks has its share of each split but for less than as many rows as there are splits.
    """
    until = lambda rank: F.call_function("div", rank * F.col("__take") + F.call_function("div", F.col("__of"), F.lit(2)), F.nullif(F.col("__of"), F.lit(0)))
    df = df.withColumns({"__at": F.col("rank").cast("long"), "__of": F.aggregate("given", F.lit(0).cast("long"), lambda a, b: a + b), "split": F.lit(None).cast("string")})
    for k, name in enumerate(names):
        df = df.withColumn("__take", F.col("given")[k]).withColumns({"__low": until(F.col("__at")), "__high": until(F.col("__at") + 1)})
        df = df.withColumn("split", F.when(F.col("split").isNull() & (F.col("__low") < F.col("__high")), name).otherwise(F.col("split")))
        # the rows that are left close ranks; those that have a split no longer matter
        df = df.withColumns({"__at": F.col("__at") - F.col("__low"), "__of": F.col("__of") - F.col("__take")})
    return df.drop("__at", "__of", "__take", "__low", "__high")


#: Former limits of the profiles and bundles; nothing reads them but a test that sets them and expects no change.
MOST_PROFILES, MOST_BUNDLES = 256, 200_000


def assign_splits(
    rows: DataFrame, node: str = "release_id", label: str = "endpoint", keys: tuple[str, ...] = KEYS, quotas: tuple[tuple[str, float], ...] = QUOTAS
) -> DataFrame:
    """``node, component, split``: an assignment of all rows that parts no component.

    A component's profile is the set of its ``label`` values, null and no labels being one
    of their own.  Profiles whose components all fit into every split cost the same and can
    go the same way, so they are one pool of the flow; its cost is, but for rounding, that of
    one node for each profile if all are shared out like the pool, as :func:`alternated` does.
    Only a profile with a component beyond some quota is a pool of its own.  By their
    definition there are at most as many such components as the least quota goes into all
    rows, and of each pool at most as many sizes as the root of twice its rows: that bounds
    what the driver holds at any size of the input, without a limit.
    """
    slim = rows.select(node, label, *keys)
    members = settle(grouped(slim, node, keys).select(node, label, "component").distinct(), "members")
    sized = members.groupBy("component").agg(F.countDistinct(node).alias("size"), F.xxhash64(F.array_sort(F.collect_set(label))).alias("profile"))
    sized = settle(sized.withColumn("size", F.greatest("size", F.lit(1))), "sized")
    total = sized.agg(F.sum("size").alias("n")).first()["n"] or 0
    own = sorted(r["profile"] for r in sized.where(F.col("size") > _largest_small(total, quotas)).select("profile").distinct().collect())
    pooled = sized.withColumn("pool", F.array_position(F.array(*map(F.lit, own)), F.col("profile")) if own else F.lit(0).cast("long"))
    counted = pooled.groupBy("size", "pool").count().collect()
    plan = allocate([(r["size"], r["pool"], r["count"]) for r in counted], quotas)
    table = rows.sparkSession.createDataFrame([(*bundle, given) for bundle, given in sorted(plan.items())], "size long, pool long, given array<long>")
    salts = 1 + sum(r["count"] for r in counted) // PER_SALT
    # the bundles are as few as the driver holds, and one of them can have most components
    placed = ranked(pooled, ["size", "pool"], ["component"], salts, ("profile",)).join(F.broadcast(table), ["size", "pool"])
    placed = alternated(placed, [name for name, _ in quotas]).select("component", "split")
    both = members.select(node, "component").distinct().alias("m")
    same = F.col("m.component").eqNullSafe(F.col("p.component"))
    return both.join(placed.alias("p"), same).select(f"m.{node}", "m.component", "p.split")
