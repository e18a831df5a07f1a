"""Near-duplicate vectors by sorted projection passes.

Each pass gives a vector the signs of 60 random projections as one number, so that sorting by
it orders vectors lexicographically by concatenated random hashes; like vectors come to stand
near each other. Sorted rows are cut into blocks, each with the first rows of the next one, and
all pairs of a block are compared. Rows of a pass carry a sketch of 256 signs in place of the
vector; pairs whose sketches differ too much for their angle are out, with a chance of error
below 10**-9, the others of all passes are united and verified on the vectors.

Large groups of near copies would make pairs by the square of their size. They are contracted
first, with the same sorted passes: a vector joins a centre within half the linking angle, so
that all members of a class link by the triangle inequality and need only be counted. Passes
run over centres; two classes so near, or so far, that their radii decide are counted as a
whole, and members are compared one by one only in between.

Windows bound the partners that a pass can meet. Passes grow with the number of centres, so that
scattered pairs are met however many there are. Where a quarter of a block links to a centre, more
partners may lie beyond the block: such crowded centres are joined to regions, and a region is compared
whole, stripe against stripe, by tasks that return counts and a spanning forest instead of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import per_group, typed
from tripkit.llm.components import connected_components
from tripkit.operators.ordering import numbered
from tripkit.session import materialize

#: Least sorted passes over the centres, share of pairs at the threshold that they meet; passes that contract near copies before.
PASSES, MET, CONTRACTIONS = 16, 0.97, 3
#: Rows of a block that are compared in full, and rows of the next block that it takes in.
BLOCK, OVERLAP = 1024, 128
#: Links within a block that make a centre crowded; centres of a region in one stripe, and of those compared at a time.
CROWDED, STRIPE, STEP = BLOCK // 4, 8192, 1024
#: Random signs of a pass, and of a sketch; standard deviations that a sketch may be off.
SIGNS, SKETCH, DEVIATIONS = 60, 256, 6.0


def unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors scaled to length 1 as doubles; null where a vector has no direction."""
    for batch in batches:
        units = []
        for value in batch.column(1):
            unit = None
            if value.is_valid and len(value.values) and not value.values.null_count:
                x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                    x = x / top  # neither overflow nor underflow in the length
                    unit = (x / np.sqrt(x @ x)).tobytes()
            units.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], names=["_id", "unit"])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in column])


def signs(x: np.ndarray, turn: int) -> np.ndarray:
    planes = np.random.default_rng(turn).standard_normal((x.shape[1], SIGNS))
    return (x @ planes > 0).astype(np.int64) @ (np.int64(1) << np.arange(SIGNS, dtype=np.int64)[::-1])


def sort_keys(batches: Iterator[pa.RecordBatch], turns: range) -> Iterator[pa.RecordBatch]:
    """Every row once per turn, with its sort key."""
    for batch in batches:
        raw = batch.column(batch.schema.get_field_index("unit"))
        sizes = np.array([len(x.as_buffer()) // 8 for x in raw], np.int32)
        for size in np.unique(sizes):
            part = batch.take(pa.array(np.flatnonzero(sizes == size)))
            x = matrix(part.column(batch.schema.get_field_index("unit")))
            for turn in turns:
                extra = [pa.array(np.full(len(x), v, np.int32)) for v in (turn, size)]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra, pa.array(signs(x, turn))],
                                                 names=[*part.schema.names, "turn", "dim", "key"])


def sketched(batches: Iterator[pa.RecordBatch], turns: range) -> Iterator[pa.RecordBatch]:
    """A sketch and a sort key of every row, once per turn, in place of its vector."""
    for batch in sort_keys(batches, turns):
        x = matrix(batch.column("unit"))
        planes = np.random.default_rng(1 << 21).standard_normal((x.shape[1], SKETCH))
        bits = np.packbits(x @ planes > 0, axis=1)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cid", "radius", "turn", "dim", "key")), pa.array(list(map(bytes, bits)), pa.binary())],
                                         names=["cid", "radius", "turn", "dim", "key", "sketch"])


def keyed(centres: DataFrame, turn: int) -> DataFrame:
    """``centres`` with their sort key of one turn."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in centres.schema)
    return centres.mapInArrow(partial(sort_keys, turns=range(turn, turn + 1)), f"{fields}, turn int, dim int, key bigint")


def blocked(rows: DataFrame, name: str, overlap: int) -> DataFrame:
    """Rows in sorted order per turn, dealt to blocks; ``lead`` marks a row of the next block."""
    placed = numbered(rows, "turn", "dim", "key", name).withColumn("block", F.expr(f"_pos div {BLOCK}"))
    own = placed.withColumn("lead", F.lit(False))
    if not overlap:
        return own
    return own.unionByName(placed.where(f"_pos % {BLOCK} < {overlap}").withColumn("block", F.col("block") - 1)
                           .withColumn("lead", F.lit(True)))


def slots(group: pa.Table) -> Iterator[np.ndarray]:
    """Rows of a block that may be compared: same pass and same number of components."""
    kind = group.column("turn").to_numpy().astype(np.int64) << 32 | group.column("dim").to_numpy()
    for k in np.unique(kind):
        yield np.flatnonzero(kind == k)


def attached(group: pa.Table, near: float) -> pa.Table:
    """Each centre of a block and the centre that takes it in: heavier ones first, then by name."""
    out_from, out_to = [], []
    names, weights = np.array(group.column("node").to_pylist(), object), group.column("n").to_numpy()
    for rows in slots(group):
        rows = rows[np.lexsort((names[rows], -weights[rows]))]
        x = matrix(group.column("unit").take(pa.array(rows)))
        free = np.ones(len(rows), bool)
        for k in range(len(rows)):
            if free[k]:
                taken = np.flatnonzero(free & (x @ x[k] >= near))
                free[taken] = False
                free[k] = False
                others = taken[taken != k]
                out_from.extend(names[rows[others]])
                out_to.extend([names[rows[k]]] * len(others))
    return pa.table({"leader": pa.array(out_from, pa.string()), "to": pa.array(out_to, pa.string())})


def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Angle and cosine between the vectors x and y; every other column stays."""
    for batch in batches:
        cut = [batch.schema.get_field_index(c) for c in ("x", "y")]
        cosine = np.array([np.frombuffer(a.as_buffer(), np.float64) @ np.frombuffer(b.as_buffer(), np.float64)
                           for a, b in zip(*(batch.column(i) for i in cut), strict=True)], np.float64)
        keep = [i for i in range(batch.num_columns) if i not in cut]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), pa.array(cosine), pa.array(np.arccos(np.clip(cosine, -1, 1)))],
            names=[*(batch.schema.names[i] for i in keep), "cosine", "angle"])


def with_angles(df: DataFrame) -> DataFrame:
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name not in ("x", "y"))
    return df.mapInArrow(angles, f"{kept}, cosine double, angle double")


def contract(points: DataFrame, cosine: float) -> DataFrame:
    """(node, n, least, leader, angle): each point's class, named by its centre, and its angle to it."""
    near = float(np.cos(np.arccos(cosine) / 2)) + 1e-9
    members = points.select("node", "n", "least", F.col("node").alias("leader"), F.lit(0.0).alias("angle"))
    for turn in range(CONTRACTIONS):
        weights = members.groupBy("leader").agg(F.sum("n").alias("n")).withColumnRenamed("leader", "node")
        centres = points.select("node", "unit").join(weights, "node")
        placed = blocked(keyed(centres, (1 << 20) + turn), "node", 0)  # projections that no later pass uses
        moves = materialize(per_group(placed, "block", attached, "leader string, to string", near=near))
        moving = members.join(moves, "leader")
        tried = with_angles(moving.join(points.select("node", F.col("unit").alias("x")), "node")
                            .join(points.select(F.col("node").alias("to"), F.col("unit").alias("y")), "to")
                            .drop("angle"))
        accepted = tried.where(F.col("cosine") >= near).select("node", F.col("to").alias("new"), F.col("angle").alias("new_angle"))
        members = materialize(members.join(accepted, "node", "left").select(
            "node", "n", "least", F.coalesce("new", "leader").alias("leader"), F.coalesce("new_angle", "angle").alias("angle")))
    return members


def passes_for(centres: int, limit: float) -> int:
    """Passes after which a pair at the angle ``limit`` has shared a block with chance ``MET``.

    A block holds the centres whose first log2(centres / BLOCK) signs agree, as a pair's do with
    (1 - limit / pi) to that power; its chance of meeting is that, once per pass.
    """
    meets = (1 - limit / math.pi) ** max(0.0, math.log2(max(1, centres) / BLOCK))
    return PASSES if meets >= 1 else max(PASSES, math.ceil(math.log(1 - MET) / math.log1p(-meets)))


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Unite the labels of rows ``a`` and ``b`` where ``linked`` says so; the links that united two parts."""
    used = []
    while True:
        apart = linked & (labels[a][:, None] != labels[b][None, :])
        rows = np.flatnonzero(apart.any(axis=1))
        if not len(rows):
            return used
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while x in root:
                x = root[x]
            return x

        for i, j in zip(a[rows].tolist(), b[apart[rows].argmax(axis=1)].tolist(), strict=True):
            x, y = top(int(labels[i])), top(int(labels[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                used.append((i, j))
        old = np.unique(labels)
        labels[:] = np.array([top(int(x)) for x in old])[np.searchsorted(old, labels)]


def compared(group: pa.Table, limit: float) -> pa.Table:
    """Pairs of centres of a block whose classes may hold a link, by their sketches; forests of crowded centres."""
    names, radius = group.column("cid").to_numpy(), group.column("radius").to_numpy()
    lead = np.asarray(group.column("lead"))
    out = []
    for rows in slots(group):
        bits = np.frombuffer(b"".join(x.as_py() for x in group.column("sketch").take(pa.array(rows))), np.uint64).reshape(len(rows), -1)
        differ = np.zeros((len(rows), len(rows)), np.int16)
        for k in range(bits.shape[1]):
            differ += np.bitwise_count(bits[:, None, k] ^ bits[None, :, k])
        share = np.minimum((limit + radius[rows][:, None] + radius[rows][None, :]) / np.pi, 1.0)
        most = SKETCH * share + DEVIATIONS * np.sqrt(SKETCH * share * (1 - share))
        close = differ <= SKETCH * limit / np.pi
        crowd = close.sum(axis=1) > CROWDED
        region = np.arange(len(rows))
        tied = np.flatnonzero(crowd)
        forest = joined(region, tied, tied, close[np.ix_(tied, tied)])
        covered = crowd[:, None] & crowd[None, :] & (region[:, None] == region[None, :])
        a, b = np.nonzero(np.triu(differ <= most, 1) & ~(lead[rows][:, None] & lead[rows][None, :]) & ~covered)
        for i, j, crowded in ((a, b, False), (*np.array(forest, np.int64).reshape(-1, 2).T, True)):
            x, y = names[rows[i]], names[rows[j]]
            out.append((np.minimum(x, y), np.maximum(x, y), np.full(len(x), crowded)))
    return pa.table(dict(zip(("a_id", "b_id", "crowded"), map(np.concatenate, zip(*out, strict=True)), strict=True)))


#: What the comparison of two stripes returns: partners of the class of a_id, a link of the forest, a pair to compare by members.
COUNT, LINK, UNSURE = 0, 1, 2


def striped(group: pa.Table, cosine: float) -> pa.Table:
    """Links between the centres of two stripes of a region, or within one: counts, forest, unsure pairs."""
    limit = float(np.arccos(cosine))
    names, radius, n = (group.column(c).to_numpy() for c in ("cid", "radius", "n"))
    stripe, x = group.column("stripe").to_numpy(), matrix(group.column("unit"))
    low, high = int(group.column("low")[0].as_py()), int(group.column("high")[0].as_py())
    left, right = np.flatnonzero(stripe == low), np.flatnonzero(stripe == high)
    partners, labels, forest, unsure = np.zeros(len(names), np.int64), np.arange(len(names)), [], []
    for i in range(0, len(left), STEP):
        a = left[i : i + STEP]
        for j in range(i if low == high else 0, len(right), STEP):
            b = right[j : j + STEP]
            product = x[a] @ x[b].T
            for p, q in np.argwhere(np.abs(product - cosine) < 1e-12):  # as single pairs are computed
                product[p, q] = x[a[p]] @ x[b[q]]
            angle = np.arccos(np.clip(product, -1, 1))
            wide = radius[a][:, None] + radius[b][None, :]
            whole = np.where(wide == 0, product >= cosine, angle + wide <= limit - 1e-7)
            between = ~whole & (wide > 0) & (angle - wide <= limit + 1e-7)
            if low == high and i == j:
                whole, between = np.triu(whole, 1), np.triu(between, 1)
            partners[a] += whole @ n[b]
            partners[b] += whole.T @ n[a]
            forest += joined(labels, a, b, whole)
            p, q = np.nonzero(between)
            unsure.append(np.stack([a[p], b[q]], 1))
    some = np.flatnonzero(partners)
    parts = [(COUNT, names[some], names[some], partners[some])]
    for kind, found in ((LINK, np.array(forest, np.int64).reshape(-1, 2)), (UNSURE, np.concatenate([np.zeros((0, 2), np.int64), *unsure]))):
        parts.append((kind, names[found[:, 0]], names[found[:, 1]], np.zeros(len(found), np.int64)))
    return pa.table({"kind": pa.array(np.concatenate([np.full(len(a), k, np.int32) for k, a, *_ in parts])),
                     **{c: np.concatenate([p[k] for p in parts]) for k, c in ((1, "a_id"), (2, "b_id"), (3, "more"))}})


def crowded_links(centres: DataFrame, regions: DataFrame, cosine: float) -> DataFrame:
    """(kind, a_id, b_id, more) of the centres of each region (node, component), compared with each other.

    A region is dealt out by hash to stripes of about ``STRIPE`` centres; each pair of stripes is a task.
    """
    parts = regions.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / STRIPE).alias("parts"))
    dealt = (centres.join(regions, F.col("cid") == F.col("node")).join(parts, "component")
             .withColumn("stripe", F.pmod(F.xxhash64("cid"), "parts"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    rows = dealt.select("component", F.least("stripe", "other").alias("low"), F.greatest("stripe", "other").alias("high"),
                        "stripe", "cid", "radius", "n", "unit")
    return per_group(rows, ["component", "low", "high"], striped, "kind int, a_id bigint, b_id bigint, more bigint", cosine=cosine)


def near_duplicate_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                           cosine: float = 0.9, passes: int | None = None) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Pairs are linked only if their cosine in doubles is at least ``cosine``. A vector that is null,
    empty, zero, or holds a null or non-finite component links with nothing and is its own
    component; vectors of different sizes never link. Equal vectors, and equal rows, count as
    vectors of their own. The component is named by its smallest id; null ids come last. ``passes``
    follows from the number of centres (``passes_for``) if it is not given.
    """
    limit = float(np.arccos(cosine))
    units = vectors.select(F.col(id_column).alias("_id"), F.col(vector_column).cast("array<double>").alias("_vector"))
    rows = materialize(units.mapInArrow(unit_batches, typed(vectors, id_column, "unit binary")).withColumn("node", F.md5("unit")))
    points = materialize(rows.where("unit IS NOT NULL").groupBy("node").agg(
        F.first("unit").alias("unit"), F.count(F.lit(1)).alias("n"), F.min("_id").alias("least")))
    members = contract(points, cosine)
    classes = members.groupBy("leader").agg(F.sum("n").alias("n"), F.max("angle").alias("radius"), F.min("least").alias("least"))
    centres = materialize(classes.join(points.select(F.col("node").alias("leader"), "unit"), "leader")
                          .withColumn("cid", F.monotonically_increasing_id()))
    turns = range(passes or passes_for(centres.count(), limit))
    passed = centres.select("cid", "radius", "unit").mapInArrow(
        partial(sketched, turns=turns), "cid bigint, radius double, turn int, dim int, key bigint, sketch binary")
    met = materialize(per_group(blocked(passed, "cid", OVERLAP), "block", compared, "a_id bigint, b_id bigint, crowded boolean", limit=limit).distinct())
    regions = connected_components(met.where("crowded").select(F.col("a_id").alias("u"), F.col("b_id").alias("v")))
    crowd = materialize(crowded_links(centres, regions, cosine))
    found = met.where("NOT crowded").select("a_id", "b_id")
    for end in ("a", "b"):
        found = found.join(regions.select(F.col("node").alias(f"{end}_id"), F.col("component").alias(f"region_{end}")), f"{end}_id", "left")
    found = found.where("NOT coalesce(region_a = region_b, false)").select("a_id", "b_id")
    sides = {s: centres.select(F.col("cid").alias(f"{s}_id"), F.col("leader").alias(s), F.col("n").alias(f"n_{s}"),
                               F.col("radius").alias(f"r_{s}"), F.col("unit").alias(u)) for s, u in zip("ab", "xy", strict=True)}
    verified = with_angles(found.join(sides["a"], "a_id").join(sides["b"], "b_id").drop("a_id", "b_id"))
    exact = F.expr("r_a = 0 AND r_b = 0")
    widest = F.col("angle") + F.col("r_a") + F.col("r_b")
    nearest = F.col("angle") - F.col("r_a") - F.col("r_b")
    pairs = materialize(verified.withColumn("whole", F.when(exact, F.col("cosine") >= cosine).otherwise(widest <= limit - 1e-7))
                        .where(F.col("whole") | (~exact & (nearest <= limit + 1e-7))))

    name = {s: centres.select(F.col("cid").alias(f"{s}_id"), F.col("leader").alias(s)) for s in "ab"}
    named_crowd = crowd.join(name["a"], "a_id").join(name["b"], "b_id")
    by_class = (pairs.where("whole").selectExpr("a AS leader", "n_b AS more").union(pairs.where("whole").selectExpr("b", "n_a"))
                .union(named_crowd.where(F.col("kind") == COUNT).select("a", "more"))
                .groupBy("leader").agg(F.sum("more").alias("more")))
    of = members.join(points.select("node", "unit"), "node")
    between = (pairs.where("NOT whole").select("a", "b").union(named_crowd.where(F.col("kind") == UNSURE).select("a", "b"))
               .join(of.selectExpr("leader AS a", "node AS p", "n AS n_p", "unit AS x"), "a")
               .join(of.selectExpr("leader AS b", "node AS q", "n AS n_q", "unit AS y"), "b"))
    single = materialize(with_angles(between).where(F.col("cosine") >= cosine))
    by_node = (single.selectExpr("p AS node", "n_q AS extra").union(single.selectExpr("q", "n_p"))
               .groupBy("node").agg(F.sum("extra").alias("extra")))
    edges = pairs.where("whole").selectExpr("a AS u", "b AS v").union(single.selectExpr("a", "b")).union(
        named_crowd.where(F.col("kind") == LINK).select("a", "b"))
    parts = connected_components(edges).withColumnRenamed("node", "leader")
    named = centres.join(parts, "leader", "left").withColumn("component", F.coalesce("component", "leader"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "component").join(by_class, "leader", "left").select(
        "leader", "component_id", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("of_class"))
    of_node = members.join(of_class, "leader").join(by_node, "node", "left").select(
        "node", "component_id", (F.col("of_class") + F.coalesce("extra", F.lit(0))).alias("n_links"))
    return rows.select("_id", "node").join(of_node, "node", "left").select(
        F.col("_id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "_id").alias("component_id"),
        F.coalesce(F.col("_id").eqNullSafe(F.coalesce("component_id", "_id")), F.lit(True)).alias("kept"))
