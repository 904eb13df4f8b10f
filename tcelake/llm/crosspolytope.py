"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations, multiprobe buckets and verification.

A pseudo-random rotation (three rounds of sign flips and a fast Walsh-Hadamard transform) sends a unit vector to the nearest
vertex of the cross-polytope, i.e. its largest coordinate and that one's sign. A bucket is named by the vertices of a
few rotations; the last one looks at fewer coordinates, so that a table has about as many buckets as there are vectors. Every vector
stands in its own bucket of each table and also probes the buckets it missed most narrowly. Tables grow with the length of the names, so
that recall stays where it is (tests and README have it measured at several sizes).

Groups of copies are never paired out:

* Equal vectors are one vector with a count.
* Vectors that lie within half the linking angle of their bucket's smallest vec_id form a ball around it: all of its members
  are linked with each other by the triangle inequality, so a ball is one post per bucket, one row and a radius.
* Balls that meet are verified by the cosine of their centres in double precision: two single vectors by that alone; larger balls are
  linked whole or not at all where angle and radii decide it, and member by member, in blocks within tasks, where not.

A sketch of 256 signs travels with the posts, so that far pairs are dropped inside the join; it asks for an angle that true links
exceed with a probability below 1e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tcelake.llm.common import written
from tcelake.llm.graph import components

PROBES = 6                   # buckets a vector looks into, its own included
TABLES_PER_BIT = 0.6         # tables for each bit of a bucket name
SIGNS = 256                  # bits of a sketch
SLACK = 40                   # signs by which a sketch may exceed its expected distance: 5 standard deviations at most
BLOCK = 512                  # members of a ball that a task compares with as many others
SALTS = 8                    # copies of a bucket's smallest member over which its other members are dealt
MARGIN = 1e-7                # of an angle: decided by the members themselves
SEED = 20_24


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length is a power of two), scaled to keep lengths."""
    n, size = x.shape[1], 1
    while size < n:
        x = x.reshape(len(x), -1, 2, size)
        x = np.concatenate((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(len(x), n)
        size *= 2
    return x / math.sqrt(n)


def rotated(x: np.ndarray, *seed: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, *seed, x.shape[1]])
    for _ in range(3):
        x = hadamard(x * rng.choice((-1.0, 1.0), x.shape[1]))
    return x


def layout(rows: int, dims: int) -> tuple[int, list[int]]:
    """Tables, and the coordinates that each rotation of a table looks at: their vertices name about ``rows`` buckets."""
    bits, out, whole = max(1.0, math.log2(max(rows, 8))), [], math.log2(2 * dims)
    tables = math.ceil(TABLES_PER_BIT * bits)
    while bits > 0.5:
        out.append(dims if bits >= whole else max(1, 2 ** round(bits - 1)))
        bits -= whole
    return tables, out


def codes(unit: np.ndarray, table: int, parts: list[int]) -> np.ndarray:
    """Bucket names in one table, a row per vector: its own and, after it, its nearest misses."""
    names = np.zeros((len(unit), 1), dtype=np.int64)
    costs = np.zeros((len(unit), 1))
    for part, looked in enumerate(parts):
        y = rotated(unit, table, part)[:, :looked]
        both = np.concatenate((y, -y), axis=1)                       # vertex v: coordinate v % looked, sign by half
        few = min(4, both.shape[1])
        best = np.argsort(-both, axis=1, kind="stable")[:, :few]
        height = np.take_along_axis(both, best, axis=1)
        loss = (height[:, :1] - height) ** 2
        names = (names[:, :, None] * (2 * looked) + best[:, None, :]).reshape(len(unit), -1)
        costs = (costs[:, :, None] + loss[:, None, :]).reshape(len(unit), -1)
        keep = np.argsort(costs, axis=1, kind="stable")[:, :PROBES]
        names, costs = np.take_along_axis(names, keep, axis=1), np.take_along_axis(costs, keep, axis=1)
    return names


def sketch(unit: np.ndarray) -> np.ndarray:
    """``SIGNS`` signs of rotated coordinates as 64-bit integers, a row per vector."""
    dims = unit.shape[1]
    signs = [rotated(unit, 1_000_000 + n)[:, :SIGNS] > 0 for n in range(-(-SIGNS // dims))]
    return np.packbits(np.concatenate(signs, axis=1)[:, :SIGNS], axis=1, bitorder="little").view("<i8")


def unit_rows(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, unit vectors)`` of an Arrow list column by length; each vector's largest component is taken out first: no overflow."""
    sizes = column.value_lengths().to_numpy()
    flat, begin = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = flat[begin[at][:, None] + np.arange(size)].astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """``id, n, embedding``: distinct usable vectors with their smallest vec_id and their number."""
    value = F.col("embedding")
    usable = (F.size(value) > 0) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == math.inf)) & F.exists(value, lambda v: v != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & value.isNotNull() & usable).groupBy("embedding").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"))


def signed(vectors: DataFrame, rows: int) -> DataFrame:
    """``id, signs, own, probes``: a vector's sketch, its own buckets and those that it only probes."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                ids = part.column(0).to_numpy()
                for at, x in unit_rows(part.column(1)):
                    size = x.shape[1]
                    x = np.pad(x, ((0, 0), (0, (1 << max(0, size - 1).bit_length()) - size)))
                    tables, parts = layout(rows, x.shape[1])
                    names = np.stack([codes(x, t, parts) * tables + t for t in range(tables)], axis=1) * 4099 + size
                    lists = [list(v.reshape(len(at), -1)) for v in (sketch(x), names[:, :, 0], names[:, :, 1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), *[pa.array(v, pa.list_(pa.int64())) for v in lists]], names=["id", "signs", "own", "probes"])

    return vectors.select("id", "embedding").mapInArrow(run, "id long, signs array<long>, own array<long>, probes array<long>")


def alike(x: str, y: str, angle: Column) -> Column:
    """Whether two sketches are as near as vectors within ``angle`` (radians) must be."""
    differ = sum((F.bit_count(F.get(x, i).bitwiseXOR(F.get(y, i))) for i in range(SIGNS // 64)), F.lit(0))
    return differ <= angle * (SIGNS / math.pi) + SLACK


def with_angles(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """The pairs ``a, b, ...`` with the cosine of their vectors and its angle, in double precision; none of different lengths."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            cosine = np.empty(batch.num_rows)
            x, y = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y"))
            for (at, u), (_, v) in zip(unit_rows(x), unit_rows(y)):
                cosine[at] = np.einsum("ij,ij->i", u, v)
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c not in ("x", "y")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(cosine), pa.array(np.arccos(np.clip(cosine, -1, 1)))],
                                             names=[*(c for c in batch.schema.names if c not in ("x", "y")), "cosine", "angle"])

    schema = ", ".join(f"{c} {t}" for c, t in pairs.dtypes) + ", cosine double, angle double"
    x = vectors.select(F.col("id").alias("a"), F.col("embedding").alias("x"))
    y = vectors.select(F.col("id").alias("b"), F.col("embedding").alias("y"))
    both = pairs.join(x, "a").join(y, "b").filter(F.size("x") == F.size("y"))
    return both.select(*pairs.columns, "x", "y").mapInArrow(run, schema)


def balls(vectors: DataFrame, signs: DataFrame, angle: float) -> DataFrame:
    """``id, centre, off``: every vector's ball and its angle to the centre, at most half of ``angle``.

    Buckets propose their smallest id as centre. A vector that has a verified proposal is no centre itself; it joins the
    nearest proposed one that is, or stays alone."""
    posts = signs.select("id", "signs", F.explode("own").alias("key"))
    smallest = posts.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "signs")).alias("first")).filter("n > 1")
    smallest = smallest.select("key", F.col("first.id").alias("a"), F.col("first.signs").alias("first_signs"),
                               F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    posts = posts.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    met = posts.join(smallest, ["key", "salt"]).filter((F.col("id") != F.col("a")) & alike("signs", "first_signs", F.lit(angle / 2)))
    proposed = with_angles(met.select("a", F.col("id").alias("b")).distinct(), vectors).filter(F.col("angle") <= angle / 2 - MARGIN)
    proposed = written(proposed, "proposed")
    centres = proposed.join(proposed.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    joined = centres.groupBy(F.col("b").alias("id")).agg(F.min(F.struct("angle", "a")).alias("m"))
    return signs.select("id").join(joined, "id", "left").select("id", F.coalesce("m.a", "id").alias("centre"), F.coalesce("m.angle", F.lit(0.0)).alias("off"))


def met_balls(signs: DataFrame, members: DataFrame, groups: DataFrame, angle: float) -> DataFrame:
    """``a, b``: centres of balls that meet in a bucket, one member's own and the other's own or probed, with near enough sketches."""
    placed = signs.join(members.select("id", "centre"), "id").join(groups.select("centre", "radius", "size"), "centre")
    key = lambda df, c, own: df.select("centre", F.lit(own).alias("own"), F.explode(c).alias("key"))
    many = placed.filter("size > 1")
    many = key(many, "own", True).unionByName(key(many, "probes", False)).groupBy("centre", "key").agg(F.max("own").alias("own"))
    many = many.join(groups.select("centre", "radius"), "centre").join(signs.select(F.col("id").alias("centre"), "signs"), "centre")
    one = placed.filter("size = 1")
    posts = many.select("centre", "signs", "radius", "own", "key")
    for c, own in (("own", True), ("probes", False)):
        posts = posts.unionByName(one.select("centre", "signs", "radius", F.lit(own).alias("own"), F.explode(c).alias("key")))
    owned = posts.filter("own").select("key", F.col("centre").alias("p"), F.col("signs").alias("p_signs"), F.col("radius").alias("p_radius"))
    met = owned.join(posts, "key").filter((F.col("p") != F.col("centre")) & alike("p_signs", "signs", angle + F.col("p_radius") + F.col("radius")))
    return met.select(F.least("p", "centre").alias("a"), F.greatest("p", "centre").alias("b")).distinct()


def member_links(near: DataFrame, members: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """``a, b, id, others``: how many vectors of ball ``b`` the member ``id`` of ball ``a`` is linked with, and the other way round, for
    the pairs of balls ``near``; balls are dealt into blocks and two blocks compared as a whole within a task."""
    sized = members.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sized, "centre").select("centre", "id", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    of = lambda c, n: sized.select(F.col("centre").alias(c), F.col("blocks").alias(n))
    tasks = near.select("a", "b").join(of("a", "n_a"), "a").join(of("b", "n_b"), "b")
    tasks = tasks.select("a", "b", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("i"), "n_b").select(
        "a", "b", "i", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("j"))
    side = lambda c, n, left: tasks.join(dealt.select(F.col("centre").alias(c), "id", F.col("block").alias(n)), [c, n]).select(
        "a", "b", "i", "j", "id", F.lit(left).alias("left"))
    rows = side("a", "i", True).unionByName(side("b", "j", False)).join(vectors.select("id", "n", "embedding"), "id")

    def compare(table):
        import pyarrow as pa
        left = table["left"].to_numpy(zero_copy_only=False)
        (_, x), = unit_rows(table["embedding"].combine_chunks())
        linked = x[left] @ x[~left].T >= least
        ids, n = table["id"].to_numpy(), table["n"].to_numpy()
        others = np.concatenate((linked @ n[~left], linked.T @ n[left]))
        ids = np.concatenate((ids[left], ids[~left]))
        hit = others > 0
        return pa.table({"a": np.full(hit.sum(), table["a"][0].as_py()), "b": np.full(hit.sum(), table["b"][0].as_py()), "id": ids[hit], "others": others[hit]})

    return rows.groupBy("a", "b", "i", "j").applyInArrow(compare, "a long, b long, id long, others long")


def near_duplicates(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``; other columns are ignored).

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing, nor do vectors of
    different lengths or rows without vec_id. Equal vectors are linked; a vec_id that repeats counts each of its rows.
    An empty table gives an empty one, a table without links one of single vectors."""
    angle = math.acos(least)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    distinct = written(distinct_vectors(vectors), "vectors")
    signs = written(signed(distinct, distinct.count()), "signs")
    members = written(balls(distinct, signs, angle), "balls")
    weights = members.join(distinct.select("id", "n"), "id")
    groups = weights.groupBy("centre").agg(F.max("off").alias("radius"), F.count("*").alias("size"), F.sum("n").alias("weight"))

    ball = lambda c: groups.select(F.col("centre").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("radius", "size", "weight")])
    pairs = with_angles(met_balls(signs, members, groups, angle), distinct).join(ball("a"), "a").join(ball("b"), "b")
    reach = F.col("a_radius") + F.col("b_radius")
    single = (F.col("a_size") == 1) & (F.col("b_size") == 1)
    whole = F.when(single, F.col("cosine") >= least).otherwise(F.col("angle") + reach <= angle - MARGIN)
    partly = ~single & (F.col("angle") - reach <= angle + MARGIN)
    pairs = written(pairs.withColumn("whole", whole).filter(F.col("whole") | partly).select("a", "b", "whole", "a_weight", "b_weight"), "ball-links")
    by_member = written(member_links(pairs.filter("not whole"), members, distinct, least), "member-links")

    links = pairs.filter("whole").select("a", "b").unionByName(by_member.select("a", "b"))
    labels = components(links).select(F.col("id").alias("centre"), "component")
    sides = [pairs.filter("whole").select(F.col(x).alias("centre"), F.col(f"{y}_weight").alias("others")) for x, y in ("ab", "ba")]
    around = sides[0].unionByName(sides[1]).groupBy("centre").agg(F.sum("others").alias("around"))
    some = by_member.groupBy("id").agg(F.sum("others").alias("some"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    named = distinct.select("id", "embedding").join(members.select("id", "centre"), "id").join(groups.select("centre", "weight"), "centre").join(
        labels, "centre", "left").join(around, "centre", "left").join(some, "id", "left").select(
        "embedding", (F.col("weight") - 1 + zero("around") + zero("some")).alias("links"), F.coalesce("component", "centre").alias("component"))
    own = vectors.join(named, "embedding", "left")
    has_id = F.col("vec_id").isNotNull()
    component = F.when(has_id, F.coalesce("component", "vec_id"))
    return own.select("vec_id", F.when(has_id, zero("links")).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
