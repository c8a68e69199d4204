"""Embedding near-dedup (operator 7): exact metric range join over pivots.

Vectors of cosine >= c are unit vectors at distance <= r = sqrt(2 - 2c).  Each
vector's *home* is the cell of its nearest pivot.  By the triangle inequality
a partner of x can only live in cell j if d(x, p_j) - d(x, p_home) <= 2r; the
sharper form used here asks that x is within r of the plane between the two
pivots, which implies it.  x is copied to those cells as a *visitor*.  A cell's
homes are compared with its homes and visitors, so every link is found at
both of its ends and each vector counts its links at home only: cells join
independently and nothing needs deduplication.

Scale: pivots are picked farthest-first from a bounded sample (``SAMPLE``
vectors, at most ``MAX_PIVOTS`` pivots); they only steer the partition, the
result is exact for any choice.  Equal vectors are one group throughout.  A
cell with many members is cut into blocks of a few thousand rows and every
pair of (home block, member block) is a task of its own, so a hot cell spreads.
Tasks send counts and a spanning forest of their links, never all pairs.  In
data without clusters of low dimension most cells are within r of most planes
and the join nears a blocked comparison of all rows; that is the method's
limit, not an error.

Defined cases: null, empty, zero or non-finite vectors, and rows with a null
id, have no links and are their own component; vectors of different lengths
are not linked; rows that repeat an id are one node of the components, and a
vector's own row is never its partner, but an equal vector in another row is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import components, fresh, table

SAMPLE = 2048
MAX_PIVOTS = 256
PER_PIVOT = 8192
HOME_BLOCK, MEMBER_BLOCK = 8192, 16384
LEADING = 16


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first among unit vectors; stops when all are equal to one."""
    chosen = [0]
    gap = 2 - 2 * sample @ sample[0]
    while len(chosen) < n and gap.max() > 1e-9:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, 2 - 2 * sample @ sample[chosen[-1]])
    return sample[chosen]


def cells_of(unit: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector and the (vector, cell) table of membership."""
    gap = np.maximum(2 - 2 * unit @ pivots.T, 0)
    home = gap.argmin(axis=1)
    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 1e-18))
    plane = (gap - gap[np.arange(len(unit)), home][:, None]) / (2 * between[home])
    member = plane <= radius + 1e-7
    member[np.arange(len(unit)), home] = True
    return home, member


def _leading(unit: np.ndarray) -> np.ndarray:
    """The first components and the norm of the rest: by Cauchy-Schwarz, the
    product of two such rows is at least the vectors' cosine."""
    head = unit[:, :LEADING]
    rest = np.sqrt(np.maximum(1 - (head * head).sum(axis=1), 0))
    return np.column_stack([head, rest]).astype(np.float32)


def linked(rows: np.ndarray, others: np.ndarray, least: float):
    """(i, j) in parts: all pairs with cosine >= least.  Pairs whose bound
    allows it are computed in double precision, doubtful ones by the plain
    formula."""
    a, b = _unit(rows), _unit(others)
    bound_a, bound_b = _leading(a), _leading(b).T
    for first in range(0, len(a), 256):
        near = np.flatnonzero(bound_a[first : first + 256] @ bound_b >= np.float32(least - 1e-5))
        for cut in range(0, len(near), 100_000):
            i, j = np.divmod(near[cut : cut + 100_000], len(b))
            i += first
            cosine = np.einsum("ij,ij->i", a[i], b[j])
            keep = cosine >= least
            for k in np.flatnonzero(np.abs(cosine - least) < 1e-12):
                x, y = rows[i[k]], others[j[k]]
                keep[k] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least
            yield i[keep], j[keep]


def forest(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a bipartite link table."""
    edges, fresh_left, fresh_right = [], np.ones(len(left), bool), np.ones(len(right), bool)
    for root in range(len(left)):
        if not fresh_left[root]:
            continue
        fresh_left[root] = False
        front = np.array([root])
        while len(front):
            reach = np.flatnonzero(link[front].any(axis=0) & fresh_right)
            fresh_right[reach] = False
            edges += [(int(left[root]), int(right[j])) for j in reach]
            front = np.flatnonzero(link[:, reach].any(axis=1) & fresh_left)
            fresh_left[front] = False
            edges += [(int(left[root]), int(left[i])) for i in front]
    return edges


def near_duplicates(vectors: DataFrame, least: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id) of every row, exact."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))
    # Single-precision vectors travel as such; tasks compute in double precision.
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    sound = F.coalesce((F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    # Two independent 64-bit hashes spread equal vectors (-0.0 and 0.0 alike);
    # the vectors themselves are compared wherever equality counts.
    value = F.transform("vec", lambda x: x + F.lit(0.0).cast(kind))
    rows = rows.select("vec_id", F.when(sound, value).alias("vec"))
    rows = rows.withColumn("h1", F.xxhash64(F.lit(1), "vec")).withColumn("h2", F.xxhash64(F.lit(2), "vec"))
    groups = rows.where("vec IS NOT NULL").groupBy("h1", "h2", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = fresh(groups.withColumn("dim", F.size("vec")))

    n_groups = groups.count()
    n_pivots = min(MAX_PIVOTS, max(1, -(-n_groups // PER_PIVOT)))
    sample = groups.select("dim", "vec").orderBy(F.xxhash64("h1", F.lit(5)), "h2").limit(SAMPLE).collect()  # bounded; only steers the partition
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(r["vec"])
    pivots = {d: pick_pivots(_unit(np.array(v)), n_pivots) for d, v in by_dim.items()}

    def assign(batches):
        names = ["cell", "at_home", "dim", "rep", "copies", "vec"]
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                dims = part.column(3).to_numpy()
                for dim in np.unique(dims):
                    own = part.filter(pa.array(dims == dim))
                    unit = _unit(_matrix(own.column(2)))
                    if dim in pivots:
                        home, member = cells_of(unit, pivots[dim], radius)
                    else:
                        home, member = np.zeros(len(unit), np.int64), np.ones((len(unit), 1), bool)
                    at, cell = np.nonzero(member)
                    for cut in range(0, len(at), 4096):
                        a, c = at[cut : cut + 4096], cell[cut : cut + 4096]
                        taken = own.take(pa.array(a))
                        columns = [pa.array(c, pa.int32()), pa.array(home[a] == c), pa.array(np.full(len(a), dim), pa.int32()), taken.column(0), taken.column(1), taken.column(2)]
                        yield pa.record_batch(columns, names=names)

    members = groups.select("rep", "copies", "vec", "dim").mapInArrow(assign, f"cell int, at_home boolean, dim int, rep long, copies long, vec array<{kind}>")
    members = fresh(members)
    sizes = members.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("at_home").alias("homes"))
    sizes = sizes.select("dim", "cell", F.ceil(F.col("homes") / HOME_BLOCK).cast("int").alias("home_blocks"), F.ceil(F.col("n") / MEMBER_BLOCK).cast("int").alias("blocks")).where("home_blocks > 0")
    dealt = members.join(sizes, ["dim", "cell"])
    spread = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    copy = lambda a, b, left: F.struct(a.alias("a"), b.alias("b"), F.lit(left).alias("is_left"))
    as_right = F.transform(every(F.col("home_blocks")), lambda a: copy(a, spread(F.col("blocks"), "right"), False))
    as_left = F.transform(every(F.col("blocks")), lambda b: copy(spread(F.col("home_blocks"), "left"), b, True))
    places = F.when(F.col("at_home"), F.concat(as_left, as_right)).otherwise(as_right)
    dealt = dealt.select("dim", "cell", "rep", "copies", "vec", F.explode(places).alias("p")).select("dim", "cell", "rep", "copies", "vec", "p.*")

    def compare(_key, group):
        left, right = (group.filter(pa.compute.equal(group["is_left"], v)) for v in (True, False))
        out = {"rep": [], "links": [], "a": [], "b": []}
        if left.num_rows and right.num_rows:
            ids, other, copies = (t.to_numpy() for t in (left["rep"], right["rep"], right["copies"]))
            links = np.zeros(len(ids), np.int64)
            pairs = []
            for i, j in linked(_matrix(left["vec"]), _matrix(right["vec"]), least):
                keep = ids[i] != other[j]
                np.add.at(links, i[keep], copies[j[keep]])
                pairs.append((i[keep], j[keep]))
            some = np.flatnonzero(links)
            edges = []
            if len(some):
                i, j = (np.concatenate(x) for x in zip(*pairs))
                left_ids, at_left = np.unique(ids[i], return_inverse=True)
                right_ids, at_right = np.unique(other[j], return_inverse=True)
                link = left_ids[:, None] == right_ids[None, :]  # a row's two roles are one node
                link[at_left, at_right] = True
                edges = [e for e in forest(link, left_ids, right_ids) if e[0] != e[1]]
            n = max(len(some), len(edges))
            pad = lambda x: x + [None] * (n - len(x))
            out = {"rep": pad(ids[some].tolist()), "links": pad(links[some].tolist()), "a": pad([e[0] for e in edges]), "b": pad([e[1] for e in edges])}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    found = fresh(dealt.groupBy("dim", "cell", "a", "b").applyInArrow(compare, "rep long, links long, a long, b long"))
    links = found.where("rep IS NOT NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("a IS NOT NULL").select("a", "b"))
    groups = groups.select("h1", "h2", "vec", "rep", "copies").join(links, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    groups = groups.select("h1", "h2", "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    return rows.join(groups, ["h1", "h2", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )


def op7_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
