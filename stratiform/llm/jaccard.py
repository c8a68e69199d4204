"""N-gram Jaccard join (operator 4): size-aware heavy-light set join.

Documents are sets of hashed word shingles, linked by the rule
100 * intersection >= 75 * union.  No step estimates; shingles are told apart by
48 bits and the part of a 64-bit hash of their words' 64-bit hashes.

1. ``shingles``: sets per row; entries (shingle, row) go to parts by hash as
   packed numpy columns, about six bytes an entry.
2. Each part counts its shingles' document frequencies and sends back the
   entries whose shingle occurs in two documents or more.
3. By row: a document less than three quarters of whose shingles occur
   elsewhere cannot link and leaves.  The others put their shingles in one
   global order, rarest first, and keep the *head* that the overlap bound
   allows: two linked sets share one shingle of the heads of length
   n - c + 1, and two shingles of the heads of length n - c + 2, with
   c = ceil(0.75 n).
4. Equal sets are one node from here on.
5. Heavy-light: light (small) sets enumerate the two-element subsets of their
   heads and meet in equal subsets; heavy (large) sets scan the inverted
   lists of their head's shingles, to which light sets near the boundary are
   posted too.  The boundary is the size class of least total cost, subsets
   enumerated plus list entries scanned.
6. Lists and subsets are buckets; those with the same members are one.  Members
   of a bucket are in a random order.  Small buckets compare all their pairs at
   once; in a large one the first member, then the first 64, then the first
   4,096, then all are *hubs* that meet the later members of other components.
   After each round the links found join components, and buckets whose other
   members are connected drop out, so a group of near copies costs about one
   comparison a member, and every pair that could join two components is met.
7. A pair is joined only if its sizes and *sketches* allow a link: parities of
   the shared shingles in 512 bits.  Sets differ in at least as many shingles as
   their sketches differ in bits, and linked ones in at most a seventh of their
   sizes' sum, so no link is lost, and pairs that are far apart are never
   written.  The rest is verified by counting common shingles.
8. Components are kept from round to round; only links between components that
   were apart are contracted.

Nothing is capped: a hot shingle is last in the order, a hot bucket's hubs are
joined to its members as an ordinary skew-splittable join.

Defined cases: null and empty texts have no shingles and link with nothing; a
text of one to four words is one shingle; every row is a document, so equal
rows link; a component's id is its least non-null document id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratiform.llm.common import CHUNK_BYTES, RangeHash, components, fresh, id_text, lowered, mix, pack, release, row_groups, table, unpack, utf8, words

WIDTH = 5
PART_BYTES = 8 << 20  # text bytes whose shingles share a part
_BITS = np.uint64(48)  # of a shingle's hash, beside its part
_LOW = np.uint64((1 << 48) - 1)
_FLUSH = 2_000_000
FEW = 12  # members of a bucket whose pairs are all compared in the first round
HUBS = (1, 64, 4096)  # hubs of a larger bucket, in the rounds before all are
SKETCH = 8  # 64-bit words of a sketch
ROLLED = 64  # bytes up to which a word has a rolling hash
_STEPS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, WIDTH + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NO_ID = np.uint64(1 << 63)


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words.  A polynomial modulo 2**64 has built-in collisions
    from 1,024 bytes on, whatever its base, so long words take another hash."""
    out = RangeHash(data).of(starts, ends)
    for i in np.flatnonzero(ends - starts > ROLLED):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word; a long row is hashed in parts cut at blanks."""
    if len(data) <= 2 * CHUNK_BYTES:
        starts, ends, rows = words(data, offsets)
        return _hashed(data, starts, ends), rows
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data):
            blank = np.flatnonzero(np.isin(data[end : end + CHUNK_BYTES], (0x20, 9, 10, 11, 12, 13)))
            if len(blank):
                end += int(blank[0])
                break
            end = min(len(data), end + CHUNK_BYTES)
        part = data[at:end]
        starts, ends, _ = words(part, np.array([0, len(part)]))
        out.append(_hashed(part, starts, ends))
        at = end
    hashes = np.concatenate(out)
    return hashes, np.zeros(len(hashes), np.int64)


def row_shingles(column: pa.Array):
    """(first row, rows, row, shingle hash) with distinct hashes in each row."""
    data, offsets = utf8(column)
    for first, last in row_groups(offsets):
        part = lowered(data[offsets[first] : offsets[last]])
        word, rows = _word_hashes(part, offsets[first : last + 1] - offsets[first])
        n = max(0, len(word) - WIDTH + 1)
        full = rows[:n] == rows[WIDTH - 1 :]
        each = sum((word[j : j + n] * _STEPS[j] for j in range(WIDTH)), np.zeros(n, np.uint64))
        hashes, owner = [mix(each[full])], [rows[:n][full]]
        counts = np.bincount(rows, minlength=last - first)
        for size in range(1, WIDTH):
            short = np.flatnonzero(counts == size)
            at = np.searchsorted(rows, short)
            hashes.append(mix(sum((word[at + j] * _STEPS[j] for j in range(size)), np.full(len(at), size, np.uint64) * _STEPS[WIDTH])))
            owner.append(short)
        h, r = np.concatenate(hashes), np.concatenate(owner)
        order = np.lexsort((h, r))
        h, r = h[order], r[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        yield first, last - first, r[new], h[new]


def _entries(docs: DataFrame, n_parts: int) -> DataFrame:
    """(part, blob): shingle entries by hash; from ``n_parts`` on, row facts."""

    def run(batches):
        release()
        base = np.uint64(TaskContext.get().partitionId() << 33)
        done = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            h, r = (np.concatenate(x) for x in zip(*held))
            held.clear()
            part = (mix(h) % np.uint64(n_parts)).astype(np.int32)
            low = h & _LOW
            del h
            order = np.lexsort((low, part))
            part = part[order]  # one after the other: each frees what it replaces
            low = low[order]
            r = r[order]
            del order
            least = r.min() if len(r) else np.uint64(0)
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
            for at in range(0, len(edges) - 1, 16):
                some = list(zip(edges[at : at + 16], edges[at + 1 : at + 17]))
                blobs = [pack(np.diff(low[a:b], prepend=np.uint64(0)), r[a:b] - least, np.array([base + least])) for a, b in some]
                yield pa.record_batch([pa.array([int(part[a]) for a, _ in some], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

        for batch in batches:
            for first, n, r, h in row_shingles(batch.column(1)):
                counts = np.bincount(r, minlength=n)
                starts = np.concatenate([[0], np.cumsum(counts)])
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(s)))]) for s in (0x51, 0xA7)]
                digest = [s[starts[1:]] - s[starts[:-1]] for s in sums]
                ids = batch.column(0).slice(first, n)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                number = np.where(known, ids.fill_null(0).to_numpy().view(np.uint64) ^ _NO_ID, np.uint64(0))
                rows = np.arange(done, done + n).astype(np.uint64) + base
                facts = pack(rows, number, known, counts.astype(np.uint64), *digest)
                yield pa.record_batch([pa.array([n_parts + done % n_parts], pa.int32()), pa.array([facts], pa.binary())], names=["part", "blob"])
                held.append((h, r.astype(np.uint64) + np.uint64(done)))
                done += n
                if sum(len(x[0]) for x in held) >= _FLUSH:
                    yield from flush()
        if held:
            yield from flush()
        release()

    return docs.mapInArrow(run, "part int, blob binary")


def _shared(entries: DataFrame, n_parts: int) -> DataFrame:
    """(home, blob): entries of shingles in two rows or more, and row facts,
    by blocks of rows."""
    home_of = lambda rows: (mix(rows >> np.uint64(9)) % np.uint64(n_parts)).astype(np.int64)

    def run(key, group):
        part = key[0].as_py()
        blobs = [unpack(b) for b in group["blob"].to_pylist()]
        if part >= n_parts:
            columns = [np.concatenate(c) for c in zip(*blobs)]
            rows, kind = columns[0], 1
        else:
            low = np.concatenate([np.cumsum(b[0]) for b in blobs])
            rows = np.concatenate([b[1] + b[2][0] for b in blobs])
            order = np.argsort(low)
            low, rows = low[order], rows[order]
            edge = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1], [True]]))
            count = np.diff(edge)
            df = np.repeat(count, count)
            keep = df >= 2
            rows, kind = rows[keep], 0
            columns = [rows, low[keep], np.minimum(df[keep], 255)]
        home = home_of(rows)
        order = np.lexsort((rows, home))
        columns = [c[order] for c in columns]
        home = home[order]
        edge = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1], [True]])) if len(home) else np.zeros(1, np.int64)
        out = []
        for a, b in zip(edge[:-1], edge[1:]):
            least = columns[0][a]
            own = [np.diff(columns[0][a:b], prepend=least), *(c[a:b] for c in columns[1:])]
            out.append((int(home[a]), pack(np.array([kind, part, least]), *own)))
        release()
        return pa.table({"home": pa.array([h for h, _ in out], pa.int32()), "blob": pa.array([b for _, b in out], pa.binary())})

    return entries.groupBy("part").applyInArrow(run, "home int, blob binary")


def _candidates(shared: DataFrame) -> DataFrame:
    """A row per document; those that may link have their shared shingles
    (packed, sorted) and head (rarest first)."""

    def run(_key, group):
        facts, entries = [], []
        for blob in group["blob"].to_pylist():
            (kind, part, least), *columns = unpack(blob)
            rows = np.cumsum(columns[0]) + least
            if kind:
                facts.append([rows, *columns[1:]])
            else:
                entries.append((rows, (part << _BITS) | columns[1], columns[2]))
        rows, number, known, size, d1, d2 = (np.concatenate(c) for c in zip(*facts))
        order = np.argsort(rows)
        rows, number, known, size, d1, d2 = (c[order] for c in (rows, number, known, size, d1, d2))
        tokens: list[bytes | None] = [None] * len(rows)
        heads: list[list[int] | None] = [None] * len(rows)
        sketches: list[list[int] | None] = [None] * len(rows)
        held = np.zeros(len(rows), np.uint64)
        if entries:
            owner, token, df = (np.concatenate(c) for c in zip(*entries))
            order = np.lexsort((token, df, owner))
            owner, token = owner[order], token[order]
            edge = np.searchsorted(owner, np.concatenate([rows, rows[-1:] + np.uint64(1)]))
            count = np.diff(edge)
            held = count.astype(np.uint64)
            n = size.astype(np.int64)
            for i in np.flatnonzero((n > 0) & (4 * count >= 3 * n)):
                own = token[edge[i] : edge[i + 1]]
                bound = -(-3 * n[i] // 4)
                tokens[i] = pack(np.diff(np.sort(own), prepend=np.uint64(0)))
                sketches[i] = sketch(own).tolist()
                heads[i] = own[: min(len(own), len(own) - bound + 2)].astype(np.int64).tolist()
        ids = pa.array((number ^ _NO_ID).view(np.int64), pa.int64(), mask=known == 0)
        as_long = lambda x: pa.array(x.view(np.int64))
        entries.clear()
        release()
        return pa.table({"row": as_long(rows), "doc_id": ids, "n": as_long(size), "d1": as_long(d1), "d2": as_long(d2), "tokens": pa.array(tokens, pa.binary()), "head": pa.array(heads, pa.list_(pa.int64())), "lone": as_long(size - held), "sketch": pa.array(sketches, pa.list_(pa.int64()))})

    return shared.groupBy("home").applyInArrow(run, "row long, doc_id long, n long, d1 long, d2 long, tokens binary, head array<long>, lone long, sketch array<long>")


def sketch(tokens: np.ndarray) -> np.ndarray:
    """How many of the tokens fall on each bit, modulo two.  Tokens that two
    sets share cancel out, so sketches differ in at most as many bits as the sets
    in tokens."""
    bits = np.bincount((mix(tokens) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def boundary(sets: DataFrame) -> int:
    """The size class (floor of log2) from which scanning lists is cheaper
    than enumerating subsets: the least total cost.  A subset costs one; an
    entry of a list of m sets is scanned once in each of the about log2(m)
    rounds of hubs, and once to be grouped.  At most 64 classes reach the
    driver."""
    cls = F.floor(F.log2("n")).cast("int")
    light = sets.groupBy(cls.alias("cls")).agg(F.sum(F.size("head") * (F.size("head") - 1) / 2).alias("cost")).collect()
    posts = sets.select(cls.alias("cls"), F.explode(F.slice("head", F.lit(1), F.size("head") - 1)).alias("token"))
    lists = posts.groupBy("token", "cls").agg(F.count(F.lit(1)).alias("c"))
    total = F.sum("c").over(Window.partitionBy("token"))
    heavy = lists.withColumn("total", total).groupBy("cls").agg(F.sum(F.col("c") * (1 + F.log2("total"))).alias("cost")).collect()
    below, above = ({r["cls"]: r["cost"] for r in rows} for rows in (light, heavy))
    cost = lambda b: sum(v for c, v in below.items() if c < b) + sum(v for c, v in above.items() if c >= b)
    return min(range(65), key=lambda b: (cost(b), b))


def buckets(sets: DataFrame, bound: int) -> DataFrame:
    """(bucket, size, rep, n, lone, sketch, place): subsets of light sets and
    lists for heavy ones, one bucket for each distinct membership of two or
    more; ``place`` in [0, 1) is the member's random place in every bucket."""
    cls = F.floor(F.log2("n")).cast("int")
    size = F.size("head")
    subsets = F.flatten(F.transform("head", lambda x, i: F.transform(F.slice("head", i + 2, size), lambda y: F.xxhash64(F.lit(2), x, y))))
    lists = F.transform(F.slice("head", F.lit(1), size - 1), lambda x: F.xxhash64(F.lit(1), x))
    many = sets.where(size > 1)
    posts = many.where(cls < bound).select("rep", F.explode(subsets).alias("bucket"))
    posts = posts.union(many.where(cls >= bound - 1).select("rep", F.explode(lists).alias("bucket")))
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), "rep").cast("decimal(38,0)"))
    member = posts.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), wide(1).alias("f1"), wide(2).alias("f2")).where("size > 1")
    kept = member.groupBy("size", "f1", "f2").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    place = F.xxhash64(F.lit(3), "rep") / F.lit(2.0**64) + 0.5
    return posts.join(kept, "bucket").join(sets.select("rep", "n", "lone", "sketch"), "rep").withColumn("place", place)


def may_link(n: Column, lone: Column, own: Column, m: Column, other_lone: Column, other: Column) -> Column:
    """Whether sizes and sketches allow two sets to link: they may differ in at
    most a seventh of n + m; shingles that no other document has always differ."""
    apart = lone + other_lone
    for i in range(SKETCH):
        apart = apart + F.bit_count(F.get(own, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i))))
    return (4 * n >= 3 * m) & (4 * m >= 3 * n) & (7 * apart <= n + m)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, la, lb) whose sets link, by counting their common shingles."""
    sets = sets.select("rep", "n", "tokens")
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "na", "nb", "ta", "tb", "la", "lb")

    def run(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            keep, last, own = np.zeros(len(a), bool), None, None
            for i in range(len(a)):
                if a[i] != last:  # sorted by the join: a hub's pairs follow each other
                    last, own = a[i], np.cumsum(unpack(batch.column(4)[i].as_py())[0])
                other = np.cumsum(unpack(batch.column(5)[i].as_py())[0])
                at = np.searchsorted(own, other)
                common = int((own[np.minimum(at, len(own) - 1)] == other).sum())
                keep[i] = 100 * common >= 75 * (na[i] + nb[i] - common)
            yield pa.record_batch([batch.column(6).filter(pa.array(keep)), batch.column(7).filter(pa.array(keep))], names=["la", "lb"])

    return both.mapInArrow(run, "la long, lb long")


def linked_components(sets: DataFrame) -> DataFrame:
    """(node, component) of every distinct set."""
    posts = fresh(buckets(sets, boundary(sets)))
    labels = sets.select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    met = 0  # places times size below which members have met all later ones
    for hubs in (*HUBS, None):
        live = posts.where(F.col("place") * F.col("size") >= met)
        live = live.join(labels, live["rep"] == labels["node"]).drop("node").withColumnRenamed("component", "label")
        mixed = live.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct("place", "rep")).alias("lead")).where("lo < hi")
        live = fresh(live.join(mixed.select("bucket", "lead"), "bucket"))
        if live.isEmpty():
            break
        few = F.col("size") <= FEW
        hub = F.lit(True) if hubs is None else few | (F.col("place") * F.col("size") < hubs) | (F.struct("place", "rep") == F.col("lead"))
        x, y = live.where(hub).alias("x"), live.alias("y")
        later = F.struct("x.place", "x.rep") < F.struct("y.place", "y.rep")
        near = may_link(*[F.col(f"{side}.{c}") for side in "xy" for c in ("n", "lone", "sketch")])
        pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & later & (F.col("x.label") != F.col("y.label")) & near)
        pairs = pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.label").alias("la"), F.col("y.label").alias("lb")).distinct()
        found = components(_verified(pairs, sets), "la", "lb")
        moved = found.select(F.col("node").alias("old"), F.col("component").alias("new"))
        labels = labels.join(moved, labels["component"] == moved["old"], "left")
        labels = fresh(labels.select("node", F.coalesce("new", "component").alias("component")))
        # Small buckets are done; in the others the hubs are.
        posts, met = live.where(~few).drop("label", "lead"), hubs
    return labels


def _sets(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row's facts, the key of each distinct set that may link, and the sets."""
    rows = id_text(docs, id_col, text_col)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(32, n_bytes // PART_BYTES)
    found = fresh(_candidates(_shared(_entries(rows, n_parts), n_parts)))
    may = found.where("tokens IS NOT NULL")
    groups = fresh(may.groupBy("n", "d1", "d2").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least")))
    sets = fresh(may.join(groups, [may["row"] == groups["rep"]]).select("rep", may["n"], "tokens", "head", "lone", "sketch"))
    return found, groups, sets


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Every row's facts, and the component of each distinct set that may link."""
    found, groups, sets = _sets(docs, id_col, text_col)
    labels = linked_components(sets)
    return found, groups.join(labels, groups["rep"] == labels["node"], "left").withColumn("component", F.coalesce("component", "rep"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    found, named = _classes(docs, id_col, text_col)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("n", "d1", "d2", "component_id")
    out = found.join(named, ["n", "d1", "d2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("tokens").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def linked_pairs(sets: DataFrame) -> DataFrame:
    """(a, b), a < b: every two distinct sets that link.  All pairs of a bucket
    that sizes and sketches allow are verified, once each, so m sets that all
    link cost m * m / 2: components do not need that."""
    posts = fresh(buckets(sets, boundary(sets)))
    x, y = posts.alias("x"), posts.alias("y")
    near = may_link(*[F.col(f"{side}.{c}") for side in "xy" for c in ("n", "lone", "sketch")])
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.rep") < F.col("y.rep")) & near)
    pairs = pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    return _verified(pairs.select("a", "b", F.col("a").alias("la"), F.col("b").alias("lb")), sets).toDF("a", "b")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The linked pairs of distinct sets (a, b), and of every row (row, doc_id,
    n_shingles, rep, n_links): the set it belongs to, named by its first row, and
    how many other rows it links with, copies included; rows as ``surplus_rows``
    has them."""
    found, groups, sets = _sets(docs, id_col, text_col)
    pairs = fresh(linked_pairs(sets))
    copies = found.where("tokens IS NOT NULL").groupBy("n", "d1", "d2").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.join(groups.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"])
    ends = pairs.union(pairs.select("b", "a")).toDF("rep", "other")
    others = ends.join(copies.select(F.col("rep").alias("other"), "copies"), "other").groupBy("rep").agg(F.sum("copies").alias("others"))
    named = copies.join(others, "rep", "left").select("n", "d1", "d2", "rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    member = found.join(named, ["n", "d1", "d2"], "left")
    return pairs, member.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "row").alias("rep"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def surplus_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row): all but one row of each component, the one of least id (null
    last) and place; ``row`` is ``monotonically_increasing_id`` over ``docs``,
    which must be a stable scan."""
    found, named = _classes(docs, id_col, text_col)
    may = found.where("tokens IS NOT NULL").join(named.select("n", "d1", "d2", "component"), ["n", "d1", "d2"])
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = may.groupBy("component").agg(F.min(rank).alias("best"))
    return may.join(best, "component").where(F.col("row") != F.col("best.row")).select("row")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component."""
    name = "__row"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    surplus = surplus_rows(docs, id_col, text_col).toDF(name)
    return docs.select("*", F.monotonically_increasing_id().alias(name)).join(surplus, name, "left_anti").select(*docs.columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
