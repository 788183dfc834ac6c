"""A Merkle manifest of a table: a digest of every row, of every group and of all, and proofs.

Trees of digests are computed by supersteps.  Every node sends its digest to its parent; a
parent with all its children hashes them and sends on, until each group has one node, and
then the groups' nodes do the same up to the root.  In reverse, every node sends its children
the siblings on the way to the root, so that each row can be verified by itself.  Nodes of a
block of some levels lie together, so that only messages between blocks are shuffled.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Iterable, Iterator, Mapping, Sequence
from hashlib import sha256

from pyspark import RDD
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

#: Children of a node at most.
ARITY = 3
#: Levels of a block; a block has ARITY to this power nodes on its lowest level at most.
LEVELS = 5
#: Nodes of a partition, on average.
NODES = 20_000
#: A node's number in its tree is below this; tree and number make one key.
PLACES = 1 << 44
SIZE = 32


def field(value: Column) -> Column:
    """A value in a form that no other value has: its bytes behind their number, ``-`` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def numbered(rows: DataFrame, group: str | None, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``place`` and ``n``: the number of a row in its group by ``order``, nulls first, and the group's rows.

    Rows are dealt in ranges and counted in each, so a group may hold any share of all rows.
    """
    group_of = [group] if group else []
    ranged = written(rows.repartitionByRange(*group_of, *order).withColumn("part", F.spark_partition_id()), name)
    counts = ranged.groupBy(*group_of, "part").agg(F.count("*").alias("own"))
    earlier = Window.partitionBy(*group_of).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    counts = counts.select(*[F.col(g).alias("of") for g in group_of], F.col("part").alias("in"), F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"), F.sum("own").over(Window.partitionBy(*group_of)).alias("n"))
    inside = F.row_number().over(Window.partitionBy(*group_of, "part").orderBy(*order))
    same = ranged["part"] == counts["in"]
    if group:
        same = same & ranged[group].eqNullSafe(counts["of"])
    joined = ranged.withColumn("inside", inside).join(counts, same)
    return joined.select(*rows.columns, (F.col("base") + F.col("inside") - 1).alias("place"), "n")


def height(n: int) -> int:
    """Supersteps until one node is left of ``n``."""
    steps = 0
    while n > 1:
        n, steps = -(-n // ARITY), steps + 1
    return steps


def hashed(digests: Iterable[bytes]) -> bytes:
    """Digest of digests, which count as hexadecimal text."""
    return sha256(hexlify(b"".join(digests))).digest()


def siblings(place: int, digests: Sequence[bytes]) -> bytes:
    """One step of a proof: the node's place, how many siblings it has, and their digests."""
    return bytes((place, len(digests) - 1)) + b"".join(d for i, d in enumerate(digests) if i != place)


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        place, count = path[at], path[at + 1]
        at += 2
        yield place, [path[at + k * SIZE : at + (k + 1) * SIZE] for k in range(count)]
        at += count * SIZE


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest and its proof lead to."""
    for place, others in steps(path):
        digest = hashed([*others[:place], digest, *others[place:]])
    return digest


def within(digests: Sequence[bytes], levels: int) -> list[Sequence[bytes]]:
    """The levels of a block: every completed parent hashes its children."""
    out = [digests]
    for _ in range(levels):
        out.append([hashed(out[-1][i : i + ARITY]) for i in range(0, len(out[-1]), ARITY)])
    return out


def way(levels: list[Sequence[bytes]], place: int) -> bytes:
    """The steps of a proof from a node of a block's lowest level to its top."""
    out = b""
    for level in levels[:-1]:
        first = place - place % ARITY
        out += siblings(place % ARITY, level[first : first + ARITY])
        place //= ARITY
    return out


def climb(leaves: RDD, total: int, most: int) -> tuple[list[RDD], list[RDD]]:
    """Supersteps upward from (key, (n, digest, payload)): blocks by their top's key, and finished trees, by superstep.

    ``n`` counts the nodes of the tree's level; a tree with one node sends nothing more.
    """
    blocks, done, level = [], [], leaves
    for k in range(-(-height(most) // LEVELS) + 1):
        done.append(level.filter(lambda r: r[1][0] == 1))
        if k == -(-height(most) // LEVELS):
            break
        sent = level.filter(lambda r: r[1][0] > 1).map(_to_block)
        block = sent.groupByKey(max(1, -(-total // (NODES * ARITY ** (k * LEVELS))))).mapValues(_completed)
        blocks.append(block)
        level = block.mapValues(lambda b: (-(-b[0] // ARITY**LEVELS), b[1][-1][0], None))
    return blocks, done


def _to_block(node):
    key, (n, digest, payload) = node
    tree, place = divmod(key, PLACES)
    return tree * PLACES + place // ARITY**LEVELS, (place % ARITY**LEVELS, n, digest, payload)


def _completed(children):
    """(n, levels of the block, payloads) once all children of a block are there."""
    some = sorted(children, key=lambda c: c[0])
    n = some[0][1]
    return n, within([c[2] for c in some], min(LEVELS, height(n))), [c[3] for c in some]


def _to_children(node):
    """From (key, (block, (head, path))): the way on from each node of the block's lowest level."""
    key, ((_, levels, _), (head, path)) = node
    tree, place = divmod(key, PLACES)
    for i in range(len(levels[0])):
        yield tree * PLACES + place * ARITY**LEVELS + i, (head, way(levels, i) + path)


def descend(blocks: list[RDD], starts: list[RDD]) -> RDD:
    """Supersteps downward: (key, (block, (head, path))) for every block of leaves.

    ``starts`` has (key, (head, path)) of the trees that have one node left at that superstep.
    """
    ways = starts[len(blocks)]
    for k in range(len(blocks) - 1, -1, -1):
        reached = blocks[k].join(ways, blocks[k].getNumPartitions())
        if k == 0:
            return reached
        ways = reached.flatMap(_to_children).union(starts[k])
    raise ValueError("no supersteps")


#: Columns of the result behind the key.
PROVEN = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proven(key, leaf: bytes, seen: bytes | None, head: bytes, path: bytes, paths: bool):
    subroot, root = head[:SIZE], head[SIZE:]
    others = b"".join(d for _, some in steps(path) for d in some)
    found = folded(leaf if seen is None else seen, path)
    row = (key, leaf.hex(), subroot.hex(), root.hex(), sha256(hexlify(others)).hexdigest(), found.hex(), found == root)
    return (*row, bytes(path)) if paths else row


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id", group: str = "source", changed: Mapping[str, Column] | None = None, paths: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row of ``docs``.

    ``leaf`` is the digest of the row's fields, ``subroot`` of its group, ``root`` of all.
    ``folded_root`` is what the original siblings and the row with ``changed`` columns in the
    place of its own lead to; a row is verified if that is the root.  ``paths`` adds ``path``: for each
    level a byte for the place, one for the number of siblings, and their digests.

    A null key or group stands first and is a group of its own; rows of equal key stand by
    their digest, so for wholly equal rows it is open which has which proof.  Texts of any
    length are hashed whole; empty ones differ from nulls.  An empty table gives no rows, other
    columns are left out.  Groups of any size are dealt in ranges, their number is not bounded.
    """
    own = [F.col(f"`{c}`") for c in fields]
    other = [(changed or {}).get(c, F.col(f"`{c}`")) for c in fields]
    kind = docs.schema[key].dataType.simpleString()
    seen = F.unhex(row_digest(other)) if changed else F.lit(None).cast("binary")
    leaves = docs.select(F.col(f"`{group}`").cast("string").alias("group"), F.col(f"`{key}`").alias("key"), F.unhex(row_digest(own)).alias("leaf"), seen.alias("seen"))
    leaves = written(numbered(leaves, "group", ["key", "leaf"], "leaves"), "places")
    groups = numbered(leaves.groupBy("group").agg(F.count("*").alias("size")), None, ["group"], "groups")
    groups = written(groups.select(F.col("group").alias("of"), "size", F.col("place").alias("tree")), "trees")
    whole = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0)), F.count("*")).first()
    total, most, trees = map(int, whole)
    schema = f"`{key}` {kind}, {PROVEN}" + (", path binary" if paths else "")
    spark = docs.sparkSession
    if not total:
        return spark.createDataFrame([], schema)
    rows = leaves.join(groups, leaves["group"].eqNullSafe(groups["of"])).select("tree", "place", "n", "leaf", "seen", "key")
    nodes = rows.rdd.map(lambda r: (r[0] * PLACES + r[1], (r[2], bytes(r[3]), (None if r[4] is None else bytes(r[4]), r[5]))))
    upper, done = climb(nodes, total, most)
    # the groups' nodes are the leaves of one more tree; each carries the superstep that completed it
    tops = spark.sparkContext.union([d.map(lambda r, k=k: (r[0] // PLACES, (trees, r[1][1], k))) for k, d in enumerate(done)]).coalesce(max(1, -(-trees // NODES)))
    if trees == 1:
        heads = tops.map(lambda r: (0, (r[1][2], r[1][1] + r[1][1], b"")))
    else:
        over, last = climb(tops, trees, trees)
        root = last[-1].map(lambda r: (r[0], (r[1][1], b"")))
        starts = [spark.sparkContext.emptyRDD()] * len(over) + [root]

        def heads_of(node):
            """(tree, (superstep, subroot + root, path)) of the groups in one block."""
            key, ((_, levels, ended), (top, path)) = node
            for i, (digest, at) in enumerate(zip(levels[0], ended)):
                yield key % PLACES * ARITY**LEVELS + i, (at, digest + top, way(levels, i) + path)

        heads = descend(over, starts).flatMap(heads_of)
    at_level = [heads.filter(lambda r, k=k: r[1][0] == k).map(lambda r: (r[0] * PLACES, (r[1][1], r[1][2]))) for k in range(len(upper) + 1)]
    lone = done[0].join(at_level[0], max(1, -(-trees // NODES))).map(lambda r: _proven(r[1][0][2][1], r[1][0][1], r[1][0][2][0], *r[1][1], paths))

    def leaves_of(node):
        _, ((_, levels, payloads), (head, path)) = node
        for i, (digest, (seen, name)) in enumerate(zip(levels[0], payloads)):
            yield _proven(name, digest, seen, head, way(levels, i) + path, paths)

    found = descend(upper, at_level).flatMap(leaves_of).union(lone) if upper else lone
    return spark.createDataFrame(found, schema, verifySchema=False)


def without_newlines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Column:
    """The text, without its newlines where the checksum of the key in decimal is even."""
    even = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


#: DuckDB: the same trees, walked level by level; the checksum is computed bit by bit.
ORACLE = r"""
WITH RECURSIVE c AS (SELECT *, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b)] || range(8), lambda e, s: xor(e >> 1, CASE WHEN e % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))) AS crc FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, source,
    concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
    text, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM c),
l AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS seen FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM l),
up AS (SELECT t, 0 AS k, i, n, leaf AS h FROM p UNION ALL SELECT t, any_value(k) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY t, i // 3),
sub AS (SELECT t, h, k FROM up WHERE n = 1),
top AS (SELECT 0 AS k, t AS i, (SELECT count(*) FROM sub) AS n, h FROM sub UNION ALL SELECT any_value(k) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY i // 3),
kids AS (SELECT t, k, i // 3 AS j, list(h ORDER BY i) AS hs FROM up WHERE n > 1 GROUP BY t, k, i // 3 UNION ALL SELECT -1, k, i // 3, list(h ORDER BY i) FROM top WHERE n > 1 GROUP BY k, i // 3),
w AS (SELECT r, t, 0 AS k, i, n, seen AS cur, '' AS proof FROM p
  UNION ALL SELECT w.r, w.t, w.k + 1, w.i // 3, (w.n + 2) // 3, sha256(array_to_string(list_transform(hs, lambda x, a: CASE WHEN a = w.i % 3 + 1 THEN w.cur ELSE x END), '')),
    w.proof || array_to_string(list_filter(hs, lambda x, a: a <> w.i % 3 + 1), '') FROM w JOIN kids ON kids.t = w.t AND kids.k = w.k AND kids.j = w.i // 3 WHERE w.n > 1),
v AS (SELECT r, 0 AS k, t AS i, (SELECT count(*) FROM sub) AS n, cur, proof FROM w WHERE n = 1
  UNION ALL SELECT v.r, v.k + 1, v.i // 3, (v.n + 2) // 3, sha256(array_to_string(list_transform(hs, lambda x, a: CASE WHEN a = v.i % 3 + 1 THEN v.cur ELSE x END), '')),
    v.proof || array_to_string(list_filter(hs, lambda x, a: a <> v.i % 3 + 1), '') FROM v JOIN kids ON kids.t = -1 AND kids.k = v.k AND kids.j = v.i // 3 WHERE v.n > 1)
SELECT p.doc_id, p.leaf, sub.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(v.proof) AS proof_sha256, v.cur AS folded_root, v.cur = (SELECT h FROM top WHERE n = 1) AS verified
FROM p JOIN sub USING (t) JOIN v ON v.r = p.r AND v.n = 1
"""
