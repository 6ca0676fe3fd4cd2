"""K-d tree partitioning: shards of near equal bytes by weighted medians of metadata.

Each row is a point: numbers are scaled to 20 bits between the table's least and greatest value,
texts are placed by a hash.  Rows of equal texts are one group and one point: each dimension takes the
group's least value, and the id is no dimension.  A node that has to become n shards is split along its widest dimension
at the key where the rows before hold the share of bytes that the left shards need; a key is the
place in that dimension, then a hash of the text, then one of the id, so equal texts are side by side.
A cut that falls into a group goes to its nearer end where the group holds at most a hundredth of a
shard's bytes, and through it otherwise: so only groups that are large for a shard lie in several.  The weighted median is found by distributed histograms:
each pass sums bytes by 10 more bits of the key, in all nodes of a level at once, until the cut falls
on one row or one such group, or the key is used up.  So each leaf is its share of the bytes but for about
a row, or a hundredth for each cut above it.

All work is in DataFrame functions.  The driver gets a row for each node and pass, no more.
Within a shard rows have slots 0, 1, ...: rows are numbered in hashed buckets of a shard, and the
sizes of the buckets before are added.

Defined results: a null text has 0 bytes (size 1, checksum 0).  A null dimension is at place 0, as is
each where all values are equal.  Repeated rows are rows of their own and may go to different shards.
An empty table gives no rows.  Columns of the results' names are replaced; others pass through
where ``keep`` names them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import stored
from .keysets import copied, dealt, hot_keys

PLACE_BITS = 20          # of a dimension
TIE_BITS = 43            # 24 of the text's hash, 15 of the id's, 4 of the row's number
KEY_BITS = PLACE_BITS + TIE_BITS
TEXT_END = PLACE_BITS + 24  # bits of the key that equal texts share
WHOLE_SHARE = 100        # a group of up to 1 / 100 of a shard's bytes isn't cut
STEP_BITS = 10           # of the key, in each histogram
BUCKET_ROWS = 20_000     # rows of a bucket in which slots are counted
LEAST_BUCKETS = 64       # buckets of a shard at least


@dataclass
class Node:
    """A part of the space that becomes shards first .. first + shards - 1."""

    number: int
    first: int
    shards: int
    dim: int = 0
    cut: int | None = None          # rows with a smaller key go left
    left: "Node | None" = None
    right: "Node | None" = None
    target: float = 0.0
    whole: float = 0.0              # bytes of a group that isn't cut
    prefix: int = 0                 # of the key that the cut has, so far
    bits: int = 0
    before: int = 0                 # bytes of smaller prefixes


@dataclass
class Tree:
    root: Node
    size: int = 1
    leaves: list[Node] = field(default_factory=list)

    def child(self, first: int, shards: int) -> Node:
        self.size += 1
        return Node(self.size - 1, first, shards)


def hash_bits(text: Column, bits: int) -> Column:
    """The first bits of a text's MD5 as a number."""
    digits = -(-bits // 4)
    value = F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")
    return F.shiftright(value, digits * 4 - bits)


def place_of_text(column: Column) -> Column:
    return hash_bits(column.cast("string"), PLACE_BITS)


def _key(dim: int) -> Column:
    return F.shiftleft(F.col(f"k{dim}"), TIE_BITS).bitwiseOR(F.col("tie"))


def _node_of(node: Node) -> Column:
    """The number of the leaf of the tree so far that a row is in."""
    if node.cut is None:
        return F.lit(node.number)
    return F.when(_key(node.dim) < F.lit(node.cut), _node_of(node.left)).otherwise(_node_of(node.right))


def _grouped(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Narrow rows with each dimension ``__d_<name>`` at the least value in the row's ``__group``."""
    least = [F.min(f"__d_{c}").alias(f"__m_{c}") for c in dims]
    several = stored(rows.groupBy("__group").agg(F.count("*").alias("n"), *least).where("n > 1"), "groups")
    hot = hot_keys(several, ["__group"], "n")
    found = (dealt(rows, ["__group"], hot, ["__row"])
             .join(copied(several.withColumn("__found", F.lit(True)), ["__group"], hot), ["__group", "__salt"], "left"))
    return found.withColumns({f"__d_{c}": F.when(F.col("__found"), F.col(f"__m_{c}")).otherwise(F.col(f"__d_{c}")) for c in dims})


def points(docs: DataFrame, numbers: list[str], texts: list[str], id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """The narrow table of sizes, checksums, places and ties, stored once for all passes; texts aren't shuffled."""
    text, key = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("string")
    tie = (F.shiftleft(hash_bits(text, 24), 19)
           .bitwiseOR(F.shiftleft(hash_bits(F.coalesce(key, F.lit("")), 15), 4))
           .bitwiseOR(F.monotonically_increasing_id().bitwiseAND(15)))
    narrow = docs.select(*keep, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                         tie.alias("tie"), F.xxhash64(text).alias("__group"), F.monotonically_increasing_id().alias("__row"),
                         *[F.col(c).cast("double").alias(f"__d_{c}") for c in numbers], *[F.col(c).cast("string").alias(f"__d_{c}") for c in texts])
    rows = _grouped(stored(narrow, "narrow"), [*numbers, *texts])
    ends = rows.agg(*[f(f"__d_{c}").alias(f"{n}{i}") for i, c in enumerate(numbers)
                      for n, f in (("lo", F.min), ("hi", F.max))]).first() if numbers else None
    places = []
    for i, c in enumerate(numbers):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or hi == lo:
            places.append(F.lit(0).cast("long"))
        else:
            scaled = F.floor((F.col(f"__d_{c}") - F.lit(lo)) * F.lit(float((1 << PLACE_BITS) - 1)) / F.lit(hi - lo))
            places.append(F.coalesce(scaled.cast("long"), F.lit(0).cast("long")))
    places += [F.coalesce(place_of_text(F.col(f"__d_{c}")), F.lit(0).cast("long")) for c in texts]
    return stored(rows.select(*keep, "size", "text_crc32", "tie", *[p.alias(f"k{i}") for i, p in enumerate(places)]), "points")


def _open(rows: DataFrame, tree: Tree, nodes: list[Node], dims: int) -> None:
    """Bytes and extents of the nodes: each gets its dimension and its target."""
    figures = rows.withColumn("node", _node_of(tree.root)).groupBy("node").agg(
        F.sum("size").alias("w"), *[F.max(f"k{d}").alias(f"hi{d}") for d in range(dims)],
        *[F.min(f"k{d}").alias(f"lo{d}") for d in range(dims)]).collect()
    of = {r.node: r for r in figures}
    for n in nodes:
        r = of.get(n.number)
        if r is None:
            n.cut = 0  # an empty node: all its shards are empty
        else:
            n.dim = max(range(dims), key=lambda d: (r[f"hi{d}"] - r[f"lo{d}"], -d))
            n.target, n.whole = r.w * (n.shards // 2) / n.shards, r.w / n.shards / WHOLE_SHARE


def _refine(rows: DataFrame, tree: Tree, nodes: list[Node]) -> None:
    """One histogram for all nodes: the bin where the bytes so far reach the target."""
    step = {n.number: min(STEP_BITS, (TEXT_END if n.bits < TEXT_END else KEY_BITS) - n.bits) for n in nodes}
    inside, number, target, before = F.lit(None).cast("long"), F.lit(0), F.lit(0.0), F.lit(0)
    for n in nodes:
        here, key = F.col("node") == n.number, _key(n.dim)
        fits = here & (F.shiftright(key, KEY_BITS - n.bits) == F.lit(n.prefix)) if n.bits else here
        inside = F.when(fits, F.shiftright(key, KEY_BITS - n.bits - step[n.number]).bitwiseAND((1 << step[n.number]) - 1)).otherwise(inside)
        target = F.when(here, F.lit(float(n.target - n.before))).otherwise(target)
    bins = (rows.withColumn("node", _node_of(tree.root)).withColumn("bin", inside).where("bin is not null")
            .groupBy("node", "bin").agg(F.sum("size").alias("w"), F.count("*").alias("n")))
    order = Window.partitionBy("node").orderBy("bin")
    so_far = bins.withColumn("sum", F.sum("w").over(order)).withColumn("target", target)
    reached = (so_far.where(F.col("sum") >= F.col("target")).groupBy("node")
               .agg(F.min_by(F.struct("bin", "w", "n", "sum"), "bin").alias("x")).collect())
    of = {r.node: r.x for r in reached}
    for n in nodes:
        x, width = of[n.number], step[n.number]
        under = n.before + x["sum"] - x.w
        n.prefix, n.bits, n.before = (n.prefix << width) | x.bin, n.bits + width, under
        if x.n == 1 or n.bits == KEY_BITS or n.bits == TEXT_END and x.w <= n.whole:
            # The row, a group, or rows of one key, go to the side that comes nearer to the target.
            upper = abs(under + x.w - n.target) < abs(under - n.target)
            n.cut = (n.prefix + upper) << (KEY_BITS - n.bits)


def grow(rows: DataFrame, shards: int, dims: int) -> Tree:
    """Split level by level until each leaf is one shard."""
    tree = Tree(Node(0, 0, shards))
    level = [tree.root]
    while level:
        tree.leaves += [n for n in level if n.shards == 1]
        nodes = [n for n in level if n.shards > 1]
        for n in nodes:
            half = n.shards // 2
            n.left, n.right = tree.child(n.first, half), tree.child(n.first + half, n.shards - half)
        if nodes:
            _open(rows, tree, nodes, dims)
        waiting = [n for n in nodes if n.cut is None]
        while waiting:
            _refine(rows, tree, waiting)
            waiting = [n for n in waiting if n.cut is None]
        level = [c for n in nodes for c in (n.left, n.right)]
    return tree


def shard(docs: DataFrame, shards: int = 16, numbers: tuple[str, ...] = ("n_chars",),
          texts: tuple[str, ...] = ("source", "lang"), id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows with the columns ``keep``, size, text_crc32, shard and slot."""
    keep = [c for c in keep if c not in ("size", "text_crc32", "shard", "slot")]
    rows = points(docs, list(numbers), list(texts), id_col, text_col, keep)
    tree = grow(rows, shards, len(numbers) + len(texts))
    node = _node_of(tree.root)
    which = F.create_map(*[x for n in tree.leaves for x in (F.lit(n.number), F.lit(n.first))])
    buckets = max(LEAST_BUCKETS, rows.count() // (shards * BUCKET_ROWS))
    placed = rows.withColumn("shard", which[node]).withColumn("bucket", F.pmod(F.shiftright("tie", 4), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("tie", *keep))
    return (placed.withColumn("within", within).join(starts, ["shard", "bucket"])
            .select(*keep, "size", "text_crc32", "shard", (F.col("start") + F.col("within") - 1).alias("slot")))
