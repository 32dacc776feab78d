"""Sharding by a k-d tree: split the rows at weighted medians of their widest dimension until each leaf has its share.

Only DataFrame operations. A pass over the texts leaves one narrow row a document (id, size, checksum, one number a
dimension), written once to the shared folder; everything after that reads those rows only. A cut is found by
counting: the bracket around the median is cut into ``FAN`` parts, bytes are summed by part (combined map-side, so a
hot value costs one row a task), and the bracket narrows to the part that holds the median. What comes to the driver
is bounded by shards x parts and does not depend on the rows. All parts of one level are cut by the same jobs.

Each dimension is turned into one 62-bit position: 30 bits of its value, then 32 bits that tell rows of one value apart. So a
value that fills a third of the table (a hot source) can be cut inside. Rows of equal text are a group: they take the least
value of each dimension among them, and share the text's checksum as their last bits, so all have one position
and no cut parts them. Only a group of more than the share ``whole`` of all bytes keeps 16 bits of the checksum and takes 16
bits of a hash of the id: near equal shards need a cut inside it.

Defined results: a null text has no bytes and size 1; null dimension values come first, but a group takes its least value that
is not null; a null id is a value like any other; rows of equal id and text stay together; repeated rows are each placed;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelwise.session import reliable

VALUE_BITS, TIE_BITS = 30, 32
FAN = 1024
SLOT_BLOCK = 20_000
#: Equal rows are numbered in runs of so many.
RUN = 1_000


@dataclass
class Node:
    """A part of the table that gives ``leaves`` shards, the first of them ``shard``; cut along an axis once it is known how."""

    shard: int
    leaves: int
    axis: int = 0
    cut: int | None = None
    left: Node | None = None
    right: Node | None = None

    def parts(self) -> list[Node]:
        return [self] if self.cut is None else self.left.parts() + self.right.parts()

    def per_row(self, value: Callable[[Node], Column]) -> Column:
        """The value of the part that a row lies in: one comparison a level, one expression for the whole tree."""
        if self.cut is None:
            return value(self)
        return F.when(F.col(f"d{self.axis}") < self.cut, self.left.per_row(value)).otherwise(self.right.per_row(value))


def _position(value: Column, low: Column, high: Column, tie: Column) -> Column:
    """The 62-bit place of a value between the table's least and greatest."""
    span = F.greatest(high - low, F.lit(1.0))
    scaled = F.floor(F.coalesce((value - low) / span, F.lit(0.0)) * float((1 << VALUE_BITS) - 1)).cast("long")
    return F.shiftleft(scaled, TIE_BITS) + tie


def text_number(name: str | Column) -> Column:
    """A place for each distinct string, from a hash of the whole of it; null stays null."""
    name = F.col(name) if isinstance(name, str) else name
    return F.when(name.isNotNull(), F.shiftrightunsigned(F.xxhash64(name), 16).cast("double"))


def narrow_rows(docs: DataFrame, dimensions: dict[str, Column], id_col: str = "doc_id", text_col: str = "text", whole: float = 1 / 256) -> DataFrame:
    """(doc_id, size, text_crc32, d0, d1, ...), written once. A dimension that is constant has width 0 and is never cut.

    ``whole``: groups of equal texts up to this share of all bytes are kept whole.
    """
    n_dims = len(dimensions)
    text = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    rows = reliable(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"), *[v.cast("double").alias(f"v{i}") for i, v in enumerate(dimensions.values())],
    ))
    same = ["text_key", "text_crc32", "size"]
    groups = rows.groupBy(*same).agg(F.count("*").alias("copies"), *[F.min(f"v{i}").alias(f"g{i}") for i in range(n_dims)]).where("copies > 1")
    groups = reliable(groups)  # a plain table on the join's side lets Spark split a hot group of the rows
    ends = rows.agg(F.sum("size").alias("bytes"), *[f(f"v{i}").alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)]).first()
    by_text = F.col("text_crc32")
    by_id = by_text.bitwiseAND(0xFFFF0000) + F.xxhash64("doc_id").bitwiseAND(0xFFFF)
    tie = F.when(F.col("copies") * F.col("size") > F.lit(whole * (ends["bytes"] or 0)), by_id).otherwise(by_text)
    ends = [(float(ends[f"min{i}"] or 0), float(ends[f"max{i}"] or 0)) for i in range(n_dims)]
    places = [_position(F.coalesce(f"g{i}", f"v{i}"), F.lit(a), F.lit(b), tie).alias(f"d{i}") for i, (a, b) in enumerate(ends)]
    return reliable(rows.join(groups, same, "left").select("doc_id", "size", "text_crc32", *places))


def _cut_level(rows: DataFrame, tree: Node, n_dims: int, tolerance: float) -> bool:
    """Cut every part that still has several shards to give; False if there was none, or no rows."""
    parts = {n.shard: n for n in tree.parts() if n.leaves > 1}
    if not parts:
        return False
    extent = [f(f"d{i}").alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)]
    found = rows.groupBy(tree.per_row(lambda n: F.lit(n.shard)).alias("node")).agg(F.sum("size").alias("bytes"), *extent).collect()
    low, high, want, below, total = {}, {}, {}, {}, {}
    for r in (r for r in found if r["node"] in parts):
        k, node = r["node"], parts[r["node"]]
        node.axis = max(range(n_dims), key=lambda i: (r[f"max{i}"] - r[f"min{i}"], -i))
        low[k], high[k], total[k], below[k] = r[f"min{node.axis}"], r[f"max{node.axis}"] + 1, r["bytes"], 0
        want[k] = r["bytes"] * (node.leaves // 2) / node.leaves
    cuts: dict[int, int] = {}
    while left := [k for k in low if k not in cuts]:
        width = {k: max(1, -(-(high[k] - low[k]) // FAN)) for k in left}

        def part(n: Node) -> Column:
            if n.shard not in width:
                return F.lit(None).cast("long")
            place = F.col(f"d{n.axis}")
            inside = (place >= low[n.shard]) & (place < high[n.shard])
            return F.when(inside, F.expr(f"(d{n.axis} - {low[n.shard]}) div {width[n.shard]}") + n.shard * FAN)

        sums = rows.select("size", tree.per_row(part).alias("part")).where("part IS NOT NULL").groupBy("part").agg(F.sum("size")).collect()
        for k in left:
            at = below[k]
            for number, size in sorted((r[0] - k * FAN, r[1]) for r in sums if r[0] // FAN == k):
                if at + size >= want[k]:
                    break
                at += size
            start = low[k] + number * width[k]
            stop = min(high[k], start + width[k])
            if width[k] == 1 or size <= tolerance * total[k] / parts[k].leaves:
                cuts[k] = start if want[k] - at < at + size - want[k] and at > 0 else stop
            else:
                low[k], high[k], below[k] = start, stop, at
    for k, cut in cuts.items():
        n = parts[k]
        half = n.leaves // 2
        n.cut, n.left, n.right = cut, Node(k, half), Node(k + half, n.leaves - half)
    return bool(cuts)


def kd_shards(rows: DataFrame, shards: int, tolerance: float = 1e-3) -> DataFrame:
    """Add ``shard`` 0 .. shards - 1 to ``narrow_rows``, bytes near equal.

    A part of k shards is cut where floor(k / 2) / k of its bytes lie below, along the dimension that is widest in it,
    until every part is one shard. ``tolerance``: how far a cut may miss, as a share of one shard's bytes.
    """
    n_dims = sum(c.startswith("d") and c[1:].isdigit() for c in rows.columns)
    tree = Node(0, shards)
    while _cut_level(rows, tree, n_dims, tolerance):
        pass
    return rows.withColumn("shard", tree.per_row(lambda n: F.lit(n.shard)))


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """How many shards bring the leaves to ``target_bytes``."""
    return max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))


def with_slots(rows: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): ``slot`` is 0, 1, 2, ... within each shard, without ordering a shard in one task.

    Equal rows are counted first and numbered in runs, so a row that is repeated without bound spreads as well. Runs are dealt to
    blocks by a hash; blocks are numbered by their counts, runs within their block.
    """
    blocks = max(1, -(-rows.count() // SLOT_BLOCK))
    runs = rows.groupBy("shard", "doc_id", "text_crc32", "size").agg(F.count("*").alias("copies"))
    runs = runs.withColumn("run", F.explode(F.expr(f"sequence(0, (copies - 1) div {RUN})")))
    runs = runs.withColumn("n", F.least(F.lit(RUN).cast("long"), F.col("copies") - F.col("run") * RUN))
    runs = runs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", "run"), F.lit(blocks)).cast("int"))
    counts = runs.groupBy("shard", "block").agg(F.sum("n").alias("count"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size", "run").rowsBetween(Window.unboundedPreceding, -1)
    numbered = runs.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(counts, ["shard", "block"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", F.explode(F.expr("sequence(before + place, before + place + n - 1)")).alias("slot"))
