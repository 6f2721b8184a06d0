"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is heavy when it holds more rows than 1/PARTS of a mean shuffle partition; its rows are dealt to as many sub-keys as it has such shares.
PARTS = 4
# Keys a sketch of heavy ones tracks for each that it may report, and the most that Spark lets it track.
TRACKED, MOST_TRACKED = 16, 1_000_000


def shares(rows: DataFrame) -> int:
    """Rows are seen in so many shares; fewer keys than that can be heavy, whatever the data."""
    return min(PARTS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_TRACKED // TRACKED)


def _null_safe(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(and_, [left.eqNullSafe(right) for left, right in pairs])


class HeavyKeys:
    """The heavy keys of several key columns, from one pass over a frame that reads nothing else.

    ``keys``: column names, or tuples of them for composite keys. Every key gets a frequent-items sketch of bounded size, whose
    error is a small part of the share that makes a key heavy; counts steer only how rows are dealt, never what comes out. One row reaches the driver.
    """

    def __init__(self, rows: DataFrame, *keys: str | Sequence[str]) -> None:
        self.shares, self.spark = shares(rows), rows.sparkSession
        named = [(k,) if isinstance(k, str) else tuple(k) for k in keys]
        hashes = [F.when(_present(k), F.xxhash64(*k)).alias(f"h{i}") for i, k in enumerate(named)]
        sketches = [F.expr(f"approx_top_k(h{i}, {self.shares}, {TRACKED * self.shares}) filter (where h{i} is not null)").alias(f"top{i}") for i in range(len(named))]
        row = rows.select(*hashes).agg(F.count(F.lit(1)).alias("n"), *sketches, *[F.count(f"h{i}").alias(f"filled{i}") for i in range(len(named))]).first()
        self.total = row["n"]
        self.heavy = {k: [(t["item"], self._pieces(t["count"])) for t in (row[f"top{i}"] or []) if self._pieces(t["count"]) > 1] for i, k in enumerate(named)}
        self.blank = {k: self._pieces(self.total - row[f"filled{i}"]) for i, k in enumerate(named)}

    def _pieces(self, count: int) -> int:
        return -(-count * self.shares // self.total) if self.total else 0

    def frame(self, keys: Sequence[str]) -> DataFrame:
        """__hash, __pieces of the heavy keys: fewer rows than there are shares."""
        return self.spark.createDataFrame(self.heavy[tuple(keys)], "__hash bigint, __pieces int")


def _present(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def attach_group(rows: DataFrame, groups: DataFrame, keys: Sequence[str], weight: str,
                 row_id: Sequence[str] = ()) -> DataFrame:
    """Give every row the values of its group (``groups`` has one row per key, NULL keys included).

    Same result as window functions over the keys, but no task receives a whole heavy group: its rows are dealt to
    sub-keys, as many as the group is heavy, and its one group row is repeated for each of them.
    ``weight`` is the group's row count. There are fewer heavy keys than shares, whatever the data, which is why their
    list alone is broadcast. ``row_id``: columns that tell the rows of a group apart; heavy
    rows are spread by their hash (by the whole row if not given). Rows get the same sub-key every time
    they are computed, so a repeated task sends them where the first attempt did.
    """
    parts, total = shares(rows), groups.agg(F.sum(weight)).scalar()
    values = [c for c in groups.columns if c not in keys]
    count = range(len(keys))
    table = groups.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(v).alias(f"__v{i}") for i, v in enumerate(values)],
        F.ceil(F.col(weight).cast("double") * parts / total).cast("int").alias("__pieces"),
    )
    heavy = table.where("__pieces > 1").select(*[F.col(f"__k{i}").alias(f"__h{i}") for i in count], F.col("__pieces").alias("__spread"))
    slot = F.when(F.col("__spread").isNotNull(), F.pmod(F.xxhash64(*(row_id or rows.columns)), F.col("__spread"))).otherwise(F.lit(0))
    marked = rows.join(
        F.broadcast(heavy), _null_safe([(F.col(k), F.col(f"__h{i}")) for i, k in enumerate(keys)]), "left"
    ).select(*rows.columns, slot.cast("int").alias("__slot"))
    spread = table.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.greatest(F.col("__pieces"), F.lit(1)) - 1)))
    same = _null_safe([(F.col(k), F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return marked.join(spread, same & (F.col("__slot") == F.col("__copy")), "left").select(
        *rows.columns, *[F.col(f"__v{i}").alias(v) for i, v in enumerate(values)]
    )


def with_slots(rows: DataFrame, keys: Sequence[str], heavy: HeavyKeys, row_id: Sequence[str] = ()) -> DataFrame:
    """``__slot``: the sub-key of each row, 0 unless its key is heavy or rows without a key are."""
    spread = F.xxhash64(*(row_id or rows.columns))
    slot = F.when(~_present(keys), F.pmod(spread, F.lit(max(1, heavy.blank[tuple(keys)])))).otherwise(F.lit(0))
    if not heavy.heavy[tuple(keys)]:
        return rows.withColumn("__slot", slot.cast("int"))
    marked = rows.withColumn("__h", F.xxhash64(*keys)).join(F.broadcast(heavy.frame(keys)), F.col("__h") == F.col("__hash"), "left")
    slot = F.when(F.col("__pieces").isNotNull() & _present(keys), F.pmod(spread, F.col("__pieces"))).otherwise(slot)
    return marked.select(*rows.columns, slot.cast("int").alias("__slot"))


def lookup(rows: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], take: dict[str, str], how: str = "left",
           row_id: Sequence[str] = (), small: bool = False, heavy: HeavyKeys | None = None) -> DataFrame:
    """Join to a parent with a unique key, adding ``take`` = {parent column: new name}.

    Rows of a heavy key are dealt to as many sub-keys as it is heavy, for each of which the parent row is repeated; rows
    without a key match nothing and are dealt the same way. Where no key is heavy this is a plain join. ``heavy``: what :class:`HeavyKeys`
    found for the keys, so that several lookups of a frame share one pass. ``small``: the parent is a short list by nature
    (half-years), so no key needs spreading. Keys whose types differ on both sides are joined as they are.
    """
    keys = [c for c, _ in on]
    right = parent.select(
        *[F.col(p).alias(f"__p{i}") for i, (_, p) in enumerate(on)],
        *[F.col(c).alias(f"__t{i}") for i, c in enumerate(take)],
    )
    names = [F.col(f"__t{i}").alias(n) for i, n in enumerate(take.values())]
    same = reduce(and_, [F.col(c) == F.col(f"__p{i}") for i, (c, _) in enumerate(on)])
    alike = all(rows.schema[c].dataType == parent.schema[p].dataType for c, p in on)
    if small or not alike:
        return rows.join(right, same, how).select(*rows.columns, *names)
    heavy = heavy or HeavyKeys(rows, keys)
    if not heavy.heavy[tuple(keys)] and heavy.blank[tuple(keys)] <= 1:
        return rows.join(right, same, how).select(*rows.columns, *names)
    copy = F.lit(0).alias("__copy")
    if heavy.heavy[tuple(keys)]:
        parent_hash = F.xxhash64(*[f"__p{i}" for i in range(len(on))])
        right = right.join(F.broadcast(heavy.frame(keys)), parent_hash == F.col("__hash"), "left")
        copy = F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1)).alias("__copy")
    right = right.select(*[c for c in right.columns if c not in ("__hash", "__pieces")], copy)
    left = with_slots(rows, keys, heavy, row_id)
    return left.join(right, same & (F.col("__slot") == F.col("__copy")), how).select(*rows.columns, *names)


def mark_exists(rows: DataFrame, key: str, others: DataFrame, other_key: str, name: str, row_id: Sequence[str] = (),
                heavy: HeavyKeys | None = None) -> DataFrame:
    """Boolean column: does the row's key occur among ``others``? Keeps every row once; rows of heavy keys and those without a key are dealt out as in :func:`lookup`."""
    keys = others.select(other_key).where(F.col(other_key).isNotNull()).distinct().withColumn("__there", F.lit(True))
    return lookup(rows, keys, [(key, other_key)], {"__there": name}, row_id=row_id, heavy=heavy).withColumn(name, F.col(name).isNotNull())


def missing_children(parents: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Parents no child refers to."""
    used = children.select(F.col(child_key).alias(key)).distinct()
    return parents.join(used, key, "left_anti")


def condense(rows: DataFrame, columns: Sequence[str], weight: str = "n") -> DataFrame:
    """Equal rows of a projection folded into one with a count, before they are shuffled into a join."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(weight))


def weighted_if(condition: Column, weight: str = "n") -> Column:
    """count_if over condensed rows."""
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")
