"""Which copy of an id counts, over everything taken in so far.

The index is a log of runs. A run holds the copies that were the earliest of their id when
it was taken in, in buckets by the id's hash, and a Bloom filter for each bucket. Taking in
rows asks the filters which buckets of which runs may hold their ids and reads only those:
what is read and written follows the new rows and the copies they meet, not the history.
Runs are merged by eights, so their number grows with the logarithm of what was taken in.

    copies/run=<name>/bucket=<b>/   complete, typed rows
    blooms/run=<name>/              a filter per bucket, about 4 bytes an id

Filters are written before the rows they announce. A run that failed half-way is repeated
under its name and replaces what it left.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from paytide import schema as s
from paytide.functions.bloom import bloom, holds
from paytide.operators.cleansing import deduplicate
from paytide.sources.files import remove, subfolders
from paytide.sources.staging import staged

ID, TIME = "txn_id", "txn_timestamp"
NAMES = s.TYPED.names
BUCKETS = 64
#: Share of foreign ids a filter holds by mistake.
RATE = 1e-6
#: Runs of one tier that are merged into one run of the next.
FAN_IN = 8

_FILTER = "bucket int, filter binary"
_STORED = StructType(s.TYPED.fields + [StructField("bucket", IntegerType()), StructField("run", StringType())])


@dataclass(frozen=True)
class Change:
    """What rows change: copies that count from now on, and those that no longer do."""

    added: DataFrame
    removed: DataFrame


class IdIndex:
    """The index at `path`.

    `buckets` counts when the index is begun and is then kept with it. The filters of one
    bucket, over all runs, have to fit into a task: a million ids a bucket take 4 MB.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        begun = subfolders(spark, path.rstrip("/"), "buckets")
        self.buckets = int(next(iter(begun))) if begun else buckets
        self.path = f"{path.rstrip('/')}/buckets={self.buckets}"

    def runs(self) -> list[str]:
        """Names of all runs. Only what has filters can have rows."""
        return sorted(subfolders(self.spark, f"{self.path}/copies", "run"))

    def copies(self, runs: Collection[str] | None = None) -> DataFrame:
        """Rows of the given runs, of all by default; an id may occur in several."""
        if not self.runs():
            return self.spark.createDataFrame([], _STORED)
        rows = self.spark.read.schema(_STORED).parquet(f"{self.path}/copies")
        return rows if runs is None else rows.filter(F.col("run").isin(*runs))

    def winners(self) -> DataFrame:
        """The copy that counts of every id."""
        return self.copies().select(*NAMES).transform(deduplicate)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        h1 = F.xxhash64(ID)
        return rows.withColumns(
            {
                "bucket": F.pmod(h1, F.lit(self.buckets)).cast("int"),
                "_h1": h1,
                # The seed comes first: after the id it would only extend the first hash.
                "_h2": F.xxhash64(F.lit(1), F.col(ID)),
            }
        )

    def places(self, ids: DataFrame, without: str | None = None) -> dict[str, list[int]]:
        """Buckets that may hold one of the ids, by run. Bounded by runs times buckets."""
        runs = [r for r in self.runs() if r != without]
        if not runs:
            return {}
        filters = self.spark.read.schema(f"{_FILTER}, run string").parquet(f"{self.path}/blooms")
        filters = filters.filter(F.col("run").isin(*runs))

        def probe(left: pa.Table, right: pa.Table) -> pa.Table:
            h1, h2 = left["_h1"].to_numpy(), left["_h2"].to_numpy()
            hit = [bool(holds(f.as_py(), h1, h2, RATE).any()) for f in right["filter"]]
            return right.select(["run", "bucket"]).filter(pa.array(hit, pa.bool_()))

        keyed = self._keyed(ids.select(ID)).select("bucket", "_h1", "_h2")
        hits = (
            keyed.groupBy("bucket")
            .cogroup(filters.groupBy("bucket"))
            .applyInArrow(probe, "run string, bucket int")
        )
        found: dict[str, list[int]] = {}
        for r in hits.collect():
            found.setdefault(r["run"], []).append(r["bucket"])
        return found

    def current(self, ids: DataFrame, without: str | None = None) -> DataFrame:
        """The copies that count of the given ids, as far as there are any; `without` leaves
        out a run."""
        return self._counting(ids, self.places(ids, without))

    def _counting(self, ids: DataFrame, places: dict[str, list[int]]) -> DataFrame:
        wanted = F.lit(False)
        for run, buckets in places.items():
            wanted = wanted | ((F.col("run") == run) & F.col("bucket").isin(*buckets))
        known = self.copies().filter(wanted).select(*NAMES)
        return known.join(ids.select(ID).distinct(), ID, "left_semi").select(*NAMES).transform(deduplicate)

    def absorb(self, rows: DataFrame, run: str) -> Change:
        """What `rows`, complete and typed, change against all runs but `run`.

        The earliest copy of an id counts, ties settled as in `deduplicate`; a copy equal to
        the one that counts changes nothing, so rows taken in before may come again.
        """
        fresh = staged(rows.select(*NAMES).transform(deduplicate))
        places = self.places(fresh, without=run)
        if not places:
            return Change(fresh, fresh.limit(0))
        known = staged(self._counting(fresh, places))
        both = fresh.withColumn("_new", F.lit(True)).unionByName(known.withColumn("_new", F.lit(False)))
        # Last in the order of ties: of equal copies the known one stays.
        order = [*[c for c in NAMES if c not in (ID, TIME)], "_new"]
        added = staged(both.transform(deduplicate, tiebreak=order).filter("_new").drop("_new"))
        return Change(added, known.join(added.select(ID), ID, "left_semi").select(*NAMES))

    def commit(self, run: str, added: DataFrame) -> None:
        """Store a run's copies, replacing an earlier attempt."""

        def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            data = bloom(table["_h1"].to_numpy(), table["_h2"].to_numpy(), RATE)
            return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([data], pa.binary())})

        keyed = self._keyed(added)
        filters = keyed.select("bucket", "_h1", "_h2").groupBy("bucket").applyInArrow(build, _FILTER)
        filters.write.mode("overwrite").parquet(f"{self.path}/blooms/run={run}")
        (
            keyed.select(*NAMES, "bucket")
            .hint("rebalance", F.col("bucket"))
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.path}/copies/run={run}")
        )

    def compact(self, fan_in: int = FAN_IN) -> None:
        """Merge runs, `fan_in` of a tier into one of the next; superseded copies go.

        Not while a run is between its commit and the point from which it is not repeated:
        a merged run can no longer be left out by name.
        """
        tier, runs = 0, self.runs()
        while True:
            own = [r for r in runs if _tier(r) == tier]
            if len(own) >= fan_in:
                merged = f"t{tier + 1}-{uuid.uuid4().hex}"
                self.commit(merged, staged(self.copies(own).select(*NAMES).transform(deduplicate)))
                for kind in ("copies", "blooms"):
                    remove(self.spark, [f"{self.path}/{kind}/run={r}" for r in own])
                runs = [r for r in runs if r not in own] + [merged]
            elif not any(_tier(r) > tier for r in runs):
                return
            tier += 1


def _tier(run: str) -> int:
    """Merged runs are named by their tier; all others are of the lowest."""
    head = run.split("-", 1)[0]
    return int(head[1:]) if head[:1] == "t" and head[1:].isdigit() else 0
