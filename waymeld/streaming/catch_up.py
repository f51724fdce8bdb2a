"""Catching up with a feed of changes to keyed records, batch by batch, with refused records tried again.

Each batch makes a new version of the table under <home>/rows/v=<batch> and of the refused records under
<home>/refused/v=<batch>. A batch that runs again after a failure finds its version complete and is passed over, so
every batch is applied once. Older versions are removed when the next one stands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymeld.operators.cdc import latest_by_key, merge_replace

#: Times that a refused record is asked for before it is given up.
TRIES = 8


class CatchUp:
    """State of a feed. hydrate: events (key, ...) to rows of the table, with `refused` true where a record did not come; it may give no row for a key that is empty now."""

    def __init__(self, spark: SparkSession, home: str, key: str, schema: str, hydrate: Callable[[DataFrame], DataFrame], worth: Column | None = None, tries: int = TRIES) -> None:
        self.spark, self.home, self.key, self.schema, self.hydrate, self.worth, self.tries = spark, home.rstrip("/"), key, schema, hydrate, worth, tries

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, name: str) -> list[int]:
        fs, p = self._fs(f"{self.home}/{name}")
        if not fs.exists(p):
            return []
        found = [s.getPath().toString() for s in fs.listStatus(p)]
        return sorted(int(f.rsplit("v=", 1)[1]) for f in found if "/v=" in f and self._fs(f"{f}/_SUCCESS")[0].exists(self._fs(f"{f}/_SUCCESS")[1]))

    def _read(self, name: str, schema: str) -> DataFrame:
        last = self._versions(name)
        return self.spark.read.schema(schema).parquet(f"{self.home}/{name}/v={last[-1]}") if last else self.spark.createDataFrame([], schema)

    def rows(self) -> DataFrame:
        """The table as of the last batch."""
        return self._read("rows", self.schema)

    def refused(self) -> DataFrame:
        """key, tries, given_up of records that did not come."""
        return self._read("refused", f"{self._key_type()}, tries int, given_up boolean")

    def _key_type(self) -> str:
        kind = dict(self.spark.createDataFrame([], self.schema).dtypes)[self.key]
        return f"{self.key} {kind}"

    def apply(self, events: DataFrame, batch: int) -> None:
        """events: key, event_type ('delete' or else), at (its time) and whatever hydrate needs. Of one key the latest counts, a delete first among equals."""
        if batch in self._versions("refused"):
            return
        last = latest_by_key(events.filter(F.col(self.key).isNotNull()), self.key, F.desc("at"), F.when(F.col("event_type") == "delete", 0).otherwise(1))
        gone = last.filter("event_type = 'delete'").select(self.key)
        asked = last.filter("event_type IS NULL OR event_type <> 'delete'")
        if self.worth is not None:
            asked = asked.filter(self.worth)
        waiting = self.refused().join(last.select(self.key), self.key, "left_anti")
        again = waiting.filter("NOT given_up").select(self.key)
        wanted = asked.select(self.key).unionByName(again)
        got = self.hydrate(asked.unionByName(again, allowMissingColumns=True)).persist()
        try:
            no = got.filter("refused").select(self.key).distinct()
            fresh = got.filter("NOT refused").drop("refused").select(*self.spark.createDataFrame([], self.schema).columns)
            answered = wanted.join(no, self.key, "left_anti")
            base = self.rows()
            merged = merge_replace(base, fresh, gone.unionByName(answered.join(fresh.select(self.key), self.key, "left_anti")), self.key)
            merged.write.mode("overwrite").parquet(f"{self.home}/rows/v={batch}")
            tries = no.join(self.refused(), self.key, "left").select(self.key, (F.coalesce("tries", F.lit(0)) + 1).alias("tries"))
            left = tries.select(self.key, "tries", (F.col("tries") >= self.tries).alias("given_up")).unionByName(waiting.filter("given_up"))
            # Written last: a batch counts as applied once this version stands.
            left.write.mode("overwrite").parquet(f"{self.home}/refused/v={batch}")
        finally:
            got.unpersist()
        for name in ("rows", "refused"):
            for v in self._versions(name)[:-2]:
                fs, p = self._fs(f"{self.home}/{name}/v={v}")
                fs.delete(p, True)

    def start(self, feed: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Runs over a streaming feed; trigger as for writeStream.trigger, by default all that is there and then an end."""
        return feed.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_totals(stream: DataFrame, key: str, at: str, value: str, late: str = "2 hours", window: str = "48 hours", step: str = "6 hours") -> DataFrame:
    """key, start, end, total, n of sliding windows over a stream of readings; readings later than `late` are left out."""
    w = F.window(F.col(at), window, step)
    out = stream.withWatermark(at, late).groupBy(F.col(key), w.alias("w")).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "total", "n")
