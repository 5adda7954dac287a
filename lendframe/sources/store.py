"""A keyed store of cache entries that changes in place: buckets of files, and manifests that say which of them count.

Entries lie in buckets of their digest. A change writes the buckets that it touches anew, beside their old files, and then one
manifest: per bucket the version whose files hold it. Readers take the newest manifest, so they see a change whole
or not at all, and go on reading what they began with. A manifest's folder is never overwritten: of two writers
at once the second fails and can try again. ``vacuum`` deletes files that no kept manifest names.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators.cache import customer_digest

SCHEMA = "digest string, cache_key string, payload string, seq long, written_at timestamp, expires_at timestamp"
_MANIFEST = "bucket int, version long, rows long"


@dataclass
class FeatureStore:
    """``buckets`` is fixed when the first entries are written; it bounds what a manifest holds."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def _folder(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), target

    def versions(self) -> list[int]:
        """Versions with a whole manifest, in order."""
        files, target = self._folder(f"{self.root}/manifests")
        if not files.exists(target):
            return []
        names = [s.getPath() for s in files.listStatus(target)]
        whole = [p for p in names if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().rpartition("=")[2]) for p in whole)

    def manifest(self, version: int | None = None) -> dict[int, tuple[int, int]]:
        """{bucket: (version of its files, rows)}, at most one entry a bucket."""
        known = self.versions()
        version = version if version is not None else known[-1] if known else None
        if version is None:
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifests/version={version}").collect()
        return {r["bucket"]: (r["version"], r["rows"]) for r in rows}

    def _read(self, held: dict[int, tuple[int, int]], only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/data/version={v}/bucket={b}" for b, (v, n) in sorted(held.items()) if n and (only is None or b in only)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All entries as of a version."""
        return self._read(self.manifest(version))

    def _bucket(self, digest: str = "digest") -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.buckets)).cast("int")

    def _replace(self, changed: DataFrame, old: dict[int, tuple[int, int]], touched: set[int]) -> int:
        """Write the touched buckets and then the manifest; the new version."""
        version = max(self.versions(), default=0) + 1
        data = f"{self.root}/data/version={version}"
        changed.select(*[c.split(" ")[0] for c in SCHEMA.split(", ")]).withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        try:
            counts = {r["bucket"]: r["rows"] for r in self.spark.read.schema(f"{SCHEMA}, bucket int").parquet(data).groupBy("bucket").agg(
                F.count(F.lit(1)).alias("rows")).collect()}
        except AnalysisException:  # no bucket has an entry left
            counts = {}
        held = old | {b: (version, counts.get(b, 0)) for b in touched}
        rows = [(b, v, n) for b, (v, n) in sorted(held.items())]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifests/version={version}")
        return version

    def _touched(self, digests: DataFrame) -> set[int]:
        return {r[0] for r in digests.select(self._bucket().alias("b")).distinct().collect()}

    def upsert(self, entries: DataFrame) -> int:
        """New entries replace stored ones of the same digest; only their buckets are written. The version, or the present one."""
        old, touched = self.manifest(), self._touched(entries)
        if not touched:
            return max(self.versions(), default=0)
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        kept = self._read(old, touched).join(entries.select("digest"), "digest", "left_anti")
        return self._replace(kept.select(*names).unionByName(entries.select(*names)), old, touched)

    def invalidate(self, customers: DataFrame, customer: str = "customer_id") -> int:
        """Delete the entries of the listed customers; the version, or the present one if nobody has an id."""
        gone = customers.select(customer_digest(customer).alias("digest")).filter("digest IS NOT NULL").distinct()
        old = self.manifest()
        # of the buckets that may hold them, those that do
        touched = self._touched(self._read(old, self._touched(gone)).join(gone, "digest", "left_semi"))
        if not touched:
            return max(self.versions(), default=0)
        return self._replace(self._read(old, touched).join(gone, "digest", "left_anti"), old, touched)

    def expire(self, now: Column) -> int:
        """Delete entries whose life has ended; buckets without such entries keep their files."""
        old = self.manifest()
        ended = self._read(old).filter(F.col("expires_at") <= now)
        touched = self._touched(ended)
        if not touched:
            return max(self.versions(), default=0)
        return self._replace(self._read(old, touched).filter(F.col("expires_at") > now), old, touched)

    def vacuum(self, keep: int = 2) -> None:
        """Delete manifests but the newest ``keep``, and the files that none of those names."""
        known = self.versions()
        named = {(v, b) for version in known[-keep:] for b, (v, _) in self.manifest(version).items()}
        for version in known[:-keep]:
            files, target = self._folder(f"{self.root}/manifests/version={version}")
            files.delete(target, True)
        files, data = self._folder(f"{self.root}/data")
        for folder in files.listStatus(data) if files.exists(data) else []:
            version = int(folder.getPath().getName().rpartition("=")[2])
            for part in files.listStatus(folder.getPath()):
                name = part.getPath().getName()
                if name.startswith("bucket=") and version <= known[-1] and (version, int(name.rpartition("=")[2])) not in named:
                    files.delete(part.getPath(), True)
