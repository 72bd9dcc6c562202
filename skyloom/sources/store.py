"""Feature tables: one folder per group, partitioned by the day of the feature time.

Beside its history a group has a table of latest records, one row per entity, dealt over
buckets by a hash of the entity. An ingest rewrites the buckets of the entities it touches, so
reading current values never touches the history.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.values import utc
from skyloom.operators.asof import as_of_join, exact_time_join, newest_versions, version_rank
from skyloom.operators.windows import seconds
from skyloom.schemas import Feature, FeatureGroup
from skyloom.session import materialise

_REGISTRY = (
    "group string, position int, feature string, value_type string, description string, about string, buckets int"
)
_KEYS = ["entity_id", "feature_time"]
_VERSIONS, _DAY, _BUCKET = "versions", "feature_date", "bucket"
#: The version of a value that came without a sequence number.
_UNNUMBERED = -(1 << 63)


class FeatureStore:
    """Feature groups below one path of a shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # Registry

    def create(self, group: FeatureGroup, buckets: int = 16) -> FeatureGroup:
        """Declare a group: its features are saved, and its tables exist from now on.

        ``buckets`` is the number of folders that the latest records are dealt over; a group
        that exists keeps the number it has.
        """
        buckets = self._declared_buckets(group.name) or buckets
        rows = [
            F.struct(
                F.lit(group.name).alias("group"),
                F.lit(position).alias("position"),
                F.lit(f.name).alias("feature"),
                F.lit(f.value_type).alias("value_type"),
                F.lit(f.description).alias("description"),
                F.lit(group.description).alias("about"),
                F.lit(buckets).alias("buckets"),
            )
            for position, f in enumerate(group.features)
        ]
        registry = self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
        registry.write.mode("overwrite").json(f"{self.path}/registry/{group.name}")
        for path, day in ((self._table_path(group), _DAY), (self._latest_path(group), _BUCKET)):
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._schema(group, day)]
            self.spark.range(0).select(*empty).write.mode("append").partitionBy(day).parquet(path)
        return group

    def _declared_buckets(self, name: str) -> int | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/registry/{name}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        first = self.spark.read.schema(_REGISTRY).json(f"{self.path}/registry/{name}").select("buckets").first()
        return first.buckets if first else None

    def group(self, name: str) -> FeatureGroup:
        """Read a declaration back; a handful of rows."""
        registry = self.spark.read.schema(_REGISTRY).json(f"{self.path}/registry/{name}")
        rows = registry.orderBy("position").collect()
        return FeatureGroup(
            name,
            tuple(Feature(r.feature, r.value_type, r.description or "") for r in rows),
            rows[0].about or "" if rows else "",
        )

    # Tables

    def _table_path(self, group: FeatureGroup) -> str:
        return f"{self.path}/tables/{group.name}"

    def _latest_path(self, group: FeatureGroup) -> str:
        return f"{self.path}/latest/{group.name}"

    def _schema(self, group: FeatureGroup, partition: str) -> T.StructType:
        """Keys and features, the sequence number each feature was last written with, and the folder."""
        versions = T.StructType([T.StructField(f, T.LongType()) for f in group.feature_names])
        kind = T.DateType() if partition == _DAY else T.IntegerType()
        return T.StructType(list(group.schema.fields)).add(_VERSIONS, versions).add(partition, kind)

    def _stored(self, group: FeatureGroup) -> DataFrame:
        return self.spark.read.schema(self._schema(group, _DAY)).parquet(self._table_path(group))

    def _latest(self, group: FeatureGroup) -> DataFrame:
        return self.spark.read.schema(self._schema(group, _BUCKET)).parquet(self._latest_path(group))

    def _bucket(self, group: FeatureGroup, entity: Column) -> Column:
        return F.pmod(F.xxhash64(entity), F.lit(self._declared_buckets(group.name))).cast("int")

    def ingest(
        self,
        group: FeatureGroup,
        source: DataFrame,
        *,
        entity_id: str,
        feature_time: str,
        feature_ids: list[str] | None = None,
        sequence: str | None = None,
    ) -> None:
        """Merge records into a group; one record stays per entity and time.

        Every feature of a key has a version of its own. With ``feature_ids`` only those features
        are written, the others of a key keep their stored values. Of several values of one feature
        that with the highest sequence wins, also against stored ones and in whatever order they
        arrive; without a sequence column each ingest counts as newer than the last and
        must not hold a key twice with different values. Running the same ingest
        again changes nothing. Only the days present in ``source`` are read and
        rewritten, and each of them is replaced as a whole when the job commits;
        a lost executor repeats tasks that still see the old files. A day with
        many rows is written by many tasks, each sorted by entity, so that reads
        of named entities skip row groups.

        The latest records of the entities in ``source`` are renewed in a second commit; if the
        application dies in between, the same ingest run again completes it.
        """
        wanted = group.select(feature_ids)
        for name in wanted:
            declared, found = group.schema[name].dataType, source.schema[name].dataType
            if declared != found:
                raise TypeError(f"feature {name} is declared {declared}, the source has {found}")
        order = F.col(sequence).cast("long") if sequence else F.lit(None).cast("long")
        # the day in UTC, whatever the zone of the session
        day = F.floor(F.unix_micros(F.col(feature_time).cast("timestamp")) / 86_400_000_000)
        incoming = source.select(
            F.col(entity_id).cast("string").alias("entity_id"),
            F.col(feature_time).alias("feature_time"),
            *[F.col(w) if w in wanted else F.lit(None).cast(group.schema[w].dataType).alias(w)
              for w in group.feature_names],
            F.coalesce(order, F.lit(_UNNUMBERED).cast("long")).alias("order"),
            F.date_from_unix_date(day.cast("int")).alias(_DAY),
        ).filter(F.col("entity_id").isNotNull() & F.col("feature_time").isNotNull())
        # read once: the days below are those of the rows written
        incoming = materialise(incoming, "ingest")

        # One value per calendar day: the folders this ingest replaces.
        days = [r[0] for r in incoming.select(_DAY).distinct().collect()]
        if not days:
            return
        kept = self._stored(group).filter(F.col(_DAY).isin(days))
        number = F.col("order") if sequence else F.lit(self._next_sequence(group, kept))
        written = [
            (number if w in wanted else F.lit(None)).cast("long").alias(w) for w in group.feature_names
        ]
        arriving = incoming.withColumn(_VERSIONS, F.struct(*written)).select(kept.columns)
        merged = self._merged(group, kept.unionByName(arriving))
        (
            merged.hint("rebalance", _DAY)
            .sortWithinPartitions(_DAY, *_KEYS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_DAY)
            .parquet(self._table_path(group))
        )
        self._renew_latest(group, incoming.select("entity_id").distinct(), days)

    def _merged(self, group: FeatureGroup, rows: DataFrame) -> DataFrame:
        """One row per key, each feature at its highest version.

        A feature that a row does not write has no version there. Values of one version are told
        apart by a hash of their row. Each task reduces its rows before the shuffle.
        """
        names = group.feature_names
        values, versions = [], []
        for name in names:
            version = F.col(_VERSIONS)[name]
            rank = F.when(version.isNotNull(), version_rank(version, *names))
            values.append(F.max_by(name, rank).alias(name))
            versions.append(F.max(version).alias(f"_v_{name}"))
        best = rows.groupBy(*_KEYS, _DAY).agg(*values, *versions)
        versions = F.struct(*[F.col(f"_v_{name}").alias(name) for name in names])
        return best.select(*_KEYS, *names, versions.alias(_VERSIONS), _DAY)

    def _renew_latest(self, group: FeatureGroup, touched: DataFrame, days: list) -> None:
        """L2: the newer of the stored latest record and those of the days just written, per touched entity."""
        columns = [*_KEYS, *group.feature_names, _VERSIONS]
        bucket = self._bucket(group, F.col("entity_id")).alias(_BUCKET)
        # at most as many numbers as there are buckets: the folders replaced
        buckets = [r[0] for r in touched.select(bucket).distinct().collect()]
        stored = self._latest(group).filter(F.col(_BUCKET).isin(buckets))
        here = self._stored(group).filter(F.col(_DAY).isin(days)).join(touched, "entity_id", "left_semi")
        rows = stored.select(*columns, F.lit(0).alias("_fresh")).unionByName(
            here.select(*columns, F.lit(1).alias("_fresh"))
        )
        (
            _newest(rows)
            .select(*columns, bucket)
            .hint("rebalance", _BUCKET)
            .sortWithinPartitions(_BUCKET, "entity_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_BUCKET)
            .parquet(self._latest_path(group))
        )

    def _next_sequence(self, group: FeatureGroup, stored: DataFrame) -> int:
        highest = [F.max(F.col(_VERSIONS)[name]) for name in group.feature_names]
        tops = [top for top in stored.agg(*highest).first() if top is not None and top >= 0]
        return max(tops) + 1 if tops else 0

    def ingest_files(
        self,
        group: FeatureGroup,
        path: str,
        *,
        fmt: str = "parquet",
        entity_id: str,
        feature_time: str,
        feature_ids: list[str] | None = None,
        sequence: str | None = None,
    ) -> None:
        """S14 from files; ``fmt="avro"`` needs the Avro package on the cluster."""
        self.ingest(
            group,
            self.spark.read.format(fmt).load(path),
            entity_id=entity_id,
            feature_time=feature_time,
            feature_ids=feature_ids,
            sequence=sequence,
        )

    def read(
        self,
        group: FeatureGroup,
        feature_ids: list[str] | None = None,
        start: datetime | None = None,
        end: datetime | None = None,
    ) -> DataFrame:
        """The records of a group, all or those in ``[start, end)``; only those days are listed."""
        stored = self._stored(group)
        time, day = F.col("feature_time"), F.col(_DAY)
        if start is not None:
            stored = stored.filter((day >= F.lit(utc(start).date())) & (time >= F.lit(utc(start))))
        if end is not None:
            stored = stored.filter((day <= F.lit(utc(end).date())) & (time < F.lit(utc(end))))
        return stored.select(*_KEYS, *group.select(feature_ids))

    def read_latest(
        self,
        group: FeatureGroup,
        feature_ids: list[str] | None = None,
        entity_ids: list[str] | None = None,
        start: datetime | None = None,
    ) -> DataFrame:
        """L2: the newest record of each entity, or of the entities named.

        Read from the table of latest records; of named entities only their buckets are listed.
        ``start`` leaves out entities without a record since then.
        """
        latest = self._latest(group)
        if entity_ids is not None:
            buckets = [self._bucket(group, F.lit(e)) for e in entity_ids]
            latest = latest.filter(F.col("entity_id").isin(entity_ids) & F.col(_BUCKET).isin(*buckets))
        if start is not None:
            latest = latest.filter(F.col("feature_time") >= F.lit(utc(start)))
        return latest.select(*_KEYS, *group.select(feature_ids))

    def serve(
        self,
        spine: DataFrame,
        wanted: dict[str, list[str]],
        *,
        time: str = "timestamp",
        exact: tuple[str, ...] = (),
        max_age: str | None = None,
        bucket: str = "1 day",
        between: tuple[datetime, datetime] | None = None,
    ) -> DataFrame:
        """Join each named group to the spine column of the same name as of ``time``.

        Groups in ``exact`` have a record at every spine time and take the
        equality join. ``between`` states the range ``[first, end)`` of the spine
        times, if known: later days of the tables are then not read, and with
        ``max_age`` earlier ones neither.
        """
        requests = spine
        for name, feature_ids in wanted.items():
            group = self.group(name)
            columns = group.select(feature_ids)
            first, end = between or (None, None)
            if first is not None and name not in exact:
                first = first - timedelta(seconds=seconds(max_age)) if max_age else None
            features = self.read(group, columns, first, end)
            if name in exact:
                spine = exact_time_join(spine, features, entity=name, time=time, columns=columns)
            else:
                spine = as_of_join(
                    spine, features, entity=name, time=time, columns=columns,
                    max_age=max_age, bucket=bucket, requests=requests,
                )
        return spine


def _newest(rows: DataFrame) -> DataFrame:
    """One row per entity: the newest, and of equal times the fresh one. Reduced before the shuffle."""
    others = [c for c in rows.columns if c != "entity_id"]
    best = F.max_by(F.struct(*others), F.struct("feature_time", "_fresh")).alias("_best")
    found = rows.groupBy("entity_id").agg(best)
    return found.select("entity_id", *[F.col("_best")[c].alias(c) for c in others])


def latest_records(
    features: DataFrame,
    entity_ids: list[str] | None = None,
    *,
    entity: str = "entity_id",
    time: str = "feature_time",
) -> DataFrame:
    """L2 without a store: one row per entity; each task reduces its rows before the shuffle."""
    if entity_ids is not None:
        features = features.filter(F.col(entity).isin(entity_ids))
    return newest_versions(features.filter(F.col(time).isNotNull()), [entity], time)
