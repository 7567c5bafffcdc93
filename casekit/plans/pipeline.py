"""The layered run (raw -> staging -> intermediate -> marts) as one plan.

Models are plain DataFrame functions, so a whole layer chain is one logical
plan that Catalyst optimises end to end.  The fact is the one model several
marts read; ``materialize`` writes it once as Parquet into the cluster's
shared checkpoint folder (cutting lineage, surviving executor loss) and the
marts scan that copy with column pruning.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casekit.operators import marts, staging
from casekit.operators.lifecycle import SLA_DAYS, STALE_HOURS, case_lifecycle
from casekit.operators.timings import case_timings
from casekit.session import checkpoint_dir
from casekit.sources import files, storage

# Layer names (the reference's namespaces) and their models.
LAYERS = {
    "staging": ["stg_patients", "stg_advocates", "stg_cases", "stg_interactions",
                "stg_case_events", "stg_feedback"],
    "intermediate": ["int_case_timings"],
    "marts": ["fct_case_lifecycle", "mart_ops_kpis", "mart_advocate_caseload", "mart_bottlenecks"],
}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class Models(Mapping):
    """Every model of every layer by name, each built on first access.

    Building a DataFrame is driver-side work (plan construction and analysis),
    so a query pays only for the models it reads.  Data is never cached here:
    each entry is a lazy plan, except the fact when ``materialize_fact`` is set.
    """

    NAMES = [n for layer in LAYERS.values() for n in layer]

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], as_of, sla_days: int,
                 stale_hours: int, materialize_fact: bool) -> None:
        self._spark, self._raw, self._as_of = spark, raw, as_of
        self._sla_days, self._stale_hours = sla_days, stale_hours
        self._materialize_fact = materialize_fact
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self.NAMES)

    def use(self, name: str, df: DataFrame) -> None:
        """Serve ``name`` from ``df`` (e.g. its stored table) from now on.

        Models built later read the stored copy instead of recomputing it;
        models already built keep the plan they were built with.
        """
        self._built[name] = df

    def __len__(self) -> int:
        return len(self.NAMES)

    def _build(self, name: str) -> DataFrame:
        if name in staging.STAGING:
            fn, table = staging.STAGING[name]
            return fn(self._raw[table])
        if name == "int_case_timings":
            return case_timings(self["stg_cases"], self["stg_case_events"], self["stg_interactions"])
        if name == "fct_case_lifecycle":
            fact = case_lifecycle(self["int_case_timings"], self["stg_feedback"], self._as_of,
                                  self._sla_days, self._stale_hours)
            if self._materialize_fact:
                fact = materialize(self._spark, fact, "fct_case_lifecycle")
            return fact
        if name == "mart_ops_kpis":
            return marts.ops_kpis(self["fct_case_lifecycle"])
        if name == "mart_advocate_caseload":
            return marts.advocate_caseload(self["stg_advocates"], self["fct_case_lifecycle"])
        if name == "mart_bottlenecks":
            return marts.bottlenecks(self["fct_case_lifecycle"])
        raise KeyError(name)


def build_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    as_of: str | dt.datetime | None = None,
    sla_days: int = SLA_DAYS,
    stale_hours: int = STALE_HOURS,
    materialize_fact: bool = False,
) -> Models:
    """Every model of every layer, keyed by model name (built lazily)."""
    return Models(spark, raw, as_of, sla_days, stale_hours, materialize_fact)


# Staging tables keyed by the case id, and the column that holds it.
CASE_KEYED = {"stg_cases": "id", "stg_case_events": "case_id",
              "stg_interactions": "case_id", "stg_feedback": "case_id"}

BUCKET_BYTES = 8 << 20  # of the raw tables' files, per bucket


def bucket_count(spark: SparkSession, raw: Mapping[str, DataFrame]) -> int:
    """Buckets for the case-keyed tables: as many as the raw files' bytes ask
    for, so a task that joins one bucket of each does not grow with them."""
    found = {f: n for df in raw.values() for f, (n, _) in storage.input_states(spark, df).items()}
    return max(4, math.ceil(sum(found.values()) / BUCKET_BYTES))


def layer_path(location: str, prefix: str, name: str) -> str:
    """Folder of a stored model; readable without any catalog."""
    layer = next(n for n, names in LAYERS.items() if name in names)
    return f"{location.rstrip('/')}/{prefix}_{layer}.db/{name}"


def persist_layers(
    spark: SparkSession,
    models: Mapping[str, DataFrame],
    prefix: str,
    location: str,
    buckets: int | None = None,
    names: list[str] | None = None,
    register: bool = True,
) -> dict[str, int]:
    """Full refresh of the models under ``location``; rows per model.

    Each model is one Parquet folder per layer (``layer_path``), so any later
    process finds it by location.  Layers are written in order and each stored
    model replaces its plan for the layers after it, like the reference's
    staged tables; rows are counted while they are written.  With ``register``
    the folders are also tables of the databases ``<prefix>_<layer>``.

    With ``buckets`` (needs ``register``) the four case-keyed staging tables
    are bucketed and sorted by the case id into that many buckets, so the
    timings and fact joins that read them are co-located: no exchange.
    """
    rows: dict[str, int] = {}
    for layer, members in LAYERS.items():
        db = f"{prefix}_{layer}"
        if register:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} "
                      f"LOCATION '{location.rstrip('/')}/_catalog/{db}'")
        for name in members:
            if name not in models.keys() or (names and name not in names):
                continue
            path = layer_path(location, prefix, name)
            counted = Observation()
            df = models[name].observe(counted, F.count(F.lit(1)).alias("n"))
            bucketed = buckets and register and name in CASE_KEYED
            if bucketed:  # a task writes whole buckets: one file each, not one per task
                df = df.repartition(buckets, CASE_KEYED[name])
            writer = df.write.mode("overwrite").format("parquet").option("path", path)
            if bucketed:
                writer = writer.bucketBy(buckets, CASE_KEYED[name]).sortBy(CASE_KEYED[name])
            if register:
                writer.saveAsTable(f"{db}.{name}")
            else:
                writer.save()
            rows[name] = counted.get["n"]
            if isinstance(models, Models):
                # Later layers read the stored rows: each model is computed
                # once and lineage is cut at every layer.
                models.use(name, spark.table(f"{db}.{name}") if register
                           else spark.read.schema(df.schema).parquet(path))
    return rows


class StoredLayers(Mapping):
    """The models a full refresh stored, by name, read by location.

    Folders are looked up on access, so it works in any process and a report
    opens only the models it reads.
    """

    def __init__(self, spark: SparkSession, location: str, prefix: str = "casekit") -> None:
        self._spark, self._location, self._prefix = spark, location, prefix

    def __getitem__(self, name: str) -> DataFrame:
        df = None
        if name in Models.NAMES:
            df = files.read_or_none(self._spark, layer_path(self._location, self._prefix, name))
        if df is None:
            raise KeyError(name)
        return df

    def __iter__(self):
        return (n for n in Models.NAMES if n in self)

    def __len__(self) -> int:
        return sum(1 for _ in self)
