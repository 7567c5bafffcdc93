"""S6 + S8 + S15: a layered run that replaces all layers at once and resumes.

A *version* of the stored layers is a manifest: model -> folder, rows and
fingerprint.  A run writes each model it must build into a new folder, which
no reader knows yet, and ends by renaming one small pointer file.  A reader
takes the pointer once and then sees one whole version, whatever runs go on; a
run that dies leaves the old version in place.

A model's *fingerprint* covers what its rows depend on: the code of the models'
modules, the parameters it uses, and the fingerprints of the models it reads,
down to the raw tables, whose fingerprint is their files' paths, lengths and
modification times.  When a model is written, a ledger entry under its
fingerprint names its folder.  A later run takes every model whose fingerprint
is in the ledger as it is, so it goes on where a failed run stopped and
rebuilds only what an input, a parameter or a code change reaches.  Raw tables
that do not come from files have no fingerprint and are always rebuilt from.

The pointer names the newest version.  ``expire`` removes versions before the
last few and the folders only they use; a folder or ledger entry of a run that
has not published is kept for ``grace`` seconds, so it may be resumed.

The fact also gets a copy clustered by stale flag and case (``plans.clustered``),
written beside the marts and published with its version: look-ups of a case and
the stale list read a part of it.

    <location>/_pointer             name of the newest manifest
    <location>/_manifests/<v>.json  versions, numbered upwards
    <location>/_ledger/<fp>.json    folder and rows of a finished model
    <location>/data/<model>-<id>/   Parquet, and the clustered copies
"""

from __future__ import annotations

import datetime as dt
import hashlib
import inspect
import json
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from types import ModuleType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casekit.functions import exact, exprs
from casekit.functions import json as json_functions
from casekit.operators import lifecycle, marts, staging, timings
from casekit.operators.lifecycle import SLA_DAYS, STALE_HOURS
from casekit.plans import clustered
from casekit.plans.pipeline import Models, build_all
from casekit.sources import storage

# What each model reads, and the modules that define it.
READS: dict[str, list[str]] = {
    "int_case_timings": ["stg_cases", "stg_case_events", "stg_interactions"],
    "fct_case_lifecycle": ["int_case_timings", "stg_feedback"],
    "mart_ops_kpis": ["fct_case_lifecycle"],
    "mart_advocate_caseload": ["stg_advocates", "fct_case_lifecycle"],
    "mart_bottlenecks": ["fct_case_lifecycle"],
}
_HELPERS = [exprs, exact]
MODULES: dict[str, list[ModuleType]] = {
    "int_case_timings": [timings, *_HELPERS],
    "fct_case_lifecycle": [lifecycle, *_HELPERS],
    **{m: [marts, *_HELPERS] for m in ("mart_ops_kpis", "mart_advocate_caseload", "mart_bottlenecks")},
}
# Models that may be written at the same time: all their inputs are stored.
STEPS = [[n for n in Models.NAMES if n in staging.STAGING], ["int_case_timings"], ["fct_case_lifecycle"],
         [n for n in Models.NAMES if n.startswith("mart_")]]
# Clustered copies: model -> (cluster columns, columns with Bloom filters).
COPIES = {"fct_case_lifecycle": (["stale_case_flag", "case_id"], ["case_id"])}
WRITERS = 3  # models written at once; Spark shares its executors among them


def _digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def _raw_fingerprint(spark: SparkSession, df: DataFrame) -> str:
    states = storage.input_states(spark, df)
    # The plan's columns and expressions belong to it too (two tables may be
    # cut from one file): its canonical text, which has no running ids.
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    return _digest(sorted(states.items()), plan) if states else uuid.uuid4().hex


def fingerprints(spark: SparkSession, raw: Mapping[str, DataFrame], as_of, sla_days: int,
                 stale_hours: int) -> dict[str, str]:
    """Fingerprint of every model."""
    if as_of is None:  # the clock of the run: never the same again
        as_of = uuid.uuid4().hex
    parameters = {"fct_case_lifecycle": [as_of, sla_days, stale_hours]}
    out: dict[str, str] = {}
    for name in Models.NAMES:
        if name in staging.STAGING:
            reads = [_raw_fingerprint(spark, raw[staging.STAGING[name][1]])]
            modules: list[ModuleType] = [staging, json_functions, exprs]
        else:
            reads, modules = [out[r] for r in READS[name]], MODULES[name]
        out[name] = _digest(name, reads, parameters.get(name), [inspect.getsource(m) for m in modules])
    return out


def _entry(spark: SparkSession, location: str, fingerprint: str) -> dict | None:
    """The ledger's entry, if its folder is whole."""
    text = storage.read_text(spark, f"{location}/_ledger/{fingerprint}.json")
    entry = json.loads(text) if text else None
    return entry if entry and "schema" in entry and storage.exists(spark, f"{entry['path']}/_SUCCESS") else None


def _copy_print(name: str, prints: Mapping[str, str]) -> str:
    return _digest(prints[name], COPIES[name], inspect.getsource(clustered))


def _prints_of(manifest: dict) -> dict[str, str]:
    return {**{n: m["fingerprint"] for n, m in manifest["models"].items()},
            **{f"copy {n}": c["fingerprint"] for n, c in manifest.get("copies", {}).items()}}


def _whole(manifest: dict) -> list[str]:
    """The marks of every folder of a version that was written to its end."""
    marks = [f"{m['path']}/_SUCCESS" for m in manifest["models"].values()]
    return marks + [f"{c['path']}/{clustered.STATISTICS}/_SUCCESS" for c in manifest.get("copies", {}).values()]


def refresh(spark: SparkSession, raw: Mapping[str, DataFrame], location: str, as_of: str | dt.datetime | None = None,
            sla_days: int = SLA_DAYS, stale_hours: int = STALE_HOURS,
            on_written: Callable[[str], None] | None = None) -> dict:
    """Bring the stored layers up to date and publish them; the manifest.

    ``manifest["models"][name]`` has path, rows, fingerprint and ``reused``.
    ``on_written`` is told each model that was written (after its ledger entry).
    """
    location = location.rstrip("/")
    prints = fingerprints(spark, raw, as_of, sla_days, stale_hours)
    current = _newest(spark, location)
    wanted = {**prints, **{f"copy {n}": _copy_print(n, prints) for n in COPIES}}
    if current and wanted == _prints_of(current) and all(storage.exists(spark, m) for m in _whole(current)):
        return {**current, "models": {n: {**m, "reused": True} for n, m in current["models"].items()}}
    models = build_all(spark, dict(raw), as_of, sla_days, stale_hours)
    done: dict[str, dict] = {}

    def store(name: str) -> None:
        entry = _entry(spark, location, prints[name])
        reused = entry is not None
        if entry is None:
            path = f"{location}/data/{name}-{uuid.uuid4().hex}"
            counted = Observation()
            df = models[name].observe(counted, F.count(F.lit(1)).alias("n"))
            df.write.parquet(path)
            entry = {"model": name, "path": path, "rows": counted.get["n"], "fingerprint": prints[name],
                     "schema": spark.read.parquet(path).schema.json()}
            storage.replace_text(spark, f"{location}/_ledger/{prints[name]}.json", json.dumps(entry), uuid.uuid4().hex)
        done[name] = {**entry, "reused": reused}
        if not reused and on_written:
            on_written(name)

    copies: dict[str, dict] = {}

    def copy(name: str) -> None:
        fingerprint = _copy_print(name, prints)
        entry = _entry(spark, location, fingerprint)
        if entry is None or not storage.exists(spark, f"{entry['path']}/{clustered.STATISTICS}/_SUCCESS"):
            path = f"{location}/data/{name}-clustered-{uuid.uuid4().hex}"
            by, bloom = COPIES[name]
            clustered.write(spark, done[name]["path"], _schema(done[name]), path, by, bloom)
            entry = {"model": name, "path": path, "fingerprint": fingerprint, "schema": done[name]["schema"]}
            storage.replace_text(spark, f"{location}/_ledger/{fingerprint}.json", json.dumps(entry), uuid.uuid4().hex)
        copies[name] = entry

    for step in STEPS:
        for name in step:
            models[name]  # plans are built on this thread
        with ThreadPoolExecutor(WRITERS) as pool:
            # Leaving the block waits for all of the step, also if one fails.
            running = [pool.submit(store, name) for name in step]
            # Copies of the step before are written beside this step's models.
            running += [pool.submit(copy, n) for n in COPIES if n in done and n not in copies and n not in step]
        for r in running:
            r.result()
        for name in step:
            # Later models read the stored rows: lineage is cut at every step.
            models.use(name, spark.read.schema(_schema(done[name])).parquet(done[name]["path"]))
    numbers = [int(n.split(".")[0]) for n in storage.names(spark, f"{location}/_manifests") if n.endswith(".json")]
    version = max(numbers, default=0) + 1
    manifest = {"version": version, "time": time.time(), "models": {n: done[n] for n in Models.NAMES}, "copies": copies}
    name = f"{version:012d}.json"
    storage.replace_text(spark, f"{location}/_manifests/{name}", json.dumps(manifest), uuid.uuid4().hex)
    storage.replace_text(spark, f"{location}/_pointer", name, uuid.uuid4().hex)
    return manifest


def _schema(entry: dict) -> StructType:
    return StructType.fromJson(json.loads(entry["schema"]))


def _newest(spark: SparkSession, location: str) -> dict | None:
    name = storage.read_text(spark, f"{location}/_pointer")
    text = storage.read_text(spark, f"{location}/_manifests/{name}") if name else None
    return json.loads(text) if text else None


class Version(Mapping):
    """One whole version of the stored layers, by model name.

    The pointer is read once, here (or was by the refresh whose manifest is
    given); a refresh meanwhile changes nothing.
    """

    def __init__(self, spark: SparkSession, location: str, manifest: dict | None = None) -> None:
        manifest = manifest or _newest(spark, location.rstrip("/"))
        if manifest is None:
            raise FileNotFoundError(f"{location}: no layers were published here")
        self._spark, self.manifest = spark, manifest

    @property
    def number(self) -> int:
        return self.manifest["version"]

    def __getitem__(self, name: str) -> DataFrame:
        entry = self.manifest["models"][name]
        reader = self._spark.read
        if "schema" in entry:  # not in versions of earlier releases; else no file is opened for it
            reader = reader.schema(_schema(entry))
        return reader.parquet(entry["path"])

    def clustered(self, name: str) -> clustered.Clustered:
        """The model's clustered copy, for look-ups."""
        if name not in self.manifest.get("copies", {}):
            raise FileNotFoundError(f"this version has no clustered copy of {name}: refresh the layers")
        return clustered.Clustered(self._spark, self.manifest["copies"][name]["path"],
                                   _schema(self.manifest["models"][name]), COPIES[name][0])

    def __iter__(self):
        return iter(self.manifest["models"])

    def __len__(self) -> int:
        return len(self.manifest["models"])


def _entries(manifest: dict) -> list[dict]:
    return [*manifest["models"].values(), *manifest.get("copies", {}).values()]


def expire(spark: SparkSession, location: str, keep: int = 2, grace: float = 7 * 86400) -> list[str]:
    """Remove all but the newest ``keep`` versions, and the folders and ledger
    entries only they use; the names of the folders removed.

    Readers of a removed version fail, so ``keep`` and the time between runs
    must outlast the longest report.
    """
    location = location.rstrip("/")
    manifests = storage.names(spark, f"{location}/_manifests")
    kept = [json.loads(storage.read_text(spark, f"{location}/_manifests/{n}")) for n in manifests[-keep:]]
    used = {m["path"].rsplit("/", 1)[-1] for v in kept for m in _entries(v)}
    old = time.time() - grace
    removed = []
    folders = storage.names(spark, f"{location}/data")
    states = storage.file_states(spark, [f"{location}/data/{n}" for n in folders])
    published = {m["path"].rsplit("/", 1)[-1] for n in manifests[:-keep]
                 for m in _entries(json.loads(storage.read_text(spark, f"{location}/_manifests/{n}")))}
    for n in folders:
        unfinished = n not in published and states[f"{location}/data/{n}"][1] / 1000 > old
        if n not in used and not unfinished:
            removed.append(n)
    for n in storage.names(spark, f"{location}/_ledger"):
        text = storage.read_text(spark, f"{location}/_ledger/{n}")
        if text and n.endswith(".json") and json.loads(text)["path"].rsplit("/", 1)[-1] in removed:
            storage.delete(spark, f"{location}/_ledger/{n}")
    for n in manifests[:-keep]:
        storage.delete(spark, f"{location}/_manifests/{n}")
    for n in removed:
        storage.delete(spark, f"{location}/data/{n}")
    return removed
