"""The build: driver tables (or the published CSV extracts) -> landed raw -> staging
(lazy) -> marts (written).

Order and materialisation follow the original layering: raw tables are landed whole
(overwrite), staging stays a lazy plan that Catalyst folds into each mart's write,
and each mart is one write job. Everything downstream (checks, insights, views)
reads the *written* marts, so lineage is cut at the mart boundary and a lost
executor only re-runs the stage it was in, not the raw mapping.

Storage lives under the session's shared checkpoint folder (see ``storage_root``).
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.operators import checks as _checks
from edustar.operators import insights as _ins
from edustar.operators import marts as _marts
from edustar.operators import staging as _stg
from edustar.operators import views as _views
from edustar.session import storage_root
from edustar.sources import manifest
from edustar.sources.fixtures import RAW_BUILDERS
from edustar.sources.files import land_raw, read_ees_csv, read_register_csv

_RUN = uuid.uuid4().hex[:12]
_LOCK = threading.Lock()
_LOCK_FRAMES = threading.Lock()
_CACHE: dict[tuple, "Warehouse"] = {}

STAGING = {
    "stg_gias": ("raw_gias", _stg.stg_gias),
    "stg_attendance": ("raw_attendance", _stg.stg_attendance),
    "stg_ks4": ("raw_ks4", _stg.stg_ks4),
}


def _run_together(jobs) -> None:
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


class Warehouse:
    """Landed raw tables and written marts for one input folder."""

    MARTS = tuple(_marts.MART_BUILDERS)

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 partition_facts_by_year: bool = False):
        """``partition_facts_by_year`` writes both facts in one folder per academic year, so a
        year predicate prunes whole folders (``PartitionFilters``); worth it once the facts
        span many years, not at the test sizes."""
        self.spark = spark
        self.partition_facts_by_year = partition_facts_by_year
        self.sf_dir = sf_dir.rstrip("/")
        tag = "".join(ch if ch.isalnum() else "_" for ch in self.sf_dir.strip("/"))[-60:]
        self.root = root or f"{storage_root(spark)}/edustar/{_RUN}/{tag}"
        self._version: str | None = None
        self._sizes: dict[str, int] | None = None
        self._frames: dict[str, DataFrame] = {}

    # -- paths ----------------------------------------------------------------
    @property
    def version(self) -> str:
        """The version that this warehouse reads: the one it built, else the published one."""
        if self._version is None:
            self._version = manifest.current(self.spark, self.root)
            if self._version is None:
                raise RuntimeError(f"nothing is published under {self.root}; build first")
        return self._version

    def refresh(self) -> "Warehouse":
        """Read the version that is published now."""
        self._version = self._sizes = None
        self._frames.clear()
        return self

    def raw_path(self, name: str) -> str:
        return f"{self.root}/versions/{self.version}/raw/{name}"

    def mart_path(self, name: str) -> str:
        return f"{self.root}/versions/{self.version}/marts/{name}"

    def lookup_path(self, name: str) -> str:
        return f"{self.root}/versions/{self.version}/lookups/{name}"

    # -- build ----------------------------------------------------------------
    def build(self, csv_files: dict[str, str] | None = None, multi_line: bool | None = None, check: bool = False) -> "Warehouse":
        """Write a new version of every table, check it, then publish it.

        By default the raw tables come from the driver tables under ``sf_dir``. With
        ``csv_files`` ({"raw_gias": path, "raw_attendance": path, "raw_ks4": path}) they
        are read from the published CSV extracts instead (register in Latin-1, the two
        statistics files in UTF-8), as the original loader does; ``multi_line`` as in ``files.read_csv``.

        The version lies in a folder of its own until all is written and, with ``check``, no error-level check fails
        (``DataCheckError``); then the manifest makes it current. Whatever fails before that, readers keep the version
        before. Row counts and row checks are observed by the writing jobs and stored beside the tables.
        """
        draft = Warehouse(self.spark, self.sf_dir, self.root, self.partition_facts_by_year)
        draft._version = manifest.new_version()
        draft._write(csv_files, multi_line)
        if check:
            _checks.raise_on_error(draft.checked())
        manifest.publish(self.spark, self.root, draft.version)
        self._version, self._sizes, self._frames = draft._version, None, draft._frames
        return self

    def _write(self, csv_files: dict[str, str] | None, multi_line: bool | None) -> None:
        """Each mart depends on one raw table only (dim_school <- raw_gias, the attendance fact <- raw_attendance, the
        results fact <- raw_ks4), so the three chains (land raw, then write its mart) are submitted together, one thread
        each; Spark runs concurrent jobs of one application side by side. Any failure re-raises."""
        source = {"dim_school": "raw_gias", "fct_attendance_weekly": "raw_attendance", "fct_ks4_results": "raw_ks4"}
        readers = {"raw_gias": read_register_csv, "raw_attendance": read_ees_csv, "raw_ks4": read_ees_csv}
        metrics: list[tuple] = []

        def raw_frame(raw_name: str) -> DataFrame:
            if csv_files:
                return readers[raw_name](self.spark, csv_files[raw_name], multi_line)
            return RAW_BUILDERS[raw_name](self.spark, self.sf_dir)

        def chain(mart: str) -> None:
            raw_name = source[mart]
            stg_name, fn = _marts.MART_BUILDERS[mart]
            n_rows = land_raw(raw_frame(raw_name), self.raw_path(raw_name))
            # staging and mart are one map-only job: every row passes both counters once
            staged, of_staging = _checks.observed(self.staging(stg_name), stg_name)
            rows, of_mart = _checks.observed(fn(staged), mart)
            writer = rows.write
            if self.partition_facts_by_year and mart.startswith("fct_"):
                writer = writer.partitionBy("academic_year")
            writer.parquet(self.mart_path(mart))
            metrics.extend([(raw_name, "rows", "*", n_rows)] + _checks.metric_rows(stg_name, of_staging) + _checks.metric_rows(mart, of_mart))
            if mart == "dim_school":
                # the dimension collapsed to one region per LA (by code and by name): tiny,
                # written with it so the queries do not re-aggregate the dimension each time
                dim = self.spark.read.parquet(self.mart_path(mart))
                _ins.region_per_la(dim).write.parquet(self.lookup_path("la_region"))
                _ins.region_per_la_name(dim).write.parquet(self.lookup_path("la_region_by_name"))

        def roll_up(name: str) -> None:
            cells, count = _checks.observed(_views.rollup(self.attendance, self.la_region, _views.ROLLUPS[name]), name)
            cells.coalesce(1).write.parquet(self.lookup_path(name))
            metrics.extend(_checks.metric_rows(name, count))

        _run_together([lambda m=m: chain(m) for m in source])
        _run_together([lambda r=r: roll_up(r) for r in _views.ROLLUPS])
        self.spark.createDataFrame(metrics, _checks.METRICS_SCHEMA).coalesce(1).write.parquet(self.lookup_path("metrics"))

    # -- readers --------------------------------------------------------------
    def _read(self, path: str) -> DataFrame:
        """One DataFrame per stored table: its file listing and footers are read once."""
        with _LOCK_FRAMES:
            df = self._frames.get(path)
            if df is None:
                df = self._frames[path] = self.spark.read.parquet(path)
        return df

    def raw(self, name: str) -> DataFrame:
        return self._read(self.raw_path(name))

    def staging(self, name: str) -> DataFrame:
        return self._memo(f"staging:{name}", lambda: STAGING[name][1](self.raw(STAGING[name][0])))

    def _memo(self, key: str, make) -> DataFrame:
        """A shared DataFrame (a plan, not data) per derived view; it re-runs in full on each action."""
        with _LOCK_FRAMES:
            df = self._frames.get(key)
        if df is None:
            df = make()
            with _LOCK_FRAMES:
                df = self._frames.setdefault(key, df)
        return df

    def mart(self, name: str) -> DataFrame:
        """The stored mart, columns in the mart's own order (a partition column is read back last)."""
        df = self._read(self.mart_path(name))
        if self.partition_facts_by_year and name.startswith("fct_"):
            stg_name, fn = _marts.MART_BUILDERS[name]
            return df.select(*fn(self.staging(stg_name)).columns)
        return df

    @property
    def metrics(self) -> DataFrame:
        """Counts observed while this version was written: (model, check_name, column_name, failures)."""
        return self._read(self.lookup_path("metrics"))

    def tables(self) -> dict[str, DataFrame]:
        """Staging views and marts by name."""
        return {n: self.staging(n) for n in STAGING} | {n: self.mart(n) for n in self.MARTS}

    def checked(self) -> DataFrame:
        """The 22 checks of this version."""
        return _checks.observed_suite(self.tables(), self.metrics)

    def attendance_view(self, *needed: str) -> DataFrame:
        """Attendance with region and period labels, from the smallest stored roll-up that keeps the ``needed`` columns of
        the fact, else from the fact itself."""
        if self._sizes is None:
            self._sizes = {r["model"]: r["failures"] for r in self.metrics.where(F.col("model").isin(*_views.ROLLUPS)).collect()}  # one row a roll-up
        name = _views.smallest_rollup(needed, self._sizes)
        if name is None:
            return self.enriched
        return self._memo(f"rollup:{name}", lambda: _views.rollup_view(self._read(self.lookup_path(name))))

    @property
    def dim(self) -> DataFrame:
        return self.mart("dim_school")

    @property
    def attendance(self) -> DataFrame:
        return self.mart("fct_attendance_weekly")

    @property
    def ks4(self) -> DataFrame:
        return self.mart("fct_ks4_results")

    @property
    def la_region(self) -> DataFrame:
        """Stored ``region_per_la(dim)``: one region per LA code."""
        return self._read(self.lookup_path("la_region"))

    @property
    def la_region_by_name(self) -> DataFrame:
        """Stored ``region_per_la_name(dim)``: one region per LA name."""
        return self._read(self.lookup_path("la_region_by_name"))

    @property
    def enriched(self) -> DataFrame:
        """Every attendance fact row with region and period columns (the dashboard's base view)."""
        return self._memo("enriched", lambda: _views.attendance_enriched(self.attendance, self.dim, self.la_region))

    @property
    def schools(self) -> DataFrame:
        """Every KS4 result row named from the results, region looked up by LA name."""
        return self._memo("schools", lambda: _views.schools_enriched(self.ks4, self.dim, self.la_region_by_name))

    def register_views(self, staging: bool = True) -> None:
        """Marts (and the lazy staging views) under their bare names, for SQL text."""
        for name in _marts.MART_BUILDERS:
            self.mart(name).createOrReplaceTempView(name)
        if staging:
            for name in STAGING:
                self.staging(name).createOrReplaceTempView(name)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Build once per (session, input folder); later calls reuse the written tables."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = Warehouse(spark, sf_dir).build()
            _CACHE[key] = wh
    return wh
