"""Logical table names -> DataFrames.

Concept functions never read files; they receive DataFrames resolved by name
from a :class:`Sources` object.  Two constructors are provided:

* :meth:`Sources.from_tables` - any mapping (a catalog, parquet paths, tests)
* :meth:`Sources.from_events` - the adapter views derived from ``events``
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from . import adapters
from .parquet import read_table, SUPPLIED_TABLES
from .store import clustered, source_key, stored

BASE_TABLES = (
    "patients", "admissions", "diagnoses_icd", "labevents", "prescriptions",
    "microbiologyevents", "services", "poe", "poe_detail", "icustays", "chartevents",
    "inputevents", "outputevents", "procedureevents", "d_items",
)

#: derived from the distinct patients; the others are narrow views of the events
OF_PATIENTS = ("patients", "admissions", "icustays", "services", "diagnoses_icd")

#: events of one write task: an event unfolds to some 33 charted and 30 laboratory rows
EVENTS_A_PARTITION = 25_000


class Sources:
    """Lazy, memoised mapping from logical base-table name to DataFrame."""

    def __init__(self, spark: SparkSession, factories: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._factories = dict(factories)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._factories:
                raise KeyError(f"unknown source table {name!r}")
            self._cache[name] = self._factories[name]()
        return self._cache[name]

    def __contains__(self, name: str) -> bool:
        return name in self._factories

    def names(self):
        return sorted(self._factories)

    def prepare(self) -> None:
        """Write the stored tables now rather than when a plan first needs them."""
        for name in self.names():
            self[name]

    def override(self, name: str, df: DataFrame) -> None:
        """Replace a table (e.g. with a persisted, narrowed copy)."""
        self._factories[name] = lambda: df
        self._cache[name] = df

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: Mapping[str, DataFrame]) -> "Sources":
        return cls(spark, {k: (lambda v=v: v) for k, v in tables.items()})

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, materialize: bool = True) -> "Sources":
        """EHR-shaped adapter views over ``{sf_dir}/events.parquet``.

        With ``materialize`` (default) the narrow events, clustered by patient and
        time, and the tables of patients and stays are written once to the shared
        store (see :mod:`.store`) and read back.  The views of the events are
        unfolded from the stored ones in the scan of whatever reads them: a
        filter on items drops the others' rows as they arise, and the some
        thirty rows an event has in each item table are never written nor
        read.  The rows of one patient and time come from one file, so that a pivot's
        map-side aggregate takes them up before its shuffle.
        """
        holder: dict[str, DataFrame] = {}

        def events():
            if "events" not in holder:
                holder["events"] = read_table(spark, sf_dir, "events")
            return holder["events"]

        def ev():
            if "ev" not in holder:
                base = adapters.events_base(events())
                holder["ev"] = stored(spark, key, "events_by_patient", lambda: clustered(
                    base, ("user_id", "t"), EVENTS_A_PARTITION)) if materialize else base
            return holder["ev"]

        def users():
            if "users" not in holder:
                holder["users"] = adapters.users(events())
            return holder["users"]

        factories = {
            "chartevents": lambda: adapters.chartevents(ev()),
            "labevents": lambda: adapters.labevents(ev()),
            "outputevents": lambda: adapters.outputevents(ev()),
            "inputevents": lambda: adapters.inputevents(ev()),
            "procedureevents": lambda: adapters.procedureevents(ev()),
            "prescriptions": lambda: adapters.prescriptions(ev()),
            "microbiologyevents": lambda: adapters.microbiologyevents(ev()),
            "poe": lambda: adapters.poe(ev()),
            "poe_detail": lambda: adapters.poe_detail(ev()),
            "d_items": lambda: adapters.d_items(spark),
            "patients": lambda: adapters.patients(users()),
            "admissions": lambda: adapters.admissions(users()),
            "icustays": lambda: adapters.icustays(users()),
            "services": lambda: adapters.services(users()),
            "diagnoses_icd": lambda: adapters.diagnoses_icd(users()),
        }
        if materialize:
            key = source_key(spark, sf_dir, ["events.parquet"])
            for name in OF_PATIENTS:
                factories[name] = lambda n=name, f=factories[name]: stored(spark, key, n, f)
        for name in SUPPLIED_TABLES:
            factories.setdefault(name, (lambda n=name: read_table(spark, sf_dir, n)))
        return cls(spark, factories)

