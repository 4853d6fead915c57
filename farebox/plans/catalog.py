"""Mart catalogue (S15), SQL namespace and views (S16, S17, P9), export of a
named mart (S13, S14).

``MartCatalog`` ties a typed trips DataFrame to the nine mart builders and
the derived KPI tables.  Names outside the catalogue are an error, as the
dashboard's download and API routes answer 404 for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import kpis as K
from farebox.operators import marts as A
from farebox.plans import shared as SH
from farebox.sinks import publish as PB
from farebox.sinks import writers as W
from farebox.sources import text as TX

# The nine served datasets (the dashboard's list, in its order).
SERVED = ["trips_per_hour", "revenue_per_zone", "speed_analysis", "peak_revenue",
          "kpi_summary", "payment_methods", "peak_vs_offpeak", "weekly_revenue",
          "suspicious_trips"]


# What the KPI table is composed of.
KPI_INPUTS = ["total_trips", "peak_revenue", "suspicious_trips", "payment_methods",
              "revenue_per_zone", "speed_analysis", "trips_per_hour"]


class UnknownMart(ValueError):
    pass


class MartCatalog:
    """Name -> mart DataFrame over one trips DataFrame.  Marts are built
    lazily and memoised as DataFrames (plans), not as collected data."""

    NAMES = [*SERVED, "od_flows", "total_trips"]

    def __init__(self, trips: DataFrame, *, weekly_year: int = S.WEEKLY_YEAR,
                 marts: dict[str, DataFrame] | None = None, rounding: str = "sql"):
        self.trips = trips
        self.weekly_year = weekly_year
        self.rounding = rounding
        self._given = set(marts or {})
        self._built: dict[str, DataFrame] = dict(marts or {})
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "trips_per_hour": lambda: A.trips_per_hour(self.trips),
            "revenue_per_zone": lambda: A.revenue_per_zone(self.trips, rounding=self.rounding),
            "speed_analysis": lambda: A.speed_analysis(self.trips, rounding=self.rounding),
            "peak_revenue": lambda: A.peak_revenue(self.trips, rounding=self.rounding),
            "payment_methods": lambda: A.payment_methods(self.trips),
            "od_flows": lambda: A.od_flows(self.trips, top=20),
            "weekly_revenue": lambda: A.weekly_revenue(self.trips, year=self.weekly_year),
            "suspicious_trips": lambda: A.suspicious_trips(self.trips),
            "peak_vs_offpeak": lambda: A.peak_vs_offpeak(self.trips),
            "total_trips": lambda: A.total_trips(self.trips),
            "kpi_summary": self._kpis,
        }

    def names(self) -> list[str]:
        return list(self._builders)

    def get(self, name: str) -> DataFrame:
        if name not in self._builders:
            raise UnknownMart(f"unknown dataset: {name!r}")
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    __getitem__ = get

    def _kpis(self) -> DataFrame:
        """From the given marts where they are all there, else from one scan
        of the trips (composing it of marts built here scans them once each)."""
        if not self._given.issuperset(KPI_INPUTS):
            return SH.kpi_summary_one_pass(self.trips, rounding=self.rounding)
        return K.kpi_summary(total=self.get("total_trips"), peak=self.get("peak_revenue"),
                             suspicious=self.get("suspicious_trips"),
                             payment=self.get("payment_methods"),
                             zones=self.get("revenue_per_zone"),
                             speed=self.get("speed_analysis"),
                             hours=self.get("trips_per_hour"))

    # S16 / S17 / P9 - SQL access (see also ``create_database``)
    def register_views(self, spark: SparkSession, database: str | None = None,
                       names: list[str] | None = None) -> list[str]:
        """Temp views ``trips``, ``peak_vs_offpeak_view`` (trips + periode) and
        one per mart, optionally after creating and selecting a database."""
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
            spark.catalog.setCurrentDatabase(database)
        self.trips.createOrReplaceTempView("trips")
        A.with_period(self.trips).createOrReplaceTempView("peak_vs_offpeak_view")
        done = ["trips", "peak_vs_offpeak_view"]
        for n in names or self.names():
            self.get(n).createOrReplaceTempView(n)
            done.append(n)
        return done

    # S13 / S14 - export a named mart
    def export(self, name: str, path: str, fmt: str = "csv") -> None:
        if fmt not in W.WRITERS:
            raise ValueError(f"unknown format: {fmt!r}")
        # catalogue marts are bounded by their key domain: one sorted file each
        extra = {"mart": name} if fmt == "tsv" else {}
        W.WRITERS[fmt](self.get(name), path, order_by=export_order(name), single_file=True, **extra)

    def export_all(self, base: str, fmt: str = "csv", names: list[str] | None = None) -> dict[str, str]:
        out = {}
        for n in names or SERVED:
            p = f"{base.rstrip('/')}/{n}"
            self.export(n, p, fmt)
            out[n] = p
        return out

    def publish(self, output: str, fmt: str = "csv", names: list[str] | None = None, *, keep: int = PB.KEEP) -> str:
        """Export the marts as one version and point readers to it once all
        are written; returns the version's folder."""
        return PB.publish(self.trips.sparkSession, output, lambda folder: self.export_all(folder, fmt, names), keep=keep)

    def add(self, name: str, build: Callable[[DataFrame], DataFrame]) -> None:
        """A mart of the user's own, served and exported by its name."""
        if name in self._builders:
            raise ValueError(f"{name!r} is taken")
        self._builders[name] = lambda: build(self.trips)


def export_order(name: str) -> list[str | Column] | None:
    """What a written mart is sorted by: its measure where the mart is ranked,
    the table's own order of indicators for the KPIs, else its keys."""
    if name == "kpi_summary":
        at = F.array_position(F.array(*map(F.lit, K.KPI_ORDER)), F.col("indicateur"))
        return [F.nullif(at, F.lit(0)).asc_nulls_last(), F.col("indicateur")]
    if name in S.MART_ORDER:
        return [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in S.MART_ORDER[name]]
    return S.MART_KEYS.get(name) or None


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current namespace as a DataFrame."""
    return spark.sql("SHOW TABLES")


def create_database(spark: SparkSession, database: str, raw_path: str, *, table: str = "yellow_taxi",
                    view: str = "peak_vs_offpeak", header: bool = False) -> None:
    """S1 / S16 / P9 as lasting objects: the database, selected; the external
    table over the delimited files of ``raw_path``; the row-level view with
    its period.  SQL then reads them by their names in any session of the
    catalogue.  Header lines that are not skipped (``header=True`` skips the
    first line of every file) have a NULL in every typed column; a table over
    files has no row filter, so count rows with the DataFrame readers."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.catalog.setCurrentDatabase(database)
    options = {**TX.CSV_TYPED_OPTIONS, "header": str(header).lower(), "path": raw_path}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in S.TRIP_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({columns}) USING csv OPTIONS ({listed})")
    (_, m_lo, m_hi), (_, e_lo, e_hi) = S.PERIOD_MORNING, S.PERIOD_EVENING
    spark.sql(f"""CREATE VIEW IF NOT EXISTS `{view}` AS SELECT *,
        CASE WHEN hour({S.PICKUP}) BETWEEN {m_lo} AND {m_hi} THEN '{S.PERIOD_MORNING[0]}'
             WHEN hour({S.PICKUP}) BETWEEN {e_lo} AND {e_hi} THEN '{S.PERIOD_EVENING[0]}'
             ELSE '{S.PERIOD_OFFPEAK}' END AS periode
        FROM `{table}`""")
