"""The whole build: landed files to raw, silver and gold tables under one root."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parvis.constants import CITY_POI, NATIONAL_POI
from parvis.functions.casts import to_iso_date
from parvis.operators import validation
from parvis.plans import gold, refresh, silver
from parvis.sources import readers, schemas
from parvis.sources.layout import (
    INGESTION, create_or_replace, read_latest, read_table, table_path, write_snapshot,
)
from parvis.sources.versions import replace_parts
from parvis.staging import scratch_scope

log = logging.getLogger(__name__)

CORE = ["arrondissements", "filosofi", "social_housing", "air_quality", "dvf"]
LAYERS = ("raw", "silver", "gold")
GOLD = ["dim_arrondissement", "fact_transactions_arr_mois", "fact_logements_sociaux",
        "fact_revenus_arr", "fact_air_quality", "fact_poi_arr", "dim_poi",
        "kpi_arrondissement", "timeline_arrondissement"]
FACTS, TIMELINE = "fact_transactions_arr_mois", "timeline_arrondissement"


def is_missing(error: Exception) -> bool:
    """Whether a read failed because nothing was landed or written at its path."""
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def if_landed(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where its path does not exist; other errors are raised."""
    try:
        return read()
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


class Build:
    """Paths and steps of one root folder for one ingestion day (``yyyy-MM-dd``)."""

    def __init__(self, spark: SparkSession, root: str, day: str, all_snapshots: bool = False):
        self.spark, self.root, self.day, self.all_snapshots = spark, root, day, all_snapshots
        self.report: DataFrame | None = None  # of the rules for sales, once these are cleaned

    def landed(self, source: str) -> str:
        return table_path(self.root, "landing", source)

    def latest(self, layer: str, source: str) -> DataFrame:
        return read_latest(self.spark, table_path(self.root, layer, source))

    # raw ---------------------------------------------------------------------------------

    def land(self, source: str) -> None:
        """One landed source to its raw table; the same day again replaces that day."""
        spark, path = self.spark, self.landed(source)
        below = []
        if source == "dvf":
            # By sale year too, so that landing one year leaves the others of the day alone.
            df = readers.read_transactions(spark, path).withColumn(
                "annee", F.year(to_iso_date(F.col("date_mutation"))))
            below.append("annee")
        elif source == "filosofi":
            income = if_landed(lambda: readers.read_income(spark, path))
            df = readers.income_fan_out(
                readers.income_fallback(spark) if income is None else income)
        elif source == "social_housing":
            df = readers.read_paged_records(spark, path)
        elif source == "air_quality":
            air = if_landed(lambda: readers.read_air(spark, path, lines=True))
            df = readers.air_fallback(spark) if air is None else air
        elif source == "arrondissements":
            df = readers.read_polygons(spark, path)
        elif source in CITY_POI:
            df = readers.tag_poi_source(readers.read_paged_records(spark, path), source)
        elif source in NATIONAL_POI:
            df = readers.read_poi_csv(spark, path, source)
        else:
            raise KeyError(f"unknown source {source!r}")
        write_snapshot(df, table_path(self.root, "raw", source), self.day, *below)

    # silver ------------------------------------------------------------------------------

    def areas(self) -> DataFrame:
        return silver.area_polygons(self.latest("raw", "arrondissements"))

    def clean(self, source: str) -> None:
        if source == "dvf":
            path = table_path(self.root, "raw", source)
            raw = read_table(self.spark, path) if self.all_snapshots else read_latest(
                self.spark, path, "annee")
            seen = Observation()
            df = silver.silver_transactions(raw.drop(INGESTION, "annee"), self.areas(), seen)
            self.report = validation.observed_report(
                self.spark, seen, silver.transaction_rules())
            for line in self.report.collect():
                log.info("dvf: %s rejects %d, %d are left", line.rule, line.rejected, line.kept)
        elif source == "poi":
            df = silver.silver_poi(self.spark, self._raw_poi(), self.areas(), self.day)
        else:
            steps = {"filosofi": silver.silver_income, "social_housing": silver.social_units,
                     "air_quality": silver.silver_air, "arrondissements": silver.silver_areas}
            df = steps[source](self.latest("raw", source).drop(INGESTION))
        write_snapshot(df.drop(INGESTION), table_path(self.root, "silver", source), self.day)

    def _raw_poi(self) -> list[DataFrame]:
        found = []
        for key in [*CITY_POI, *NATIONAL_POI]:
            raw = if_landed(lambda key=key: self.latest("raw", key))
            if raw is None:
                log.info("poi: %s was not landed", key)
            else:
                found.append(raw.drop(INGESTION))
        return found

    # gold --------------------------------------------------------------------------------

    def gold(self, name: str) -> DataFrame:
        return read_table(self.spark, table_path(self.root, "gold", name))

    def publish(self, tables: Sequence[str] = GOLD) -> None:
        """The chosen gold tables, in order; later ones read the earlier ones as written."""
        unknown = set(tables) - set(GOLD)
        if unknown:
            raise KeyError(f"unknown gold tables {sorted(unknown)}")
        for name in GOLD:
            if name in tables:
                with scratch_scope(self.spark):
                    path = table_path(self.root, "gold", name)
                    if name in (FACTS, TIMELINE):
                        replace_parts(self._gold(name), path, refresh.YEAR)
                    else:
                        create_or_replace(self._gold(name), path)

    def refresh(self, after: str) -> list[int]:
        """Bring facts and timeline up to the sales that landed later than the day ``after``.

        Only the raw files of the sale years that landed since are read, and only these years of
        the facts, and the years of the timeline they reach, are replaced. The result is that of
        a full build, as long as the areas are the same. Silver is not written, as its medians
        are over all years. Returns the years; without any nothing is done.
        """
        raw_path = table_path(self.root, "raw", "dvf")
        years = refresh.landed_years(self.spark, raw_path, after, self.day)
        if years:
            facts, series = (table_path(self.root, "gold", n) for n in (FACTS, TIMELINE))
            raw = read_table(self.spark, raw_path) if self.all_snapshots else read_latest(
                self.spark, raw_path, "annee")
            with scratch_scope(self.spark):
                sales = silver.located_transactions(
                    raw.filter(F.col("annee").isin(years)).drop(INGESTION, "annee"), self.areas())
                refresh.refresh_facts(sales, facts, years)
                refresh.refresh_timeline(self.spark, facts, series, years)
        return years

    def _gold(self, name: str) -> DataFrame:
        spark, read = self.spark, lambda source: self.latest("silver", source).drop(INGESTION)
        copies = {"dim_arrondissement": "arrondissements", "fact_revenus_arr": "filosofi",
                  "fact_logements_sociaux": "social_housing", "fact_air_quality": "air_quality"}
        if name in copies:
            return read(copies[name])
        if name == "fact_transactions_arr_mois":
            return gold.monthly_area_stats(read("dvf"))
        if name in ("fact_poi_arr", "dim_poi"):
            poi = if_landed(lambda: read("poi"))
            if poi is None:
                log.info("no points of interest")
                return schemas.empty(
                    spark, schemas.FACT_POI if name == "fact_poi_arr" else schemas.DIM_POI)
            return gold.poi_counts(poi) if name == "fact_poi_arr" else gold.poi_table(poi)
        if name == "kpi_arrondissement":
            return gold.kpi_area(*[self.gold(part) for part in (
                "dim_arrondissement", "fact_transactions_arr_mois", "fact_logements_sociaux",
                "fact_revenus_arr", "fact_air_quality", "fact_poi_arr")])
        return gold.timeline_area(self.gold("fact_transactions_arr_mois"))


def build_layers(spark: SparkSession, root: str, day: str, layers: Sequence[str] = LAYERS,
                 with_poi: bool = True, all_snapshots: bool = False,
                 sources: Sequence[str] | None = None, tables: Sequence[str] | None = None
                 ) -> dict[str, str]:
    """Run the chosen layers in order; the outcome per step is ``ok`` or the error.

    ``sources`` limits landing and cleaning to these sources (``poi`` stands for all points of
    interest when cleaning), ``tables`` the gold layer to these tables. A source that fails is
    logged and skipped. A failing gold layer is raised, as a partial set of gold tables would be
    served as if it were complete. What a step has staged is removed when it has ended.
    """
    build = Build(spark, root, day, all_snapshots)
    outcome: dict[str, str] = {}
    poi = [*CITY_POI, *NATIONAL_POI] if with_poi else []

    def attempt(layer: str, step: Callable[[str], None], names: list[str]) -> None:
        for source in names:
            if sources is not None and source not in sources:
                continue
            try:
                with scratch_scope(spark):
                    step(source)
                outcome[f"{layer}/{source}"] = "ok"
            except Exception as error:
                log.error("%s/%s failed: %s", layer, source, error)
                outcome[f"{layer}/{source}"] = str(error).splitlines()[0]

    if "raw" in layers:
        attempt("raw", build.land, CORE + poi)
    if "silver" in layers:
        attempt("silver", build.clean, CORE + (["poi"] if with_poi else []))
    if "gold" in layers:
        build.publish(GOLD if tables is None else tables)
        outcome["gold"] = "ok"
    return outcome
