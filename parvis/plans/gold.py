"""Facts, timeline and the indicator table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parvis.constants import AREA_CODES, CATEGORIES, DWELLINGS, POPULATION, UNIT_PRICE_RANGE
from parvis.functions import indices as I
from parvis.functions.codes import year_month_key
from parvis.operators.quantiles import grouped_quantiles
from parvis.operators.rows import zscore
from parvis.operators.validation import within
from parvis.sources.schemas import inline
from parvis.staging import stage

AREA = "code_arrondissement"
MONTH_KEYS = [AREA, "year", "month"]


def plausible_prices(sales: DataFrame) -> DataFrame:
    """Sales whose unit price is in the plausible range; the filter reaches the file scan."""
    return sales.filter(within("prix_m2", UNIT_PRICE_RANGE))


def monthly_area_stats(sales: DataFrame) -> DataFrame:
    """Count, median, mean, quartiles and volume per area and month, all exact."""
    stats = grouped_quantiles(
        plausible_prices(sales), MONTH_KEYS, "prix_m2",
        {"prix_m2_median": 0.5, "prix_m2_p25": 0.25, "prix_m2_p75": 0.75},
        sums={"_prices": "prix_m2", "volume_eur": "valeur_fonciere"}, count="nb_transactions")
    return stats.select(
        *MONTH_KEYS, "nb_transactions", "prix_m2_median",
        (F.col("_prices") / F.col("nb_transactions")).alias("prix_m2_moyen"),
        "prix_m2_p25", "prix_m2_p75", "volume_eur")


def approx_monthly_area_stats(sales: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """The same table with approximate quantiles: one scan, one small shuffle."""
    q = F.percentile_approx("prix_m2", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
    return plausible_prices(sales).groupBy(*MONTH_KEYS).agg(
        F.count(F.lit(1)).alias("nb_transactions"), q.alias("_q"),
        F.avg("prix_m2").alias("prix_m2_moyen"), F.sum("valeur_fonciere").alias("volume_eur"),
    ).select(*MONTH_KEYS, "nb_transactions", F.col("_q")[1].alias("prix_m2_median"),
             "prix_m2_moyen", F.col("_q")[0].alias("prix_m2_p25"),
             F.col("_q")[2].alias("prix_m2_p75"), "volume_eur")


def poi_counts(poi: DataFrame) -> DataFrame:
    return poi.groupBy(AREA, "category", "subcategory").agg(F.count(F.lit(1)).alias("nb_poi"))


def poi_table(poi: DataFrame) -> DataFrame:
    """The points themselves, for maps."""
    return poi.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        AREA, "category", "subcategory", "name", "lon", "lat")


def poi_category_pivot(counts: DataFrame) -> DataFrame:
    """One column of counts per known category, zero where an area has none."""
    return counts.groupBy(AREA).agg(*[
        F.sum(F.when(F.col("category") == c, F.col("nb_poi")).otherwise(0)).alias(f"nb_{c}")
        for c in CATEGORIES])


def population_table(spark: SparkSession) -> DataFrame:
    return inline(spark, f"{AREA} string, population bigint",
                  list(zip(AREA_CODES, POPULATION, strict=True)))


def dwellings_table(spark: SparkSession) -> DataFrame:
    return inline(spark, f"{AREA} string, parc_logements bigint",
                  list(zip(AREA_CODES, DWELLINGS, strict=True)))


def latest_year_sales(monthly: DataFrame) -> DataFrame:
    """Per area over the last year with any sale: median of the monthly medians, and count."""
    last = monthly.select(F.max("year")).scalar()
    return monthly.filter(F.col("year") == last).groupBy(AREA).agg(
        F.median("prix_m2_median").alias("prix_m2"),
        F.sum("nb_transactions").alias("transactions_an"))


def all_year_units(units: DataFrame) -> DataFrame:
    return units.groupBy(AREA).agg(F.sum("nb_logements_finances").alias("log_sociaux_finances"))


def city_air(air: DataFrame) -> Column:
    """The overall mean air index as a scalar subquery."""
    return air.select(F.avg("aqi_mean_paris")).scalar()


def zero_for_missing(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def area_base(dim: DataFrame, population: DataFrame, dwellings: DataFrame, income: DataFrame,
              pivot: DataFrame) -> DataFrame:
    """The area table widened by its per-area inputs; missing counts are zero."""
    zero = zero_for_missing
    joined = dim.join(population, AREA, "left").join(dwellings, AREA, "left").join(
        income.select(AREA, F.col("MED21").alias("revenu_median")), AREA, "left").join(
        pivot, AREA, "left")
    return joined.select(
        AREA, "label", "centroid_lon", "centroid_lat", zero("population"),
        zero("parc_logements"), "revenu_median", *[zero(f"nb_{c}") for c in CATEGORIES])


def score(base: DataFrame) -> DataFrame:
    """The three ratios and the density the composite needs."""
    return base.withColumns({
        "idx_accessibilite": I.affordability(F.col("revenu_median"), F.col("prix_m2")),
        "idx_tension": I.tension(F.col("transactions_an"), F.col("parc_logements")),
        "idx_effort_social": I.social_effort(F.col("log_sociaux_finances"), F.col("population")),
        "poi_density": I.poi_density(
            [F.col(f"nb_{c}") for c in ("transport", "culture", "sante", "environnement")],
            F.col("population")),
    })


def with_attractiveness(scored: DataFrame) -> DataFrame:
    return scored.withColumn("idx_attractivite", I.attractiveness(
        zscore(scored, "idx_accessibilite"), zscore(scored, "poi_density"),
        zscore(scored, "idx_effort_social"), zscore(scored, "idx_tension")))


def kpi_area(dim: DataFrame, monthly: DataFrame, units: DataFrame, income: DataFrame,
             air: DataFrame, counts: DataFrame, population: DataFrame | None = None,
             dwellings: DataFrame | None = None) -> DataFrame:
    """One row per area with its figures and the four composite indicators.

    The scored rows are staged: the composite reads them for its statistics and its rows.
    """
    spark = dim.sparkSession
    base = area_base(
        dim, population if population is not None else population_table(spark),
        dwellings if dwellings is not None else dwellings_table(spark), income,
        poi_category_pivot(counts))
    full = base.join(latest_year_sales(monthly), AREA, "left").join(
        all_year_units(units), AREA, "left").withColumn("aqi_paris", city_air(air))
    scored = stage(score(full), "scored-areas")
    return with_attractiveness(scored).select(
        AREA, "label", "centroid_lon", "centroid_lat", "population", "parc_logements",
        "revenu_median", "prix_m2", "transactions_an", "log_sociaux_finances", "aqi_paris",
        *[f"nb_{c}" for c in CATEGORIES], "idx_accessibilite", "idx_tension",
        "idx_effort_social", "idx_attractivite")


def timeline_area(monthly: DataFrame) -> DataFrame:
    """The monthly series with a three-row mean and the step from the row before.

    The window groups hold one row per month, however many sales there are.
    """
    series = Window.partitionBy(AREA).orderBy("year", "month")
    price = F.col("prix_m2_median")
    return monthly.select(
        *MONTH_KEYS, year_month_key(F.col("year"), F.col("month")).alias("year_month"),
        "prix_m2_median", "nb_transactions", "volume_eur",
        F.avg(price).over(series.rowsBetween(-2, 0)).alias("prix_m2_median_3m"),
        (price - F.lag(price).over(series)).alias("delta_prix_m2_mom"))
