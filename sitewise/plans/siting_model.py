"""The siting model end to end, wired from the operators.

Inputs are the conformed gold tables (column names as in the warehouse):

* ``dim_kommun``: kommun_kod, lan_kod, elomrade, elomrade_secondary, gruppkod
* ``fleet``: kommun_kod, ar, drivmedel, antal            (cars in traffic, year-end)
* ``registrations``: kommun_kod, manad_start, drivmedel, antal
* ``price_days``: elomrade, datum, sek_medel, n_kvartar
* ``stations``: kommun_kod, kw_dc, _snapshot_date
* ``traffic``: kommun_kod, vkm_per_day, road_km
* ``population``: kommun_kod, ar, folkmangd
* parameter tables ``param_model`` (parameter, value), ``param_strategy``
  (scenario, alpha, quantity, combine_order), ``param_variant`` (variant,
  swap_from, swap_to, use_cost_factor, alpha, only_scenario, quantity),
  ``param_weights`` (scenario, metric, weight_raw), ``param_cost`` (gruppkod,
  cost_factor)

Outputs (a dict of DataFrames): ``metric`` (kommun × 12 metrics with
midrank positions), ``component``, ``score``, ``seat``, ``allocation``,
``combined_seat``, ``combined``.  Scalar parameters are read once from the
small parameter table on the driver (they shape the plan: window sizes,
seat counts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.operators.allocate import (allocate_combined, allocate_seats, allocation_summary,
                                         combined_summary)
from sitewise.operators.ranking import midrank_percentile
from sitewise.operators.score import expand_runs, normalise_weights, score, score_components, with_ranks
from sitewise.operators.shape import latest_snapshot, trailing_window
from sitewise.operators.shrink import eb_shrink
from sitewise.session import materialize
from sitewise.sources.publish import publish

def model_params(param_model: DataFrame) -> dict:
    """Key/value parameter table → one typed row (read once; a handful of rows)."""
    row = param_model.groupBy().pivot("parameter").agg(F.first(F.col("value").cast("double"))).first()
    p = row.asDict()
    ints = ("n_stations", "max_per_kommun", "growth_window_months", "price_window_days",
            "n_stations_p1_default", "combined_step")
    return {k: (int(v) if k in ints else float(v)) for k, v in p.items()}


@dataclass(frozen=True)
class Metric:
    """One metric: the source whose columns it is made of, its direction, its
    formula, and the columns that document it (``numerator``/``denominator``
    of a ratio, the ``prior`` and weight ``k`` it is shrunk with)."""

    name: str
    source: str
    better: str
    value: Column
    numerator: str | None = None
    denominator: str | None = None
    prior: str | None = None
    k: str | None = None
    as_of: str | None = None
    detail: Column | None = None


def _share(a: str, b: str) -> Column:
    return F.try_divide(F.col(a), F.col(b))


def _says(pattern: str, *cols: str | Column) -> Column:
    """A text from the columns; NULL where one of them is, not the word null."""
    values = [F.col(c) if isinstance(c, str) else c for c in cols]
    known = F.lit(True)
    for v in values:
        known = known & v.isNotNull()
    return F.when(known, F.format_string(pattern, *values))


def metric_specs() -> tuple[Metric, ...]:
    served, idle = F.lit(float("inf")), F.lit(0.0)  # no traffic: fully served; no road: no intensity
    return (
        Metric("ev_demand", "fleet", "higher", F.col("chargeable"), as_of="fleet_year",
               detail=_says("%d electric cars and %d plug-in hybrids weighted to %.1f", F.col("electric").cast("long"), F.col("hybrid").cast("long"), "chargeable")),
        Metric("growth_stock", "fleet", "higher", _share("electric", "cars") - _share("electric_then", "cars_then"), "electric", "cars", as_of="fleet_year",
               detail=_says("%.1f %% of all cars, two years before %.1f %%", 100 * _share("electric", "cars"), 100 * _share("electric_then", "cars_then"))),
        Metric("growth", "sales", "higher", F.col("value"), "x", "n", "p_c", "k", "last_month",
               detail=_says("%d of %d new cars, county %.1f %%, prior weight %s", F.col("x").cast("long"), F.col("n").cast("long"), 100 * F.col("p_c"), F.coalesce(F.format_number("k", 0), F.lit("all")))),
        Metric("growth_raw", "sales", "higher", F.col("raw"), "x", "n", as_of="last_month", detail=_says("%d of %d new cars", F.col("x").cast("long"), F.col("n").cast("long"))),
        Metric("price", "power", "lower", F.col("zone_price"), as_of="last_day", detail=_says("zone mean %.3f", "zone_price")),
        Metric("price_zone_alt", "power", "lower", F.col("second_zone_price"), as_of="last_day", detail=_says("second zone mean %.3f, own %.3f", "second_zone_price", "zone_price")),
        Metric("supply", "chargers", "lower", _share("kw", "chargeable"), "kw", "chargeable", as_of="fleet_year", detail=_says("%.0f kW for %.1f cars", "kw", "chargeable")),
        Metric("supply_county", "chargers", "lower", _share("county_kw", "county_chargeable"), "county_kw", "county_chargeable", as_of="fleet_year", detail=_says("county: %.0f kW for %.1f cars", "county_kw", "county_chargeable")),
        Metric("supply_traffic", "roads", "lower", F.when(F.col("vkm") > 0, F.col("kw") / (F.col("vkm") / 1000)).otherwise(served), "kw", "vkm", detail=_says("%.0f kW for %.0f vehicle km a day", "kw", "vkm")),
        Metric("through_traffic", "roads", "higher", _share("vkm", "people"), "vkm", "people", as_of="census_year", detail=_says("%.0f vehicle km a day by %.0f people", "vkm", "people")),
        Metric("traffic", "roads", "higher", F.col("vkm"), detail=_says("%.0f vehicle km a day", "vkm")),
        Metric("traffic_intensity", "roads", "higher", F.when(F.col("road_km") > 0, F.col("vkm") / F.col("road_km")).otherwise(idle), "vkm", "road_km", detail=_says("%.0f vehicle km a day on %.1f km", "vkm", "road_km")),
    )


def _fleet(fleet: DataFrame, phev_weight: float) -> DataFrame:
    """Cars per municipality in the newest year and two years before, by fuel."""
    newest = fleet.agg(F.max("ar")).scalar()
    age = newest - F.col("ar")

    def cars(years_ago: int, fuel: str | None = None) -> Column:
        here = age == years_ago
        return F.sum(F.when(here & (F.col("drivmedel") == fuel) if fuel else here, F.col("antal")))

    per = fleet.groupBy("kommun_kod").agg(
        cars(0).alias("cars"), cars(0, "BEV").alias("electric"), cars(0, "PHEV").alias("hybrid"),
        cars(2).alias("cars_then"), cars(2, "BEV").alias("electric_then"), F.first(newest).cast("string").alias("fleet_year"))
    return per.withColumn("chargeable", (F.col("electric") + F.lit(phev_weight) * F.col("hybrid")).cast("double"))


def _sales(registrations: DataFrame, counties: DataFrame, months: int) -> DataFrame:
    """Electric share of the window's new cars, shrunk towards the county."""
    recent = trailing_window(registrations, "manad_start", months)
    per = recent.groupBy("kommun_kod").agg(
        F.sum(F.when(F.col("drivmedel") == "BEV", F.col("antal")).otherwise(0)).cast("double").alias("x"),
        F.sum("antal").cast("double").alias("n"))
    last = registrations.agg(F.max("manad_start")).scalar()
    return eb_shrink(per.join(counties, "kommun_kod"), "lan_kod", "x", "n").withColumn("last_month", last.cast("string"))


def _power(price_days: DataFrame, places: DataFrame, days: int) -> DataFrame:
    """Mean price of the window per quarter-hour, of a place's zone and of its
    second zone (its own zone again where it has none)."""
    zone = trailing_window(price_days, "datum", days, unit="days").groupBy("elomrade").agg(
        F.sum(F.col("sek_medel") * F.col("n_kvartar")).alias("paid"), F.sum("n_kvartar").alias("quarters"))
    zone = zone.select("elomrade", _share("paid", "quarters").cast("double").alias("mean_price"))
    both = places.select("kommun_kod", F.explode(F.array(
        F.struct(F.lit("zone_price").alias("which"), F.col("elomrade")),
        F.struct(F.lit("second_zone_price").alias("which"), F.coalesce("elomrade_secondary", "elomrade").alias("elomrade")))).alias("z"))
    per = both.select("kommun_kod", "z.*").join(zone, "elomrade").groupBy("kommun_kod").pivot("which", ["zone_price", "second_zone_price"]).agg(F.first("mean_price"))
    return per.withColumn("last_day", price_days.agg(F.max("datum")).scalar().cast("string"))


def _chargers(places: DataFrame, fleet: DataFrame, stations: DataFrame) -> DataFrame:
    """Fast-charging power of each place with a fleet, and of its county."""
    power = stations.groupBy("kommun_kod").agg(F.sum("kw_dc").cast("double").alias("kw"))
    per = places.select("kommun_kod", "lan_kod").join(fleet.select("kommun_kod", "chargeable", "fleet_year"), "kommun_kod")
    per = per.join(power, "kommun_kod", "left").fillna(0.0, ["kw"])
    county = per.groupBy("lan_kod").agg(F.sum("kw").alias("county_kw"), F.sum("chargeable").alias("county_chargeable"))
    return per.join(county, "lan_kod")


def _roads(chargers: DataFrame, traffic: DataFrame, population: DataFrame) -> DataFrame:
    counted = population.where(F.col("folkmangd").isNotNull())
    people = latest_snapshot(counted, "ar").select("kommun_kod", F.col("folkmangd").cast("double").alias("people"), F.col("ar").cast("string").alias("census_year"))
    flows = traffic.select("kommun_kod", F.col("vkm_per_day").cast("double").alias("vkm"), F.col("road_km").cast("double").alias("road_km"))
    return chargers.select("kommun_kod", "kw").join(flows, "kommun_kod").join(people, "kommun_kod")


def metrics(dim_kommun, fleet, registrations, price_days, stations, traffic, population, p) -> DataFrame:
    """Long metric table: kommun_kod, metric, better, value, the documenting
    columns numerator, denominator, prior, k, as_of and detail (in words), and pct_rank.  Each
    source is read once; its metrics are rows of a generator."""
    cars = _fleet(fleet, p["phev_weight"])
    chargers = _chargers(dim_kommun, cars, stations)
    sources = {
        "fleet": cars,
        "sales": _sales(registrations, dim_kommun.select("kommun_kod", "lan_kod"), p["growth_window_months"]),
        "power": _power(price_days, dim_kommun, p["price_window_days"]),
        "chargers": chargers,
        "roads": _roads(chargers, traffic, population),
    }
    long = None
    for name, df in sources.items():
        rows = [F.struct(F.lit(m.name).alias("metric"), F.lit(m.better).alias("better"), m.value.cast("double").alias("value"),
                         (F.lit(None).cast("string") if m.detail is None else m.detail).alias("detail"),
                         *[(F.col(c) if (c := getattr(m, f)) else F.lit(None)).cast("string" if f == "as_of" else "double").alias(f)
                           for f in ("numerator", "denominator", "prior", "k", "as_of")])
                for m in metric_specs() if m.source == name]
        part = df.select("kommun_kod", F.inline(F.array(*rows)))
        long = part if long is None else long.unionByName(part)
    return midrank_percentile(long, ["metric"], "value", better_col="better")


class ModelRuleFailed(Exception):
    """A rule of the siting model does not hold; nothing is published."""


def check_model(out: dict[str, DataFrame], params: dict, places: DataFrame) -> None:
    """The model's own rules, each named in the error: every place is in
    every metric and in every run, has one row and one county, every component
    has a value and no unit lacks one, a metric's values are as of one date,
    each run hands out exactly its seats, every slider setting is complete
    and the default setting is there."""
    def any_row(df: DataFrame) -> bool:
        return not df.isEmpty()

    n = params["n_stations"]
    n_places = F.lit(places.count())
    labels = places.groupBy("kommun_kod").agg(F.count_distinct("lan_kod").alias("counties"), F.count(F.lit(1)).alias("rows"))
    broken = {
        "all_units_in_metric": any_row(out["metric"].groupBy("metric").agg(F.count_distinct("unit").alias("n")).where(F.col("n") != n_places)),
        "all_units_in_run": any_row(out["score"].groupBy("scenario", "variant").agg(F.count_distinct("unit").alias("n")).where(F.col("n") != n_places)),
        "one_label": any_row(labels.where("counties <> 1 OR rows <> 1")),
        "same_date": any_row(out["metric"].groupBy("metric").agg(F.count_distinct("as_of").alias("n")).where("n > 1")),
        "votes_present": any_row(out["score"].where(F.col("votes").isNull())),
        "value_present": any_row(out["component"].where(F.col("value").isNull() | F.isnan("value"))),
        "n_components": any_row(out["score"].where(F.col("n_components") != F.col("n_expected"))),
        "one_row_per_pair": any_row(out["metric"].groupBy("unit", "metric").count().where("count > 1")),
        "run_total": any_row(out["allocation"].where(F.col("run_seats") != n)),
        "combined_total": any_row(out["combined"].where(F.col("run_seats") != n)),
        "default_present": not any_row(out["combined"].where("is_default")),
    }
    if any(broken.values()):
        raise ModelRuleFailed(", ".join(sorted(k for k, bad in broken.items() if bad)))


def publish_model(t: dict[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """Runs the model and publishes its outputs as one version below
    ``target``, unless a rule of the written tables is broken."""
    params = model_params(t["param_model"])
    out = publish(t["param_model"].sparkSession, target, run_model(t), lambda staged: check_model(staged, params, t["dim_kommun"]))
    return {name: out.table(name) for name in out.tables}


def run_model(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    p = model_params(t["param_model"])
    # what several outputs read is written once
    met = materialize(metrics(t["dim_kommun"], t["fleet"], t["registrations"], t["price_days"], t["stations"],
                              t["traffic"], t["population"], p).withColumnRenamed("kommun_kod", "unit"))
    weights = normalise_weights(t["param_weights"])
    variants = t["param_variant"]
    units = t["dim_kommun"].select(F.col("kommun_kod").alias("unit"))
    comps = score_components(expand_runs(weights, variants), met, "unit", units)
    costs = (t["dim_kommun"].join(t["param_cost"], "gruppkod")
             .select(F.col("kommun_kod").alias("unit"), F.col("cost_factor").cast("double").alias("cost_factor")))
    sc = materialize(score(comps, t["param_strategy"], variants, met.select("unit", "metric", "value"), costs, "unit"))
    n, cap, fd = p["n_stations"], p["max_per_kommun"], p["first_divisor"]
    seats = materialize(allocate_seats(sc, ["scenario", "variant"], "unit", "votes", n_seats=n, cap=cap, first_divisor=fd))
    alloc = allocation_summary(sc.select("scenario", "variant", "unit"), seats, ["scenario", "variant"], "unit", n)
    alloc = alloc.withColumn("kw_new", F.col("n_seats") * F.lit(p["station_kw"]))

    # parameter tables (two strategies, a handful of variants) shape the plan: read on the driver
    order = {r.combine_order: r.scenario for r in t["param_strategy"].select("scenario", "combine_order").collect()}
    shared = variants.where(F.col("only_scenario").isNull()).select("variant")
    s1 = seats.where(F.col("scenario") == order[1]).join(shared, "variant")
    v2 = sc.where(F.col("scenario") == order[2]).join(shared, "variant").select("variant", "unit", "votes")
    comb = materialize(allocate_combined(s1.select("variant", "seat_no", "unit", "j", "divisor", "quotient"), v2, ["variant"],
                             "unit", "votes", n_target=n, step=p["combined_step"], cap=cap, first_divisor=fd,
                             first_label=order[1], second_label=order[2]))
    names = [r.variant for r in shared.collect()]
    combined = combined_summary(units, comb, names, "variant", "unit", n, p["combined_step"],
                                p["n_stations_p1_default"], unit_kw=p["station_kw"])
    return {"metric": met, "component": comps, "score": with_ranks(sc), "seat": seats, "allocation": alloc,
            "combined_seat": comb, "combined": combined}
