"""End-to-end siting model on a hand-made fixture (6 kommuner, 2 counties,
2 price zones): sizes, ranges, the +inf rule, seat totals, caps and the
combined-allocation endpoints."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sitewise.plans.siting_model import ModelRuleFailed, metric_specs, publish_model, run_model
from sitewise.sources.publish import versions

# Model parameters, strategies, variants and weights as published;
# seat count, cap, step and default scaled down for six kommuner.
PARAM_MODEL = [("n_stations", "10"), ("station_kw", "600"), ("max_per_kommun", "3"), ("first_divisor", "1.0"),
               ("phev_weight", "0.6"), ("growth_window_months", "12"), ("price_window_days", "365"),
               ("n_stations_p1_default", "5"), ("combined_step", "5")]
STRATEGY = [("P1", 1.0, "ev_demand", 1), ("P2", 0.5, "traffic", 2)]
VARIANT = [
    ("base", None, None, True, None, None, None),
    ("no_cost", None, None, False, None, None, None),
    ("zone_secondary", "price", "price_zone_alt", True, None, None, None),
    ("supply_county", "supply", "supply_county", True, None, None, None),
    ("growth_raw", "growth", "growth_raw", True, None, None, None),
    ("growth_stock", "growth", "growth_stock", True, None, None, None),
    ("alpha_025", None, None, True, 0.25, "P2", None),
    ("alpha_075", None, None, True, 0.75, "P2", None),
    ("quantity_ev", None, None, True, None, "P2", "ev_demand"),
]
WEIGHTS = [("P1", "growth", 0.0), ("P1", "price", 50.0), ("P1", "supply", 50.0), ("P1", "supply_traffic", 0.0),
           ("P1", "through_traffic", 0.0), ("P2", "growth", 30.0), ("P2", "price", 0.0), ("P2", "supply", 20.0),
           ("P2", "supply_traffic", 25.0), ("P2", "through_traffic", 25.0)]

KOMMUN = [("0114", "01", "SE3", None, "A1"), ("0115", "01", "SE3", None, "B3"), ("0117", "01", "SE3", "SE4", "C8"),
          ("1214", "12", "SE4", None, "A1"), ("1230", "12", "SE4", None, "B3"), ("1231", "12", "SE4", None, "C8")]


@pytest.fixture(scope="module")
def tables(spark):
    ks = [k[0] for k in KOMMUN]
    fleet = [(k, y, f, (i + 1) * {"BEV": 100 + 40 * (y - 2022), "PHEV": 80, "PETROL": 900}[f])
             for i, k in enumerate(ks) for y in (2022, 2023, 2024) for f in ("BEV", "PHEV", "PETROL")]
    regs = [(k, dt.date(2024, m, 1), f, (i + 2) * (m if f == "BEV" else 10 + (i * m) % 7))
            for i, k in enumerate(ks) for m in range(1, 13) for f in ("BEV", "PETROL")]
    prices = [(z, dt.date(2024, 1, 1) + dt.timedelta(days=d), (0.5 if z == "SE3" else 0.8) + (d % 7) / 100, 96)
              for z in ("SE3", "SE4") for d in range(400)]
    stations = [("0114", 300.0, dt.date(2025, 9, 1)), ("0114", 150.0, dt.date(2025, 9, 1)),
                ("0115", 50.0, dt.date(2025, 9, 1)), ("1214", 400.0, dt.date(2025, 9, 1)),
                ("1230", 22.0, dt.date(2025, 9, 1))]
    traffic = [("0114", 900000.0, 120.0), ("0115", 400000.0, 80.0), ("0117", 0.0, 0.0),
               ("1214", 700000.0, 150.0), ("1230", 300000.0, 60.0), ("1231", 250000.0, 90.0)]
    pop = [(k, 2024, 10000 * (i + 1)) for i, k in enumerate(ks)]
    t = {
        "dim_kommun": spark.createDataFrame(KOMMUN, "kommun_kod string, lan_kod string, elomrade string, "
                                                    "elomrade_secondary string, gruppkod string"),
        "fleet": spark.createDataFrame(fleet, "kommun_kod string, ar int, drivmedel string, antal long"),
        "registrations": spark.createDataFrame(regs, "kommun_kod string, manad_start date, drivmedel string, antal long"),
        "price_days": spark.createDataFrame(prices, "elomrade string, datum date, sek_medel double, n_kvartar long"),
        "stations": spark.createDataFrame(stations, "kommun_kod string, kw_dc double, _snapshot_date date"),
        "traffic": spark.createDataFrame(traffic, "kommun_kod string, vkm_per_day double, road_km double"),
        "population": spark.createDataFrame(pop, "kommun_kod string, ar int, folkmangd long"),
        "param_model": spark.createDataFrame(PARAM_MODEL, "parameter string, value string"),
        "param_strategy": spark.createDataFrame(STRATEGY, "scenario string, alpha double, quantity string, "
                                                          "combine_order int"),
        "param_variant": spark.createDataFrame(VARIANT, "variant string, swap_from string, swap_to string, "
                                                        "use_cost_factor boolean, alpha double, "
                                                        "only_scenario string, quantity string"),
        "param_weights": spark.createDataFrame(WEIGHTS, "scenario string, metric string, weight_raw double"),
        "param_cost": spark.createDataFrame([("A1", 1.0), ("B3", 1.1), ("C8", 1.3)],
                                            "gruppkod string, cost_factor double"),
    }
    return t


@pytest.fixture(scope="module")
def model(tables):
    return {k: v.cache() for k, v in run_model(tables).items()}


def test_metrics_complete(model):
    m = model["metric"].collect()
    assert len(m) == 12 * 6
    assert {r.metric for r in m} == {x.name for x in metric_specs()}
    ratio = [r for r in m if r.metric == "supply"]
    assert all(r.value == r.numerator / r.denominator and r.as_of for r in ratio)
    assert all(r.prior is not None and r.k is not None or r.k is None for r in m if r.metric == "growth")
    assert all(r.value is not None and 0.0 <= r.pct_rank <= 1.0 for r in m)
    inf = [r for r in m if r.metric == "supply_traffic" and r.unit == "0117"][0]
    assert math.isinf(inf.value) and inf.pct_rank == 0.0


def test_runs_and_components(model):
    assert model["score"].select("scenario", "variant").distinct().count() == 15
    assert model["component"].count() == 15 * 5 * 6
    s = model["score"].collect()
    assert all(r.n_components == 5 and 0.0 <= r.attractiveness <= 1.0 and r.votes >= 0 for r in s)


def test_seats_total_and_cap(model):
    tot = {(r.scenario, r.variant): r.n for r in
           model["seat"].groupBy("scenario", "variant").agg(F.count("*").alias("n")).collect()}
    assert len(tot) == 15 and set(tot.values()) == {10}
    assert model["allocation"].where("n_seats > 3").count() == 0
    assert model["allocation"].where("NOT run_complete").count() == 0


def test_combined_grid_and_endpoints(model):
    c = model["combined"]
    assert c.count() == 3 * 6 * 6
    assert c.where("run_seats <> 10").count() == 0
    assert c.where("is_default").select("n_p1").distinct().collect()[0].n_p1 == 5
    own = {(r.scenario, r.variant, r.unit): r.n_seats for r in model["allocation"].collect()}
    for r in c.where("n_p1 = 10").collect():
        assert r.n_seats == own[("P1", r.variant, r.unit)]
    for r in c.where("n_p1 = 0").collect():
        assert r.n_seats == own[("P2", r.variant, r.unit)]


def test_publish_stages_checks_and_writes(tables, tmp_path):
    out = publish_model(tables, str(tmp_path / "gold"))
    assert out["allocation"].where("run_seats <> 10").count() == 0
    assert out["combined"].where("is_default").count() > 0


def test_a_missing_metric_value_fails_the_model_and_publishes_nothing(spark, tables, tmp_path):
    broken = dict(tables)
    broken["stations"] = tables["stations"]
    broken["fleet"] = tables["fleet"].withColumn("antal", F.when(F.col("kommun_kod") == "0117", 0 * F.col("antal")).otherwise(F.col("antal")))
    with pytest.raises(ModelRuleFailed, match="n_components, value_present|n_components.*value_present"):
        publish_model(broken, str(tmp_path / "gold"))
    assert versions(spark, str(tmp_path / "gold")) == []


def test_a_missing_metric_row_fails_the_model(spark, tables, tmp_path):
    """A place that the census does not know has no row for two metrics; the
    version published before stays the one that readers see."""
    target = str(tmp_path / "gold")
    publish_model(tables, target)
    broken = tables | {"population": tables["population"].where("kommun_kod <> '0117'")}
    with pytest.raises(ModelRuleFailed, match="all_units_in_metric.*n_components"):
        publish_model(broken, target)
    assert versions(spark, target) == [1]
    sc = run_model(broken)["score"].where("unit = '0117' AND scenario = 'P2' AND variant = 'base'").first()
    assert sc.n_components < sc.n_expected == 5 and sc.attractiveness is None and sc.votes is None


def test_places_listed_twice_fail_the_model(spark, tables, tmp_path):
    twice = tables["dim_kommun"].unionByName(tables["dim_kommun"].limit(1).withColumn("lan_kod", F.lit("99")))
    with pytest.raises(ModelRuleFailed, match="one_label"):
        publish_model(tables | {"dim_kommun": twice}, str(tmp_path / "gold"))
