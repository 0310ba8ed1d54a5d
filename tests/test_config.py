import pytest

from silverlode.plans import config
from silverlode.plans.config import ConfigError


def test_registries_load():
    assert set(config.load_sources()) == set(config.load_source_contracts()) == set(config.load_rules())
    assert config.load_entity_contracts()["dim_customer"].sequence == ("change_ts", "change_seq")
    assert [str(r.per_base) for r in config.load_rates()] == ["35", "36"]


def test_every_source_has_key_and_duplicate_rules():
    for rules in config.load_rules().values():
        assert {"null_key", "duplicate"} <= {r["rule"] for r in rules}


@pytest.mark.parametrize("raw", [
    {"s": {"format": "xml", "path": "p"}}, {"s": {"format": "csv"}}, {"s": {"format": "csv", "path": "p", "emitters": {"a": "b"}}}, {"s": {"format": "csv", "path": "p", "odd": 1}},
])
def test_bad_sources(raw):
    with pytest.raises(ConfigError):
        config.parse_sources(raw)


@pytest.mark.parametrize("raw", [
    {"s": {"identity": ["x"], "columns": {"a": "int"}}}, {"s": {"identity": ["a"], "columns": {}}}, {"s": {"identity": ["a"], "columns": {"a": "uuid"}}}, {"s": {"identity": "a", "columns": {"a": "int"}}},
])
def test_bad_source_contracts(raw):
    with pytest.raises(ConfigError):
        config.parse_source_contracts(raw)


def test_scd2_needs_tiebreak():
    with pytest.raises(ConfigError):
        config.parse_entity_contracts({"d": {"sources": ["s"], "keys": ["k"], "sequence_by": ["t"], "scd_type": 2}}, {"s"})


@pytest.mark.parametrize("rule", [
    {"rule": "odd", "severity": "gate"}, {"rule": "domain", "column": "a", "severity": "gate"}, {"rule": "range", "column": "a", "severity": "gate"}, {"rule": "null_key", "column": "a", "severity": "fatal"},
])
def test_bad_rules(rule):
    with pytest.raises(ConfigError):
        config.parse_rules({"s": [rule]})


def test_casts_are_synthesized_and_overridden():
    c = config.load_source_contracts()
    bound = config.bind_rules(c["customer_activity"], config.load_rules()["customer_activity"])
    assert {r.severity for r in bound.rules if r.rule == "try_cast"} == {"observe"}
    bound = config.bind_rules(c["customers"], config.load_rules()["customers"])
    assert {r.column for r in bound.rules if r.rule == "try_cast"} == {"customer_id", "birth_date", "home_store_id", "signup_ts", "updated_at"}


@pytest.mark.parametrize("rows", [
    [{"currency": "THB", "effective_date": "2026-01-01", "per_base": "0"}], [{"currency": "THB", "effective_date": "2026-01-01", "per_base": "x"}],
    [{"currency": "THB", "effective_date": "2026-01-01", "per_base": "1"}] * 2,
])
def test_bad_rates(rows):
    with pytest.raises(ConfigError):
        config.parse_rates(rows)


def test_params_and_guard():
    p = config.resolve_params(["--catalog=shop_dev", "--environment=dev", "--landing=/x", "--lateness_days=3"])
    assert (p.lateness_days, p.qualified("gold", "t")) == (3, "shop_dev.gold.t")
    assert config.resolve_params([], {"silverlode.catalog": "shop_prod", "silverlode.environment": "prod", "silverlode.landing": "/x"}).environment == "prod"
    for bad in (["--catalog=shop_prod", "--environment=dev", "--landing=/x"], ["--catalog=shop", "--environment=prod", "--landing=/x"], ["--environment=dev"], ["loose"]):
        with pytest.raises(ConfigError):
            config.resolve_params(bad)


def test_event_time_column():
    e = config.load_entity_contracts()
    assert config.event_time_column("order_events", e) == "event_ts"
    assert config.event_time_column("customers", e) is None
