"""Contracts, rules, rates and parameters: read from YAML, checked once, then immutable."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal, InvalidOperation
from importlib import resources
from typing import Any

import yaml

SCALARS = ("string", "int", "bigint", "double", "date", "timestamp", "boolean")
RULE_FIELDS = {
    "null_key": {"column"}, "try_cast": {"column"}, "domain": {"column", "values"}, "format": {"column", "pattern"},
    "range": {"column", "min", "max"}, "plausibility": {"column", "max_future_skew_minutes"}, "duplicate": set(), "rescue_rate": {"threshold_pct"},
}
SEVERITIES = ("gate", "quarantine", "observe")
FORMATS = ("csv", "json")


class ConfigError(ValueError):
    """A registry or parameter that cannot be used."""


@dataclass(frozen=True)
class Source:
    name: str
    format: str
    path: str | None = None
    emitters: dict[str, str] = field(default_factory=dict)
    filename_pattern: str | None = None

    @property
    def paths(self) -> dict[str | None, str]:
        return dict(self.emitters) or {None: self.path}


@dataclass(frozen=True)
class SourceContract:
    name: str
    identity: tuple[str, ...]
    columns: dict[str, str]
    op_column: str | None = None
    delete_payload: str | None = None


@dataclass(frozen=True)
class EntityContract:
    name: str
    sources: tuple[str, ...]
    keys: tuple[str, ...]
    sequence_by: tuple[str, ...]
    tiebreak: str | None = None
    scd_type: int | None = None
    apply_as_deletes: bool = False
    dedup_key: tuple[str, ...] = ()

    @property
    def sequence(self) -> tuple[str, ...]:
        """All that orders the events of a key."""
        return self.sequence_by + ((self.tiebreak,) if self.tiebreak else ())


@dataclass(frozen=True)
class Rule:
    rule: str
    severity: str
    column: str | None = None
    params: dict[str, Any] = field(default_factory=dict)

    @property
    def flag(self) -> str:
        return f"_is_{self.reason}"

    @property
    def reason(self) -> str:
        return f"{self.column}_{self.rule}"


@dataclass(frozen=True)
class RuleSet:
    """The rules of a source, bound to its contract."""

    contract: SourceContract
    rules: tuple[Rule, ...]
    duplicate: str | None = None
    rescue: Rule | None = None


@dataclass(frozen=True)
class Rate:
    currency: str
    effective_date: date
    per_base: Decimal


def read_text(*parts: str) -> str:
    at = resources.files("silverlode") / "conf"
    for p in parts:
        at = at / p
    return at.read_text(encoding="utf-8")


def list_names(folder: str) -> list[str]:
    return sorted(p.name for p in (resources.files("silverlode") / "conf" / folder).iterdir() if p.name.endswith(".yml"))


def _load(name: str, top: str) -> Any:
    raw = yaml.safe_load(read_text(name)) or {}
    if top not in raw:
        raise ConfigError(f"{name}: {top} is missing")
    return raw[top]


def _only(what: str, raw: Any, allowed: set[str], required: set[str] = frozenset()) -> dict:
    if not isinstance(raw, dict):
        raise ConfigError(f"{what}: a mapping is expected")
    if unknown := set(raw) - allowed:
        raise ConfigError(f"{what}: unknown fields {sorted(unknown)}")
    if missing := required - set(raw):
        raise ConfigError(f"{what}: missing fields {sorted(missing)}")
    return raw


def _names(what: str, value: Any) -> tuple[str, ...]:
    if not isinstance(value, list) or not value or not all(isinstance(v, str) for v in value):
        raise ConfigError(f"{what}: a non-empty list of names is expected")
    return tuple(value)


def parse_sources(raw: dict) -> dict[str, Source]:
    out = {}
    for name, spec in _only("sources", raw, set(raw)).items():
        spec = _only(name, spec, {"path", "format", "filename_pattern", "emitters"}, {"format"})
        if spec["format"] not in FORMATS:
            raise ConfigError(f"{name}: unknown format {spec['format']!r}")
        if bool(spec.get("path")) == bool(spec.get("emitters")):
            raise ConfigError(f"{name}: one of path and emitters is needed")
        out[name] = Source(name, spec["format"], spec.get("path"), dict(spec.get("emitters") or {}), spec.get("filename_pattern"))
    return out


def check_type(what: str, kind: Any) -> str:
    if not isinstance(kind, str) or not (kind in SCALARS or re.fullmatch(r"decimal\(\d+,\d+\)", kind)):
        raise ConfigError(f"{what}: unknown type {kind!r}")
    return kind


def parse_source_contracts(raw: dict) -> dict[str, SourceContract]:
    out = {}
    for name, spec in raw.items():
        spec = _only(name, spec, {"identity", "columns", "op_column", "delete_payload"}, {"identity", "columns"})
        if not isinstance(spec["columns"], dict) or not spec["columns"]:
            raise ConfigError(f"{name}: columns are needed")
        columns = {c: check_type(f"{name}.{c}", t) for c, t in spec["columns"].items()}
        identity, op = _names(f"{name}.identity", spec["identity"]), spec.get("op_column")
        if stray := {*identity, *([op] if op else [])} - set(columns):
            raise ConfigError(f"{name}: no such columns {sorted(stray)}")
        if spec.get("delete_payload") not in (None, "key_only", "full"):
            raise ConfigError(f"{name}: unknown delete_payload")
        out[name] = SourceContract(name, identity, columns, op, spec.get("delete_payload"))
    return out


def parse_entity_contracts(raw: dict, known: set[str]) -> dict[str, EntityContract]:
    allowed = {"sources", "keys", "sequence_by", "scd_type", "tiebreak", "apply_as_deletes", "dedup_key"}
    out = {}
    for name, spec in raw.items():
        spec = _only(name, spec, allowed, {"sources", "keys", "sequence_by"})
        sources = _names(f"{name}.sources", spec["sources"])
        if stray := set(sources) - known:
            raise ConfigError(f"{name}: unknown sources {sorted(stray)}")
        if spec.get("scd_type") not in (None, 2):
            raise ConfigError(f"{name}: scd_type is 2 or absent")
        if spec.get("scd_type") == 2 and not spec.get("tiebreak"):
            raise ConfigError(f"{name}: scd_type 2 needs a tiebreak")
        out[name] = EntityContract(
            name, sources, _names(f"{name}.keys", spec["keys"]), _names(f"{name}.sequence_by", spec["sequence_by"]), spec.get("tiebreak"), spec.get("scd_type"),
            bool(spec.get("apply_as_deletes")), tuple(spec.get("dedup_key") or ()),
        )
    return out


def parse_rules(raw: dict, known: set[str] | None = None) -> dict[str, list[dict]]:
    for source, rules in raw.items():
        if known is not None and source not in known:
            raise ConfigError(f"rules for unknown source {source!r}")
        for r in rules:
            kind = r.get("rule") if isinstance(r, dict) else None
            if kind not in RULE_FIELDS:
                raise ConfigError(f"{source}: unknown rule {kind!r}")
            fields = RULE_FIELDS[kind]
            required = fields - {"min", "max", "max_future_skew_minutes"} | {"rule", "severity"}
            _only(f"{source}.{kind}", r, fields | {"rule", "severity"}, required)
            if r["severity"] not in SEVERITIES:
                raise ConfigError(f"{source}.{kind}: unknown severity {r['severity']!r}")
            if kind == "range" and r.get("min") is None and r.get("max") is None:
                raise ConfigError(f"{source}.range: min or max is needed")
    return raw


def parse_rates(rows: list[dict]) -> list[Rate]:
    out, seen = [], set()
    for r in rows:
        r = _only("rate", r, {"currency", "effective_date", "per_base"}, {"currency", "effective_date", "per_base"})
        day = r["effective_date"] if isinstance(r["effective_date"], date) else date.fromisoformat(str(r["effective_date"]))
        try:
            value = Decimal(str(r["per_base"]))
        except InvalidOperation as e:
            raise ConfigError(f"rate {r}: not a number") from e
        if not value.is_finite() or value <= 0:
            raise ConfigError(f"rate {r}: not positive")
        if (r["currency"], day) in seen:
            raise ConfigError(f"rate {r}: repeated")
        seen.add((r["currency"], day))
        out.append(Rate(r["currency"], day, value))
    return sorted(out, key=lambda r: (r.currency, r.effective_date))


def load_sources() -> dict[str, Source]:
    return parse_sources(_load("sources.yml", "sources"))


def load_source_contracts() -> dict[str, SourceContract]:
    return parse_source_contracts(_load("contracts.yml", "source_contracts"))


def load_entity_contracts() -> dict[str, EntityContract]:
    return parse_entity_contracts(_load("contracts.yml", "entity_contracts"), set(load_source_contracts()))


def load_rules() -> dict[str, list[dict]]:
    return parse_rules(_load("rules.yml", "rules"), set(load_source_contracts()))


def load_rates() -> list[Rate]:
    return parse_rates(_load("fx_rates.yml", "rates"))


def bind_rules(contract: SourceContract, rules: list[dict]) -> RuleSet:
    """Rules of a source with a try_cast for each typed column that has none; ``column: '*'`` sets its severity."""
    parse_rules({contract.name: rules})
    default = next((r["severity"] for r in rules if r["rule"] == "try_cast" and r["column"] == "*"), "quarantine")
    bound, duplicate, rescue = [], None, None
    for r in rules:
        params = {k: v for k, v in r.items() if k not in ("rule", "column", "severity")}
        if r["rule"] == "duplicate":
            duplicate = r["severity"]
        elif r["rule"] == "rescue_rate":
            rescue = Rule("rescue_rate", r["severity"], None, params)
        elif r.get("column") != "*":
            if r["column"] not in contract.columns:
                raise ConfigError(f"{contract.name}.{r['rule']}: no column {r['column']!r}")
            bound.append(Rule(r["rule"], r["severity"], r["column"], params))
    cast = {r.column for r in bound if r.rule == "try_cast"}
    bound += [Rule("try_cast", default, c) for c, t in contract.columns.items() if t != "string" and c not in cast]
    return RuleSet(contract, tuple(bound), duplicate, rescue)


def event_time_column(source: str, entities: dict[str, EntityContract]) -> str | None:
    """The time by which a fact source is late or not; dimensions have none."""
    return next((e.sequence_by[0] for e in entities.values() if source in e.sources and e.scd_type is None), None)


#: Environments, and the tag that a catalog of each has to carry.
ENVIRONMENTS = {"dev": "dev", "staging": "staging", "prod": "prod"}


@dataclass(frozen=True)
class Params:
    catalog: str
    environment: str
    landing: str
    lateness_days: int = 7
    funnel_hours: int = 24
    warehouse: str | None = None
    #: Whether the session's own catalog holds the schemas, under names that begin with ``catalog``.
    shared: bool = False
    schemas: dict[str, str] = field(default_factory=lambda: {s: s for s in ("bronze", "silver", "gold", "ops")})

    def qualified(self, layer: str, table: str) -> str:
        """The table's name: in its catalog, or, where that is no catalog of its own, in a schema that carries its name."""
        if not self.catalog:
            return f"{self.schemas[layer]}.{table}"
        return f"{self.catalog}{'_' if self.shared else '.'}{self.schemas[layer]}.{table}"


def guard_environment(catalog: str, environment: str) -> None:
    """Refuse a catalog whose name carries the tag of another environment."""
    if environment not in ENVIRONMENTS:
        raise ConfigError(f"unknown environment {environment!r}")
    tags = {t for t in re.split(r"[_.-]", catalog.lower()) if t in ENVIRONMENTS.values()}
    if tags - {ENVIRONMENTS[environment]} or environment == "prod" and not tags:
        raise ConfigError(f"catalog {catalog!r} is not one of {environment!r}")


def resolve_params(args: list[str] = (), conf: dict[str, str] | None = None, prefix: str = "silverlode.") -> Params:
    """Parameters from ``--key=value`` arguments, else from Spark settings under ``prefix``."""
    given = {k.removeprefix(prefix): v for k, v in (conf or {}).items() if k.startswith(prefix)}
    for a in args:
        m = re.fullmatch(r"--([\w-]+)=(.*)", a)
        if not m:
            raise ConfigError(f"cannot read argument {a!r}")
        given[m[1].replace("-", "_")] = m[2]
    known = {"catalog", "environment", "landing", "lateness_days", "funnel_hours", "warehouse"}
    _only("parameters", given, known, {"catalog", "environment", "landing"})
    guard_environment(given["catalog"], given["environment"])
    try:
        return Params(given["catalog"], given["environment"], given["landing"], int(given.get("lateness_days", 7)), int(given.get("funnel_hours", 24)), given.get("warehouse"))
    except ValueError as e:
        raise ConfigError(str(e)) from e
