"""What differs between markets, as data.

Every market runs the same computation on other column names.  A ``MarketSpec`` maps its
columns to roles and holds its scope rules, so that operators never name a raw column.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rule:
    """A row filter: ``test`` is one of in, not_in, in_or_null, not_null."""

    column: str
    test: str
    values: tuple = ()


@dataclass(frozen=True)
class CodeOverride:
    """Set ``target`` to ``value`` where ``code_column`` is one of ``codes``."""

    target: str
    code_column: str
    codes: tuple
    value: str


@dataclass(frozen=True)
class Lookup:
    """A left join to a dimension table.

    ``keys`` pairs a sales column with a table column; ``take`` maps new names to table
    columns, and a taken column replaces one of that name.  ``rest`` also takes the table's
    other columns that the sales do not have.  ``distinct`` reduces the table to distinct
    rows first.
    """

    table: str
    keys: tuple[tuple[str, str], ...]
    take: Mapping[str, str]
    at: str = "raw"  # "raw": before the scope filter, "scope": within it
    distinct: bool = False
    rest: bool = False


@dataclass(frozen=True)
class Remap:
    """Reference-table override: the mapped value if found, else the present one."""

    table: str
    key: tuple[str, str]
    target: str
    new_value: str


@dataclass(frozen=True)
class Windows:
    history: int = 27
    features: int = 12
    label: int = 3
    older_end: int = 12
    older_span: int = 12
    recent_span: int = 11
    sales_total: int = 12
    opportunity_from: int = 4
    opportunity_until: int = 1


@dataclass(frozen=True)
class RiskRules:
    rare_until: int = 3
    lost: float = 0.80
    high: float = 0.70
    at_risk: float = 0.50
    top_opportunities: int = 500
    cap: float = 0.999
    floor: float = 0.001
    balance_seed: int = 11
    split_seed: int = 42
    test_share: float = 0.20


# The labels stored in result tables and read by the list's users.
@dataclass(frozen=True)
class RiskLabels:
    opportunity: str = "Oportunidad"
    lost: str = "Perdido"
    high: str = "En Riesgo Alto"
    at_risk: str = "En Riesgo"
    stable: str = "Estable"
    unknown: str = "Unknown"
    recent: str = "Compra Rcte"
    not_at_risk_reason: str = "EL CLIENTE NO ESTÁ EN RIESGO"
    centre: str = "CUSTOMER CENTER"
    no_seller: str = "Sin Vendedor Asignado"


KEYS = ("client_id", "product", "branch")

NUMERIC_FEATURES = ("monetary_value", "frequency", "volume", "recency", "max_gap")


@dataclass(frozen=True)
class MarketSpec:
    code: str
    country: str
    columns: Mapping[str, str]  # role -> raw column
    date_pattern: str | None = None
    period_from: tuple[str, str] | None = None  # role and pattern, when not the sale date
    measures: Mapping[str, str] = field(default_factory=lambda: {"monetary_value": "amount"})
    trimmed: tuple[str, ...] = ()
    long_ids: tuple[str, ...] = ("client_id",)
    text_repairs: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    id_class: tuple[str, str, str, str, str] | None = None  # new, source, prefix, match, else
    overrides: tuple[CodeOverride, ...] = ()
    raw_rules: tuple[Rule, ...] = ()
    lookups: tuple[Lookup, ...] = ()
    scope_rules: tuple[Rule, ...] = ()
    remap: Remap | None = None
    remap_rules: tuple[Rule, ...] = ()
    drop_duplicate_lines: bool = False
    list_branch: str = "branch"  # column that stands for the branch in lists and totals
    history_date: str = "sale_date"
    history_rules: tuple[Rule, ...] = ()
    history_lookups: tuple[str, ...] = ()
    history_segment: bool = False
    history_drop: tuple[str, ...] = ()
    sales_total_scoped: bool = False
    sales_total_rules: tuple[Rule, ...] = ()
    scope_trimmed: tuple[str, ...] = ()
    seller_from: str = "client"  # newest per "client", per "branch", or a "table"
    margin_table: bool = False
    attribute_keys: tuple[str, ...] = KEYS
    attributes: tuple[str, ...] = ("segment",)
    required_attributes: tuple[str, ...] = ()
    attributes_scoped: bool = False
    attributes_remapped: bool = False  # attributes under the product's new name
    history_after: bool = False  # the window's first day is not part of it
    flags: tuple[str, ...] = ()
    contact_columns: tuple[str, ...] = ()
    list_columns: tuple[str, ...] = ()
    list_scoped: bool = False
    views: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...] = ()  # keys and columns
    categories: tuple[str, ...] = ("branch", "product", "segment")
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    excluded_sellers: tuple[str, ...] = ()
    opportunity_cut_scoped: bool = True
    seller_limit: float | None = None
    call_centre: bool = False
    period_column: str = "periodo_analisis"
    newest_only: tuple[str, ...] = ()  # result tables that keep just the last run
    label_by_branch: bool = False
    gap_by_branch: bool = False
    windows: Windows = Windows()
    rules: RiskRules = RiskRules()
    labels: RiskLabels = RiskLabels()
