"""Parameters of the engine. Everything that a rule or a threshold depends on lives here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class CapBuckets:
    """Size classes by market cap, given from the largest threshold to the smallest."""

    thresholds: tuple[tuple[int, str], ...]
    default: str
    inclusive: bool = False
    null_label: str | None = None

    @property
    def labels(self) -> tuple[str, ...]:
        named = [label for _, label in self.thresholds] + [self.default]
        if self.null_label:
            named.append(self.null_label)
        return tuple(dict.fromkeys(named))


# The two label sets and their limits.
STRICT_CAPS = CapBuckets(
    thresholds=((10_000_000_000, "Large Cap"), (1_000_000_000, "Mid Cap")),
    default="Small Cap",
)
INCLUSIVE_CAPS = CapBuckets(
    thresholds=((10_000_000_000, "LARGE_CAP"), (1_000_000_000, "MID_CAP")),
    default="SMALL_CAP",
    inclusive=True,
)

# Default price limits, spike width, z-score limit.
DEFAULT_MIN_PRICE = 0.0
DEFAULT_MAX_PRICE = 1_000_000.0
SPIKE_STDDEVS = 3.0
Z_THRESHOLD = 3.0

# The columns whose change opens a new version.
TRACKED_COLUMNS = ("current_price", "market_cap", "total_volume")


@dataclass(frozen=True)
class RowRules:
    """Row-level rules. A null value never fails a range rule."""

    not_null: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(
        default_factory=lambda: {"current_price": (DEFAULT_MIN_PRICE, DEFAULT_MAX_PRICE)}
    )
    non_negative: tuple[str, ...] = ("market_cap", "total_volume")

    def with_required(self, columns: Sequence[str]) -> "RowRules":
        """These rules with further columns that must be filled."""
        return replace(self, not_null=tuple(dict.fromkeys([*self.not_null, *columns])))

    @classmethod
    def from_rule_list(cls, rules: Sequence[Mapping]) -> "RowRules":
        """Rules as a list of ``{"type": "not_null", "columns": [...]}`` entries."""
        wanted = [c for r in rules if r["type"] == "not_null" for c in r["columns"]]
        return cls(not_null=tuple(dict.fromkeys(wanted)))

    @classmethod
    def from_config(cls, block: Mapping, price: str = "current_price") -> "RowRules":
        """Rules as a block with required/numeric fields and price limits."""
        return cls(
            not_null=tuple(block.get("required_fields", ())),
            numeric=tuple(block.get("numeric_fields", ())),
            ranges={price: (block.get("min_price"), block.get("max_price"))},
            non_negative=(),
        )


@dataclass(frozen=True)
class FrameRules:
    """Frame-level rules; columns the frame does not have are left out of the report."""

    required: tuple[str, ...] = ()
    max_null_pct: float = 5.0
    unique: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    freshness: str | None = None
    max_age_hours: float = 24.0
