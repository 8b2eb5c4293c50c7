"""Screen and backtest parameters, checked once in the driver."""
from __future__ import annotations

from dataclasses import dataclass, fields, replace

# fixed values: quarters of the year (0-based) at which each frequency rebalances
FREQUENCIES = {"quarterly": (0, 1, 2, 3), "semiannual": (1, 3), "annual": (3,)}
DELIST_MODES = ("carry", "writeoff")


@dataclass(frozen=True)
class ScreenParams:
    """Limits of the value screen; ``None`` switches a limit off.

    The defaults are those of a bare screen. ``ScreenParams.backtest`` starts from
    the backtest's own defaults instead (market cap 0.5-500 $B, four positive quarters).
    """

    pe_min: float = 0.0
    pe_max: float = 15.0
    mcap_min_b: float | None = None
    mcap_max_b: float | None = None
    min_div_yield: float = 0.0
    require_pos_eps4: bool = False
    vol_max: float | None = None
    min_ret_12m: float | None = None
    freq: str = "quarterly"
    start_year: int | None = None
    delist_mode: str = "carry"

    @classmethod
    def screen(cls, **given) -> "ScreenParams":
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in given.items() if k in known})

    @classmethod
    def backtest(cls, **given) -> "ScreenParams":
        base = {"mcap_min_b": 0.5, "mcap_max_b": 500.0, "require_pos_eps4": True}
        return cls.screen(**{**base, **given})

    @classmethod
    def from_ui(cls, *, mcap_min_m=None, mcap_max_m=None, min_div_yield_pct=0.0,
                min_ret_pct=None, **given) -> "ScreenParams":
        """Millions of dollars and percent, as a form sends them."""
        return cls.backtest(
            mcap_min_b=None if mcap_min_m is None else mcap_min_m / 1000.0,
            mcap_max_b=None if mcap_max_m is None else mcap_max_m / 1000.0,
            min_div_yield=min_div_yield_pct / 100.0,
            min_ret_12m=None if min_ret_pct is None or min_ret_pct <= -100 else min_ret_pct / 100.0,
            **given,
        )

    def validated(self) -> "ScreenParams":
        """Refuse what a request must not contain."""
        if self.freq not in FREQUENCIES:
            raise ValueError("freq must be one of " + ", ".join(FREQUENCIES))
        if self.delist_mode not in DELIST_MODES:
            raise ValueError("delist_mode must be one of " + ", ".join(DELIST_MODES))
        if (self.mcap_min_b is not None and self.mcap_max_b is not None
                and self.mcap_min_b > self.mcap_max_b):
            raise ValueError("mcap_min_b must not exceed mcap_max_b")
        return self

    def lenient(self) -> "ScreenParams":
        """An unknown frequency falls back to quarterly."""
        return self if self.freq in FREQUENCIES else replace(self, freq="quarterly")

    @property
    def rebalance_quarters_of_year(self) -> tuple[int, ...]:
        return FREQUENCIES.get(self.freq, FREQUENCIES["quarterly"])
