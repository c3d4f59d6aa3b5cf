"""Names, defaults and environment settings shared by batch and streaming jobs."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Oracle feed ids (main net) of the two prices that are followed.
SOL_USD_FEED = "ef0d8b6fda2ceba41da15d4095d1da392a0d2f8ed0c6c7bc0f4cfac8c280b56d"
USDC_USD_FEED = "eaa020c61cc479712813461ce153894a96a6c00b21ed0cfc2798d1f9a9e9c94a"

# Topic names.
TRADES_TOPIC = "coinbase.sol_usd.trades"
TICKER_TOPIC = "coinbase.sol_usd.ticker"
SOL_ORACLE_TOPIC = "pyth.sol_usd.prices"
USDC_ORACLE_TOPIC = "pyth.usdc_usd.prices"
BARS_TOPIC = "analytics.sol_usd.ohlcv_{label}"
IMBALANCE_TOPIC = "analytics.sol_usd.imbalance"
SPREAD_TOPIC = "analytics.sol.cross_source_spread"
PEG_TOPIC = "alerts.usdc_peg"

# Bar label -> seconds, hop window, rolling rows, staleness, peg entry threshold.
BAR_SIZES = {"1s": 1, "10s": 10, "1m": 60}
HOP_SIZE_S = 30
HOP_SLIDE_S = 5
ZSCORE_ROWS = 100
MAX_AGE_S = 10
PEG_THRESHOLD = 0.001


@dataclass(frozen=True)
class Settings:
    """Job settings; ``from_env`` reads the same variables for every job."""

    bootstrap_servers: str = "localhost:19092"
    zscore_rows: int = ZSCORE_ROWS
    max_age_s: int = MAX_AGE_S
    peg_threshold: float = PEG_THRESHOLD
    feed_topics: Mapping[str, str] = field(
        default_factory=lambda: {
            SOL_USD_FEED: SOL_ORACLE_TOPIC,
            USDC_USD_FEED: USDC_ORACLE_TOPIC,
        }
    )
    # Which oracle feed prices which product.
    feed_products: Mapping[str, str] = field(default_factory=lambda: {SOL_USD_FEED: "SOL-USD"})

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        return cls(
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.bootstrap_servers),
            zscore_rows=int(env.get("ZSCORE_WINDOW", cls.zscore_rows)),
            max_age_s=int(env.get("JOIN_TIMEOUT_S", cls.max_age_s)),
            peg_threshold=float(env.get("PEG_DRIFT_THRESHOLD", cls.peg_threshold)),
            feed_topics={
                env.get("PYTH_FEED_SOL_USD", SOL_USD_FEED): SOL_ORACLE_TOPIC,
                env.get("PYTH_FEED_USDC_USD", USDC_USD_FEED): USDC_ORACLE_TOPIC,
            },
            feed_products={env.get("PYTH_FEED_SOL_USD", SOL_USD_FEED): "SOL-USD"},
        )
