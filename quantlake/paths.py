"""Zone layout under one root URI (hdfs://, s3a://, abfss://, file:/ ...)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_ohlcv(self) -> str:
        return self._p("raw", "ohlcv")

    @property
    def raw_ticks(self) -> str:
        return self._p("raw", "ticks")

    @property
    def staging_ohlcv(self) -> str:
        return self._p("staging", "ohlcv")

    @property
    def curated_ohlcv(self) -> str:
        return self._p("curated", "ohlcv")

    @property
    def tail_ohlcv(self) -> str:
        """The last bars of each symbol, which a daily run's indicators look back on."""
        return self._p("state", "tail_ohlcv")

    @property
    def pending(self) -> str:
        """Markers of incremental runs that haven't ended."""
        return self._p("state", "pending")

    @property
    def latest_ticks(self) -> str:
        return self._p("state", "latest_ticks")

    @property
    def latest_checkpoint(self) -> str:
        return self._p("checkpoints", "latest_ticks")

    @property
    def tick_checkpoint(self) -> str:
        return self._p("checkpoints", "ticks")

    @property
    def rejected_ticks(self) -> str:
        return self._p("raw", "ticks_rejected")

    @property
    def reject_checkpoint(self) -> str:
        return self._p("checkpoints", "ticks_rejected")

    def partition(self, zone: str, **keys: str) -> str:
        base = getattr(self, zone)
        return "/".join([base] + [f"{k}={v}" for k, v in keys.items()])
