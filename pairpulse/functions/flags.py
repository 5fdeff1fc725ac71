"""Row predicates counted by the index. Three-valued: NULL is never counted."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairpulse.config import EngineConfig


def is_unrest(cfg: EngineConfig, root_code: str = "EventRootCode") -> Column:
    return F.col(root_code).isin(list(cfg.unrest_root_codes))


def is_government(cfg: EngineConfig, type_code: str) -> Column:
    return F.col(type_code) == cfg.government_type


def is_nongovernment(cfg: EngineConfig, type_code: str) -> Column:
    """Known to be no government; with ``null_type_is_nongov`` also an unknown type."""
    if cfg.null_type_is_nongov:
        return ~F.col(type_code).eqNullSafe(cfg.government_type)
    return F.col(type_code) != cfg.government_type


def government_flows(cfg: EngineConfig) -> dict[str, Column]:
    """The three directed flows with a government on at least one side."""
    source, target = "Actor1Type1Code", "Actor2Type1Code"
    return {
        "total_gov_gov_events": is_government(cfg, source) & is_government(cfg, target),
        "total_ngov_gov_events": is_nongovernment(cfg, source) & is_government(cfg, target),
        "total_gov_ngov_events": is_government(cfg, source) & is_nongovernment(cfg, target),
    }
