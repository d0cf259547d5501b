"""Alerts -> block decisions, state, history, counters and alias lists."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.operators import blocks as K
from flowwarden.schema import CONFIDENCE_FLOOR, TIERS, Tier


@dataclass
class Blocking:
    """Lazy results of one run of the block policy as of a moment."""

    intake: DataFrame
    episodes: DataFrame
    active: DataFrame
    history: DataFrame
    counters: DataFrame
    aliases: DataFrame


def block(
    alerts: DataFrame,
    whitelist: DataFrame,
    as_of: Column,
    started: Column,
    tiers: Iterable[Tier] = TIERS,
    floor: float = CONFIDENCE_FLOOR,
    tick_seconds: int = 0,
) -> Blocking:
    """`alerts` holds ip, ts, alert_id, confidence, total_flows and alert_file."""
    tiers = tuple(tiers)
    intake = K.alert_intake(alerts.filter(F.col("ts") <= as_of), whitelist, floor)
    accepted = intake.filter(F.col("status") == "accepted").drop("status")
    episodes = K.block_episodes(accepted, tiers, as_of, tick_seconds, floor)
    active = K.active_blocks(episodes)
    return Blocking(
        intake=intake,
        episodes=episodes,
        active=active,
        history=K.block_history(episodes),
        counters=K.block_counters(intake, episodes, started, as_of, tiers),
        aliases=K.alias_contents(active),
    )
