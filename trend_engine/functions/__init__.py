"""Column functions: scoring, exact averages, time renderings."""

from trend_engine.functions.exact import mean_exact, mean_int, mean_round2
from trend_engine.functions.scoring import (TOPICS, assign_topic, cents, is_viral, preview, tier,
                                            tier_label, viral_score)
from trend_engine.functions.timefmt import hour_label, iso_local, iso_utc, report_key, utc_offset

__all__ = ["TOPICS", "assign_topic", "cents", "hour_label", "is_viral", "iso_local", "iso_utc",
           "mean_exact", "mean_int", "mean_round2", "preview", "report_key", "tier", "tier_label",
           "utc_offset", "viral_score"]
