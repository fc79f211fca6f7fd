"""Physical-plan helpers: lineage cuts, plan inspection."""

from clickpulse.plans.lineage import cut_lineage, write_and_reread
from clickpulse.plans.inspect import plan_text, assert_plan

__all__ = ["cut_lineage", "write_and_reread",
           "plan_text", "assert_plan"]
