from .columns import (all_of, any_present, from_epoch_or_text, guarded_ratio, has_text, steady_round,
                      to_day, to_moment, typed)
from .lineage import with_lineage
from .tiers import Bound, tier

__all__ = ["Bound", "all_of", "any_present", "from_epoch_or_text", "guarded_ratio", "has_text",
           "steady_round", "tier", "to_day", "to_moment", "typed", "with_lineage"]
