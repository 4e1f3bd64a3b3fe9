"""Physical-plan helpers (size-checked broadcast, lineage cuts) and the
composed pipeline."""

from tillroll.plans.strategies import broadcast_if_bounded, cut_lineage  # noqa: F401
