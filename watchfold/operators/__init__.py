"""DataFrame -> DataFrame operators of the pipelines."""

from watchfold.operators import analytics, behavior, bridge, interaction, labelling

__all__ = ["analytics", "behavior", "bridge", "interaction", "labelling"]
