"""Composed plans: the global-order prefix plan, the train/score pipeline
and the registry of named queries used by the driver contract."""
