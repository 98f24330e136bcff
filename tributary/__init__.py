"""Record integration on Spark: read, conform, clean, deduplicate, check, export."""

from tributary.plans.deduplicate import deduplicate
from tributary.plans.pipeline import run_pipeline

__all__ = ["deduplicate", "run_pipeline"]
