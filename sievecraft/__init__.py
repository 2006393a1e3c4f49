"""Curation of supervised text data sets with Spark."""

from sievecraft.errors import DataQualityError
from sievecraft.plans.candidates import build_candidates, write_build
from sievecraft.plans.prepare import prepare_dataset, prepare_files
from sievecraft.plans.review import materialise_review, review_batch, summarise_splits
from sievecraft.plans.scan import scan_history

__all__ = [
    "DataQualityError",
    "build_candidates",
    "materialise_review",
    "prepare_dataset",
    "prepare_files",
    "review_batch",
    "scan_history",
    "summarise_splits",
    "write_build",
]
