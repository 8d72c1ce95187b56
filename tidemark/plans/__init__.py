"""How ordered per-key work is spread over a cluster."""

from tidemark.plans.layout import Layout, measure
from tidemark.plans.scan import Pass, in_order, ordered_scan

__all__ = ["Layout", "Pass", "in_order", "measure", "ordered_scan"]
