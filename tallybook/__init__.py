"""Reconciliation of detail against summary populations, as Spark jobs."""

from tallybook.config import Engagement
from tallybook.plans.reconcile import Outcome, reconcile
from tallybook.plans.register import run_controls

__all__ = ["Engagement", "Outcome", "reconcile", "run_controls"]
