"""postloom: job postings from many sources, standardised on Spark."""

from postloom.plans.specs import SOURCES, SourceSpec
from postloom.plans.standardize import standardize
from postloom.session import build_session

__all__ = ["SOURCES", "SourceSpec", "build_session", "standardize"]
