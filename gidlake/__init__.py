"""Spark jobs that discover, assemble, enrich and publish project/company data."""

from gidlake.settings import PortalSettings, tune_session

__all__ = ["PortalSettings", "tune_session"]
