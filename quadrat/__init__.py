"""Ecological plot data as Spark tables and streams."""

from .api import PlotData
from .errors import PlotDataError, UnfilteredReadError
from .model import SurveyTables

__all__ = ["PlotData", "PlotDataError", "SurveyTables", "UnfilteredReadError"]
