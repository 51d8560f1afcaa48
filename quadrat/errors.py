"""The one error type users see."""


class PlotDataError(ValueError):
    """A selection, format or guard was not acceptable."""


class UnfilteredReadError(PlotDataError, RuntimeError):
    """A full read was asked for without saying so."""
