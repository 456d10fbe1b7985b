"""Typed errors. Gates raise them so a job halts before publishing."""

from __future__ import annotations


class RiskflowError(Exception):
    """Base class for every error raised by riskflow."""


class ConfigError(RiskflowError):
    """Invalid parameters or session settings."""


class IngestionError(RiskflowError):
    """A raw extract is missing, empty or unreadable."""


class TransformError(RiskflowError):
    """A transform could not be built or applied."""


class DataQualityError(RiskflowError):
    """An audit found contract breaches; carries the report."""

    def __init__(self, message: str, report=None):
        super().__init__(message)
        self.report = report


class SchemaContractError(DataQualityError):
    """Required contract columns are missing from the frame."""


class StreamingError(RiskflowError):
    """The velocity stream failed."""


class ModelError(RiskflowError):
    """Training, splitting or scoring failed."""
