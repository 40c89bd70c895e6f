"""Commerce analytics marts as Spark jobs."""

from tidemart.plans.models import Models
from tidemart.settings import Settings

__all__ = ["Models", "Settings"]
