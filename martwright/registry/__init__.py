"""Every query by name, next to the SQL that states the same result independently."""

from martwright.registry.base import CASES, Case

# importing a module registers its cases
from martwright.registry import models  # noqa: F401  isort: skip
from martwright.registry import metrics  # noqa: F401  isort: skip
from martwright.registry import checks  # noqa: F401  isort: skip
from martwright.registry import profiling  # noqa: F401  isort: skip
from martwright.registry import catalog  # noqa: F401  isort: skip
from martwright.registry import sinks  # noqa: F401  isort: skip

__all__ = ["CASES", "Case"]
