"""Column library and fixed values shared by every model."""

from . import columns, fixed  # noqa: F401
